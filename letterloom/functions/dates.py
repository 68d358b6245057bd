"""Mail date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.text import bind, constant_list, constant_map

# Month abbreviations, and zone names with their UTC offsets.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONES = {
    "UT": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "Z": "+00:00",
    "AST": "-04:00", "ADT": "-03:00", "EST": "-05:00", "EDT": "-04:00",
    "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00",
    "PST": "-08:00", "PDT": "-07:00",
}

DATE = (
    r"(?is)^\s*(?:[a-z]+\s*,?\s*)?(\d{1,2})[\s-]+(" + "|".join(MONTHS) + r")[a-z]*[\s-]+(\d{4}|\d{2})"
    r"\s+(\d{1,2})[:.](\d{2})(?:[:.](\d{2}))?\s*(?:([+-]\d{4})|([a-z]{1,5}))?.*$"
)


def parse_date(text: Column) -> Column:
    """Mail date to an instant; null when it cannot be read.

    The weekday and comments are ignored. A zone that is missing or unknown
    counts as UTC, two-digit years turn at 69, and an out-of-range field makes
    the whole date null.
    """

    # One match fills all fields; text that does not match has no leading bar.
    fields = F.split(F.regexp_replace(text, DATE, "|$1|$2|$3|$4|$5|$6|$7|$8"), r"\|")
    return bind(fields, lambda f: F.when(F.get(f, F.lit(0)) == "", _iso(f).try_cast("timestamp")))


def _iso(fields: Column) -> Column:
    day, month, year, hour, minute, second, offset, zone = (F.get(fields, F.lit(i)) for i in range(1, 9))
    century = F.when(F.length(year) == 4, "").when(year >= "69", "19").otherwise("20")
    number = F.array_position(constant_list(MONTHS), F.lower(month)).cast("string")
    shift = F.when(offset != "", F.regexp_replace(offset, r"^(...)(..)$", "$1:$2")).otherwise(
        F.coalesce(F.try_element_at(constant_map(ZONES), F.upper(zone)), F.lit("+00:00"))
    )
    return F.concat(
        century, year, F.lit("-"), F.lpad(number, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"),
        F.lit("T"), F.lpad(hour, 2, "0"), F.lit(":"), minute, F.lit(":"),
        F.when(second == "", "00").otherwise(second), shift,
    )

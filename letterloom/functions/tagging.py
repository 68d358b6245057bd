"""Pattern tags and the surrogates that replace tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.text import bind, constant_list, constant_map

# Runs of word characters, and the runs between them.
SEGMENT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"

# Repeated groups are possessive, which Java walks in a loop; others take a stack frame for each turn.
EMAIL = r"(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
URL = (
    r"(?i)(?:https?|ftp)://[^\s<>\"']+"
    r"|(?<![a-z0-9.@-])(?:www\.[^\s<>\"']+|[a-z0-9-][a-z0-9.-]*\.(?:com|org|net|edu|gov|info)(?![a-z0-9-]))"
)
# The words that count as numbers.
NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten",
    "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen",
    "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety",
    "hundred", "thousand", "million", "billion", "trillion",
)
BORDER = r"(?![\p{L}\p{N}_])"
DIGITS = rf"[+-]?\d++{BORDER}(?:[.,/:]\d++{BORDER})*+"

# Every tag, and the kind of surrogate that stands in for it.
SURROGATE_KIND = {
    "PERSON": "first_name", "NORP": "country", "FAC": "country", "ORG": "last_name",
    "GPE": "country", "LOC": "country", "PRODUCT": "company", "EVENT": "full_name",
    "WORK_OF_ART": "full_name", "LAW": "full_name", "LANGUAGE": "full_name", "DATE": "month",
    "TIME": "time", "PERCENT": "full_name", "MONEY": "currency", "QUANTITY": "integer",
    "ORDINAL": "integer", "CARDINAL": "integer", "EMAIL": "email", "URL": "url",
    "NUM": "integer",
}

# Surrogate pools.
FIRST_NAMES = ("Alice", "Bruno", "Clara", "Dmitri", "Elena", "Farid", "Greta", "Hugo", "Ines", "Jonas")
LAST_NAMES = ("Abbott", "Berger", "Castro", "Dubois", "Evans", "Fischer", "Garcia", "Hughes", "Ivanov", "Jensen")
COUNTRIES = ("Austria", "Brazil", "Canada", "Denmark", "Egypt", "Finland", "Ghana", "Hungary", "Iceland", "Japan")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
)
CURRENCIES = ("Euro", "Dollar", "Pound", "Yen", "Franc", "Krone", "Peso", "Rupee", "Rand", "Real")


def number_pattern(words: bool = True) -> str:
    inner = "|".join((DIGITS, *NUMBER_WORDS)) if words else DIGITS
    return rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{inner})(?![\p{{L}}\p{{N}}_])"


def tag_patterns(text: Column, number_words: bool = True) -> Column:
    """Mail addresses, URLs and numbers become EMAIL, URL and NUM, in that order."""
    text = F.regexp_replace(text, EMAIL, "EMAIL")
    text = F.regexp_replace(text, URL, "URL")
    return F.regexp_replace(text, number_pattern(number_words), "NUM")


def count_pattern(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def segments(text: Column) -> Column:
    """The text cut into words and what lies between them; joined it is the text."""
    return F.regexp_extract_all(text, F.lit(SEGMENT), F.lit(0))


def _pick(pool: tuple[str, ...], draw: Column) -> Column:
    return F.get(constant_list(pool), (draw % len(pool)).cast("int"))


def _surrogate(kind: Column, draw: Column) -> Column:
    first = _pick(FIRST_NAMES, draw)
    last = _pick(LAST_NAMES, F.floor(draw / len(FIRST_NAMES)).cast("long"))
    kinds = {
        "first_name": first,
        "last_name": last,
        "full_name": F.concat(first, F.lit(" "), last),
        "company": F.concat(last, F.lit(" Ltd")),
        "country": _pick(COUNTRIES, draw),
        "month": _pick(MONTH_NAMES, draw),
        "currency": _pick(CURRENCIES, draw),
        "integer": (draw % 10_000).cast("string"),
        "time": F.date_format(F.timestamp_seconds(draw % 86_400), "HH:mm:ss"),
        "email": F.concat(F.lower(first), F.lit("@example.org")),
        "url": F.concat(F.lit("https://www.example.com/"), (draw % 10_000).cast("string")),
    }
    out = F.lit(None).cast("string")
    for name, value in kinds.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def fill_surrogates(text: Column, key: Column, salt: str) -> Column:
    """Replace every tag that stands as a whole word.

    The choice hangs on the salt, the row key and the tag's place, so a retried
    task writes the same text.
    """

    def replace(segment: Column, pos: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(salt), key.cast("string"), pos.cast("string")), 256)
        draw = F.conv(F.substring(seed, 1, 8), 16, 10).cast("long")
        choice = F.struct(
            F.try_element_at(constant_map(SURROGATE_KIND), segment).alias("kind"), draw.alias("draw")
        )
        filled = bind(choice, lambda c: _surrogate(c["kind"], c["draw"]))
        return F.when(segment.isin(*SURROGATE_KIND), filled).otherwise(segment)

    has_tag = text.rlike("|".join(SURROGATE_KIND))
    return F.when(has_tag, F.array_join(F.transform(segments(text), replace), "")).otherwise(text)

"""Token expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.tagging import NUMBER_WORDS
from letterloom.functions.text import ASCII_WHITESPACE, bind, strip_punctuation

MAIL_LIKE = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
URL_STARTS = ("http", "ftp", "www")
MIN_LEMMA_LENGTH = 3


def words(text: Column) -> Column:
    """Lower-case tokens after punctuation is dropped; no text is one empty token."""
    bare = F.btrim(strip_punctuation(F.lower(text)), F.lit(ASCII_WHITESPACE))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array(F.lit(""))).otherwise(
        F.split(bare, r"[\s\x1c-\x1f]+")
    )


def counted(items: Column) -> Column:
    """Structs (word, cnt) of the distinct items in order, from the runs of equal ones once they are sorted; null has none."""

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))

        def entries(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda at, k: F.struct(
                    F.get(ordered, at).alias("word"),
                    (F.coalesce(F.get(starts, k + 1), size) - at).cast("long").alias("cnt"),
                ),
            )

        return bind(starts, entries)

    return bind(F.sort_array(items), runs)


def plural_stem(token: Column) -> Column:
    """The three rules of the S-stemmer; the first whose ending fits decides.

    Most tokens fail the first test, and none needs a pattern match.
    """
    size = F.length(token)

    def drop(count: int) -> Column:
        return F.substring(token, F.lit(1), size - count)

    def before(count: int) -> Column:
        """The character in front of an ending of that length, empty if there is none."""
        return F.when(size > count, F.substring(token, F.lit(-1 - count), F.lit(1))).otherwise("")

    def unless(count: int, blocked: str, stem: Column) -> Column:
        return F.when(before(count).isin("", *blocked), token).otherwise(stem)

    by_ending = (
        F.when(token.endswith("ies"), unless(3, "ea", F.concat(drop(3), F.lit("y"))))
        .when(token.endswith("es"), unless(2, "aeo", drop(1)))
        .otherwise(unless(1, "us", drop(1)))
    )
    return F.when(~token.endswith("s"), token).otherwise(by_ending)


def is_number_like(token: Column) -> Column:
    """Digits with an optional sign, which sort before a colon, a fraction of them, or a number word."""
    digits = (token < ":") & F.translate(token, ",.", "").rlike(r"^[+-]?\d+(?:/\d+)?$")
    return digits | F.lower(token).isin(*NUMBER_WORDS)


def is_mail_like(token: Column) -> Column:
    return F.contains(token, F.lit("@")) & token.rlike(MAIL_LIKE)


def is_url_like(token: Column) -> Column:
    start = F.lower(F.substring(token, 1, 4))
    return start.startswith(URL_STARTS[0]) | start.startswith(URL_STARTS[1]) | start.startswith(URL_STARTS[2])


def keeps(token: Column, lemma: Column) -> Column:
    """Whether a token may count: long enough, and not a number, address or URL."""
    return (
        (F.length(lemma) >= MIN_LEMMA_LENGTH)
        & ~is_number_like(token)
        & ~is_mail_like(token)
        & ~is_url_like(token)
    )

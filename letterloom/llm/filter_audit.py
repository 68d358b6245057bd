"""What filters of documents do together: every coalition's removals, steps of every order, exact Shapley values."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.llm.common import cut, join_groups

#: The filters; bit k of a mask says that the document fails letter k.
LETTERS = "ABCDE"
COALITIONS = range(1 << len(LETTERS))
#: What a coalition removes: documents, those of good quality, toxic ones.
COUNTED = ("rows", "good", "toxic")


def failures_of_text(text: Column) -> Column:
    """Bits A to D of a text's mask; null is empty.

    A: under 100 words. B: distinct words are under 80 % of the words. C: more than 10 % of the
    characters are A-Z. D: one of ``#$%&*|`` occurs. Words are runs without ASCII white space.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failing = [count < 100, 100 * distinct < 80 * count, 100 * capitals > 10 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failing)), F.lit(0)).cast("int")


def failure_masks(documents: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, mask): the failures of every row, E too: an equal text has a smaller id anywhere in the table.

    Equal ids are not smaller, and a null id is neither smaller than another nor has smaller ones. Texts are
    compared by SHA-256. Equal texts are counted with partial sums, and only rows of narrow columns move, a
    group of copies of any size spread over the tasks.
    """
    prints = cut(
        documents.select(
            F.col(key).alias("id"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            failures_of_text(F.col(text)).alias("mask"),
            F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("h"),
        )
    )
    groups = prints.groupBy("h").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = join_groups(prints, groups, "h", "n", "id", prints.count())
    copied = F.when(F.col("id") > F.col("first"), 1 << LETTERS.index("E")).otherwise(0)
    return joined.select("id", "part", F.col("mask").bitwiseOR(copied).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, mask, rows, good, toxic): how many rows of a part fail just these filters, 32 rows a part at most.

    A row is good or toxic if any label of its id says so. Rows of one id are counted before they meet its
    label, so an id on very many rows costs one row per part and mask.
    """
    flags = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id"))
    flags = flags.agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    counted = masks.groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("rows")).join(flags, "id", "left")
    return counted.groupBy("part", "mask").agg(
        F.sum("rows").alias("rows"), *[F.sum(F.col("rows") * F.coalesce(c, F.lit(0))).alias(c) for c in COUNTED[1:]]
    )


def coalition_removals(counts: DataFrame) -> DataFrame:
    """(part, all, rows, good, toxic): the rows of a part, and for each coalition what fails one of its filters."""
    removed = [
        F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(c)).otherwise(0)) for s in COALITIONS]).alias(c)
        for c in COUNTED
    ]
    return counts.groupBy("part").agg(F.sum("rows").alias("all"), *removed)


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination."""
    rows = [[*row, value] for row, value in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i, row in enumerate(rows):
            if i != k and row[k]:
                rows[i] = [x - row[k] * y for x, y in zip(row, rows[k])]
    return [row[-1] for row in rows]


def shapley(worth: list[int]) -> list[Fraction]:
    """The Shapley value of each player, from the worth of every coalition (bit k: player k; none is worth 0).

    Of all additive worths whose sum is the whole coalition's, the one nearest to ``worth`` in the squares
    weighted by the Shapley kernel; its normal equations, with a multiplier for the sum, are solved in
    rationals.
    """
    players = len(worth).bit_length() - 1
    inner = range(1, len(worth) - 1)
    size = [s.bit_count() for s in range(len(worth))]
    kernel = [Fraction(players - 1, comb(players, size[s]) * size[s] * (players - size[s])) if s in inner else None for s in range(len(worth))]
    has = [[s >> k & 1 for s in range(len(worth))] for k in range(players)]
    normal = [[sum((kernel[s] for s in inner if has[i][s] and has[j][s]), Fraction()) for j in range(players)] for i in range(players)]
    right = [sum((kernel[s] * worth[s] for s in inner if has[i][s]), Fraction()) for i in range(players)]
    matrix = [*([*row, Fraction(1)] for row in normal), [Fraction(1)] * players + [Fraction()]]
    return solved(matrix, [*right, Fraction(worth[-1])])[:-1]


def audit_rows(all_rows: int, rows: list[int], good: list[int], toxic: list[int]) -> Iterator[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders."""
    players, whole = range(len(LETTERS)), len(rows) - 1
    worth = [value * factorial(len(LETTERS)) for value in shapley(rows)]
    for order in permutations(players):
        name, before = "".join(LETTERS[k] for k in order), 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            removed = rows[after] - rows[before]
            yield (
                name, step, all_rows - rows[after], removed, rows[1 << k] - removed, rows[whole] - rows[whole ^ 1 << k],
                good[after] - good[before], toxic[after] - toxic[before], int(worth[k]),
            )
            before = after


def audit_filters(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per part, order of the five filters, and step; see :func:`audit_rows` for the columns.

    Null parts are the part "". Null texts are empty texts, which fail A only, and E where an earlier
    row has one. Rows that repeat an id are rows like others; labels of unknown ids count nothing. A table
    without rows has no parts. Further columns are not read. After the counts a part is one row of 32
    coalitions, and parts are worked out by the tasks that hold them.
    """
    coalitions = coalition_removals(mask_counts(failure_masks(documents, key, text, part), labels, key))
    longs = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in longs)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, total, *tables in frame.itertuples(index=False):
                rows = list(audit_rows(int(total), *[[int(x) for x in t] for t in tables]))
                yield pd.DataFrame([(name, *r) for r in rows], columns=["part", "filter_order", "step", *longs])

    return coalitions.mapInPandas(work, schema)

"""Exact global ranks without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterloom.session import ensure_checkpoint_dir, forget

_ROW_BITS = 33
#: Bounds between which rows are counted in a round, about, and keys that they are taken from.
BOUNDS, SAMPLE = 64, 2048
#: So many rows are ranked without counting between bounds first.
FEW = 100_000
_DRAWS = 1 << 48


def global_rank(
    df: DataFrame, key: str, rank: str = "rank", total: str | None = None, weight: str | None = None
) -> DataFrame:
    """Add the 1-based position of each row in the order of ``key``, a unique column.

    Rows are range-partitioned and sorted, each is numbered inside its
    partition, and partition totals become offsets. The numbered rows are
    checkpointed: range bounds are sampled, and a second run could put them
    elsewhere. The offsets are one row per partition. With ``weight`` the rank
    is the running sum of that column; ``total`` adds the sum over all rows.
    """
    return _ranked(_numbered(df, key, weight), rank, total)


def _numbered(df: DataFrame, key: str, weight: str | None) -> DataFrame:
    """The rows with their range and their place in it, checkpointed."""
    ensure_checkpoint_dir(df.sparkSession)
    spot = F.monotonically_increasing_id()
    numbered = (
        df.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn("_spot", spot)
        .withColumn("_part", F.shiftright("_spot", _ROW_BITS))
        .withColumn("_local", F.col("_spot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1)
        .drop("_spot")
    )
    if weight is not None:
        in_part = Window.partitionBy("_part").orderBy("_local")
        numbered = numbered.withColumn("_local", F.sum(weight).over(in_part))
    return numbered.checkpoint()


def _ranked(numbered: DataFrame, rank: str, total: str | None = None) -> DataFrame:
    sizes = numbered.groupBy("_part").agg(F.max("_local").alias("_size"))
    over_parts = Window.orderBy("_part")
    offsets = sizes.select(
        "_part",
        (F.sum("_size").over(over_parts) - F.col("_size")).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    out = numbered.join(F.broadcast(offsets), "_part").withColumn(rank, F.col("_before") + F.col("_local"))
    if total is not None:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_part", "_local", "_before", "_total")


def _bounds(keys: DataFrame, rows: int) -> list:
    """Some of the keys in order: of about ``SAMPLE`` that a hash picks every ``SAMPLE / BOUNDS``-th, and the most frequent.

    However many rows there are, about ``SAMPLE`` keys and ``BOUNDS`` frequent ones reach the driver.
    """
    drawn = F.pmod(F.xxhash64("key", F.lit("bound")), F.lit(_DRAWS)) < F.lit(max(1, _DRAWS * SAMPLE // max(rows, SAMPLE)))
    sample = sorted(r["key"] for r in keys.where(drawn).distinct().collect())
    often = keys.agg(F.expr(f"approx_top_k(key, {BOUNDS}, {16 * BOUNDS})")).first()[0] or []
    return sorted({*sample[:: max(1, len(sample) // BOUNDS)], *(item["item"] for item in often)})


def _place(bounds: list, lo: int, hi: int) -> Column:
    """How many bounds are below the key, as a tree of comparisons."""
    if lo == hi:
        return F.lit(lo)
    middle = (lo + hi) // 2
    return F.when(F.col("key") <= F.lit(bounds[middle]), _place(bounds, lo, middle)).otherwise(_place(bounds, middle + 1, hi))


def last_of_first_half(keys: DataFrame) -> tuple[bool, object]:
    """(any, last): the greatest key up to which at most half of all rows lie, if there is one; nulls come first.

    ``keys`` has one column ``key``. Rows are counted between bounds taken from the keys themselves, then only
    those between the two bounds around the middle, until few are left or no bound parts them; those alone
    are ranked. A round reads the key column and shuffles a count per bound.
    """
    rows, known = keys.agg(F.count(F.lit(1)), F.count("key")).first()
    half, before, inside, last = rows // 2, rows - known, known, None
    within = keys.where(F.col("key").isNotNull())
    while inside > FEW:
        bounds = _bounds(within, inside)
        counts = dict(within.groupBy(_place(bounds, 0, len(bounds)).alias("place")).agg(F.count(F.lit(1))).collect())
        place, below = 0, before
        while place < len(bounds) and below + counts.get(place, 0) <= half:
            below += counts.get(place, 0)
            place += 1
        if place:
            last = bounds[place - 1]
            within = within.where(F.col("key") > F.lit(last))
        if place < len(bounds):
            within = within.where(F.col("key") <= F.lit(bounds[place]))
        before, shrunk = below, counts.get(place, 0) < inside
        inside = counts.get(place, 0)
        if not shrunk:
            break
    counts = within.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    numbered = _numbered(counts, "key", "_n")
    inner = _ranked(numbered, "_upto").where(F.col("_upto") <= half - before).agg(F.max("key")).first()[0]
    forget(numbered)
    last = last if inner is None else inner
    return last is not None, last


def half_split(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Mark the first half of the rows in key order ``train`` and the rest ``test``.

    Rows that share a key stay on one side; null keys come first. Only the last key of the first half is
    searched for, by counts between bounds, so the rows themselves are neither sorted nor shuffled.
    """
    found, last = last_of_first_half(df.select(F.col(key).alias("key")))
    if not found:
        return df.withColumn(split, F.lit("test"))
    in_train = F.coalesce(F.col(key) <= F.lit(last), F.lit(True))
    return df.withColumn(split, F.when(in_train, "train").otherwise("test"))

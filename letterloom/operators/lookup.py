"""Joins against lookup tables, broadcast only when the table is known to be small."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48
#: A key is split into parts of at most this share of an even partition.
SALT_SHARE = 8


@dataclass(frozen=True)
class Lookup:
    """A lookup table and its measured size."""

    table: DataFrame
    rows: int
    bytes: int
    limit: int = BROADCAST_LIMIT_BYTES

    @property
    def fits(self) -> bool:
        return self.bytes <= self.limit

    def derive(self, table: DataFrame) -> Lookup:
        """A table with some of this one's rows and none that are longer, which cannot be larger."""
        return Lookup(table, self.rows, self.bytes, self.limit)


def measure(table: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> Lookup:
    """Count rows and bytes with one aggregation over the whole table."""
    widths = [_width(field) for field in table.schema.fields]
    per_row = sum(widths, F.lit(ROW_OVERHEAD_BYTES))
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(per_row), F.lit(0))).first()
    return Lookup(table, rows, int(size), limit)


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)).cast("long")
    if isinstance(field.dataType, T.ArrayType):
        return 16 * F.greatest(F.coalesce(F.size(F.col(field.name)), F.lit(0)), F.lit(1)).cast("long")
    return F.lit(16)


def listed_in_row(words: Column, table: DataFrame) -> Column:
    """For each of an array of words its value in a (word, value) table that fits, null where it has none.

    The table goes through the driver to the workers, and an Arrow step looks all words of a batch up at once,
    without a join. Words must not repeat in the table.
    """
    held = table.where(F.col(table.columns[0]).isNotNull()).toArrow()
    known = table.sparkSession.sparkContext.broadcast(tuple(c.combine_chunks() for c in held.columns))
    kind = table.schema.fields[1].dataType

    @F.arrow_udf(T.ArrayType(kind))
    def of(lists: pa.Array) -> pa.Array:
        keys, values = known.value
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(ends, values.take(pc.index_in(lists.flatten(), value_set=keys)))

    return of(words)


def hot_keys(left: DataFrame, on: str, parts: int) -> DataFrame:
    """(key, salts) of the keys that hold more than ``1 / (parts * SALT_SHARE)`` of the rows.

    They are found with a sketch of fixed size over all rows; there are at most ``parts * SALT_SHARE`` of them.
    """
    most = parts * SALT_SHARE
    counted = left.where(F.col(on).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k({on}, {most}, {4 * most})").alias("top")
    )
    share = F.greatest(F.col("rows") / most, F.lit(1))
    salts = counted.select("rows", F.explode("top").alias("top")).select(
        F.col("top.item").alias(on), F.ceil(F.col("top.count") / share).cast("int").alias("_salts")
    )
    # the sketch can only say too much, so no more salts than parts of even size are asked for
    rows = [(r[0], min(r[1], most)) for r in salts.where("_salts > 1").collect()]
    kind = left.schema[on].dataType.simpleString()
    return left.sparkSession.createDataFrame(rows, f"`{on}` {kind}, _salts int")


def lookup_join(left: DataFrame, lookup: Lookup, on: str, how: str) -> DataFrame:
    """``inner``, ``left`` or ``left_semi`` equi-join on one column.

    A small table is broadcast. A larger one is joined by shuffle: the rows of a frequent key are dealt to as
    many salts as its measured share asks for and its lookup row is repeated that often; other keys have
    one. No row is lost. ``left`` is read once more for its frequencies.
    """
    if lookup.fits:
        return left.join(F.broadcast(lookup.table), on, how)
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, on, parts))
    salts, row = F.coalesce("_salts", F.lit(1)), F.xxhash64(*left.columns)
    # null keys meet nothing, so they may go anywhere
    salt = F.when(F.col(on).isNull(), F.pmod(row, F.lit(parts))).otherwise(F.pmod(row, salts)).cast("int")
    salted = left.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    each = F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")
    repeated = lookup.table.join(hot, on, "left").select(*lookup.table.columns, each)
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")

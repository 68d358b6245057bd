"""What several operators share: tables, shared folders, skew-safe joins and ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from letterloom.session import ensure_checkpoint_dir

#: At most so many groups can each hold more than one part in this many of the rows,
#: so a broadcast of such groups has this many rows at most.
HOT_GROUPS = 1_000

#: Rows that one rank window sorts, about.
WINDOW_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(frame: DataFrame) -> DataFrame:
    """The same rows from reliable storage in the folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the checkpoint folder, which executors and driver share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread_by: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row per group, when a group may own a third of the rows.

    Groups with more than ``total / HOT_GROUPS`` rows number ``HOT_GROUPS`` at most: their keys
    are broadcast, their rows salted by ``spread_by`` and their group row repeated per salt. No
    null key matches.
    """
    salts = shuffle_parts(rows.sparkSession)
    large = F.col(size) > max(1, total // HOT_GROUPS)
    hot = groups.where(large).select(key, F.lit(True).alias("_hot"))
    salted = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(0)
    )
    repeated = groups.withColumn(
        "_salt", F.explode(F.when(large, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    )
    return salted.drop("_hot").join(repeated.hint("shuffle_hash"), [key, "_salt"], "left").drop("_salt")


def bucketed_rank(rows: DataFrame, counts: DataFrame, group: str, spread: Column, order: list[str], out: str):
    """Gapless numbers from 0 within each group, as column ``out``, without one task per group.

    ``counts`` has one row (group, n) for a bounded number of groups. A group is dealt into
    ``n / WINDOW_ROWS`` buckets by ``spread``, each bucket numbered on its own and shifted by the
    sizes of those before it. ``rows`` is read twice, so it must give the same rows again.
    """
    buckets = counts.select(group, F.ceil(F.col("n") / WINDOW_ROWS).cast("int").alias("_buckets"))
    dealt = rows.join(F.broadcast(buckets), group).withColumn("_bucket", F.pmod(spread, F.col("_buckets")).cast("int"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order)).cast("long") - 1
    ranked = dealt.withColumn("_place", place).join(starts, [group, "_bucket"])
    return ranked.withColumn(out, F.col("_start") + F.col("_place")).drop("_buckets", "_bucket", "_place", "_start")

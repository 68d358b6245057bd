"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.operators.records import render_message
from letterloom.sources.message_files import MessageFiles


def write_messages(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Snappy Parquet, replacing what is there.

    Before a partitioned write the rows are rebalanced, so that a folder gets a
    few files of even size rather than one from every task, and a large folder
    is written by several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_eml_text(df: DataFrame, path: str, buckets: int = 256) -> None:
    """Every message as text, below a fixed number of hashed folders.

    A message starts with its ``Message-Id`` line, which names it.
    """
    rendered = render_message(df).select(
        F.concat("eml", F.lit("\n")).alias("value"),
        F.pmod(F.xxhash64("message_id"), F.lit(buckets)).alias("bucket"),
    )
    rendered.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").text(path)


def write_files(
    df: DataFrame, content: Column, path: str, suffix: str = ".eml", mode: str = "overwrite", name: Column | None = None
) -> None:
    """A file for each row, with the bytes of ``content``, in folders of bounded size.

    ``name`` names the files, null "unnamed"; rows of one name go to one file, one after the other.
    """
    df.sparkSession.dataSource.register(MessageFiles)
    rows = df.select(content.cast("binary").alias("content"))
    if name is not None:
        rows = df.select(content.cast("binary").alias("content"), F.coalesce(name, F.lit("unnamed")).alias("name"))
        rows = rows.repartition("name").sortWithinPartitions("name")
    rows.write.format("message_files").option("suffix", suffix).mode(mode).save(path)


def write_eml_files(df: DataFrame, path: str) -> None:
    """Every message as an eml file of its own, ended by a blank line; repeated messages too."""
    rendered = render_message(df)
    write_files(rendered, F.concat("eml", F.lit("\n\n")), path)


def write_features(df: DataFrame, path: str) -> None:
    """Sparse rows below ``matrix_date``, ``field`` and ``split`` folders.

    Only the folders of the dates in ``df`` are replaced.
    """
    (
        df.hint("rebalance", "matrix_date", "field", "split")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("matrix_date", "field", "split")
        .parquet(path)
    )

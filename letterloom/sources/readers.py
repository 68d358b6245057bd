"""Sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterloom.schemas import KAFKA_ROW, MESSAGE
from letterloom.sources.message_files import read_files


def read_mail_stream(spark: SparkSession, hosts: str, topic: str) -> DataFrame:
    """A topic from its earliest offset; lost offsets do not stop the query.

    Needs the Kafka connector on the class path.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", hosts)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .load()
    )


def read_file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files with the Kafka row columns, as a stream."""
    reader = spark.readStream.schema(KAFKA_ROW)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_mail_dir(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file below a folder, in the Kafka row shape plus ``path``.

    The path is the key and the modification time the timestamp. Two hashes of
    the path, 96 bits together, stand for partition and offset.
    """
    return read_files(spark, path, glob).select(
        F.col("path").cast("binary").alias("key"),
        F.col("content").alias("value"),
        F.lit("files").alias("topic"),
        F.hash("path").alias("partition"),
        F.xxhash64("path").alias("offset"),
        F.col("modificationTime").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        "path",
    )


def read_messages(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType = MESSAGE
) -> DataFrame:
    """A message table; a path that does not exist is an empty table."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], schema)
    return table.select(*columns) if columns else table


def read_day(
    spark: SparkSession,
    path: str,
    day: dt.date | None = None,
    columns: Sequence[str] = ("subject", "body"),
    by: str = "processed_date",
) -> DataFrame:
    """One ingest day, yesterday unless given; only its folder is read."""
    day = day or dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    return spark.read.parquet(path).where(F.col(by) == F.lit(day)).select(*columns)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A text file with one term per line."""
    return spark.read.text(path).withColumnRenamed("value", "term")

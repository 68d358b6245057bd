"""Streaming ingest: raw messages to tables partitioned by ingest date.

The jobs are stateless and append only. Every trigger cadence gives the same
table, and the same plan serves batch frames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from letterloom.operators.entities import Gazetteer
from letterloom.options import MailOptions
from letterloom.plans.messages import ROW_KEY, accepted_messages, classify_messages, rejected_messages
from letterloom.session import forget

# Fixed value: how often the sink commits.
TRIGGER = "6 minutes"


def _trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A cadence, or everything available and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def write_message_stream(
    messages: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER
) -> StreamingQuery:
    """Append Parquet by ``processed_date``; the file sink commits each row once."""
    writer = (
        messages.writeStream.format("parquet")
        .partitionBy("processed_date")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def write_outcome_stream(
    outcomes: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER
) -> StreamingQuery:
    """Accepted and rejected rows in one pass, kept apart by an ``outcome`` folder."""
    rows = outcomes.select(
        *ROW_KEY,
        *[c for c in accepted_messages(outcomes, null_rows=True).columns],
        "reason",
        F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("outcome"),
    )
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy("outcome", "processed_date")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def ingest_stream(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    options: MailOptions = MailOptions(),
    every: str | None = TRIGGER,
) -> StreamingQuery:
    """Raw stream to the published message table, each row with its position in the source."""
    outcomes = classify_messages(raw, options)
    return write_message_stream(accepted_messages(outcomes, options.null_rows, ROW_KEY), path, checkpoint, every)


def ingest_stream_with_entities(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    options: MailOptions,
    gazetteer: Gazetteer,
    every: str | None = TRIGGER,
) -> StreamingQuery:
    """The same with entity tagging, which joins and so works batch by batch."""
    return ingest_stream_in_batches(raw, path, checkpoint, options, gazetteer, every)


def ingest_stream_in_batches(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    options: MailOptions,
    gazetteer: Gazetteer | None = None,
    every: str | None = TRIGGER,
    rejects: str | None = None,
) -> StreamingQuery:
    """Accepted messages to ``path`` and, if named, the others to ``rejects``, with or without a gazetteer.

    A batch that is run again replaces its own ``batch_id`` folders.
    """
    query = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        tagged_batch_writer(path, options, gazetteer, rejects)
    )
    return _trigger(query, every).start()


def tagged_batch_writer(
    path: str,
    options: MailOptions,
    gazetteer: Gazetteer | None,
    rejects: str | None = None,
    rejected: Callable[[int], None] = lambda batch_id: None,
) -> Callable[[DataFrame, int], None]:
    """What writes a micro-batch; ``rejected`` is called once its rejects are written and before the others are."""

    def put(rows: DataFrame, batch_id: int, folder: str) -> None:
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", "processed_date")
            .parquet(folder)
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        stored: list[DataFrame] = []
        outcomes = classify_messages(batch, options, gazetteer, stored)
        if rejects:
            outcomes = outcomes.persist()  # both writes read it; a part that is lost is made again
            put(rejected_messages(outcomes), batch_id, rejects)
            rejected(batch_id)
        put(accepted_messages(outcomes, options.null_rows, ROW_KEY), batch_id, path)
        outcomes.unpersist()
        for frame in stored:
            forget(frame)

    return write

"""Raw messages to cleaned, validated and optionally anonymised rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.functions.addresses import parse_address, valid_addresses
from letterloom.functions.body import cut_inline, strip_quotes
from letterloom.functions.dates import parse_date
from letterloom.functions.hashing import hash_address
from letterloom.functions.headers import (
    READ_HEADERS,
    clean_subject,
    has_required,
    header_values,
    message_id,
    read_headers,
    split_message,
)
from letterloom.functions.html import html_text
from letterloom.functions.tagging import fill_surrogates, tag_patterns
from letterloom.functions.text import ASCII_WHITESPACE, length_between, valid_text
from letterloom.operators.entities import Gazetteer, tag_entities
from letterloom.operators.mime import with_body_source, with_decoded_headers
from letterloom.options import MailOptions
from letterloom.schemas import MESSAGE_COLUMNS
from letterloom.session import ensure_checkpoint_dir, stage

ROW_KEY = ("topic", "partition", "offset")


def clean_body(text: Column, content_type: Column, options: MailOptions) -> Column:
    """Body after the first gate: markup and quoted history removed."""
    shown = F.when(F.contains(content_type, F.lit("html")), html_text(text)).otherwise(text)
    return strip_quotes(shown)


def _extract(raw: DataFrame, options: MailOptions) -> DataFrame:
    """Message columns and ``reason``, one output row per input row, no shuffle."""
    value = F.col("value")
    if options.strip_payload:
        value = F.btrim(value.cast("string"), F.lit(ASCII_WHITESPACE)).cast("binary")
    df = raw.withColumn("value", value)
    df = df.withColumn("_split", split_message(valid_text(F.col("value"))))
    df = df.withColumn("_raw_headers", read_headers(F.get("_split", F.lit(0))))
    df = df.withColumn("_complete", has_required(F.col("_raw_headers")))
    df = with_decoded_headers(df, "_raw_headers", "_headers")
    df = with_body_source(df, "value", "_split", F.col("_complete"))

    cut = cut_inline(F.col("body_source.text"), options.separator_pattern, options.header_hint_pattern)
    df = df.withColumn("_cut", cut)
    df = df.withColumn(
        "_body",
        F.when(
            length_between(F.col("_cut"), options.pre_gate),
            clean_body(F.col("_cut"), F.col("body_source.content_type"), options),
        ),
    )

    df = df.withColumn("_values", header_values(F.col("_headers")))

    def header(name: str) -> Column:
        return F.get("_values", F.lit(READ_HEADERS.index(name)))

    def protect(address: Column) -> Column:
        if not options.hash_addresses:
            return address
        return hash_address(address, options.salt, options.hash_mode)

    df = df.withColumn(
        "_lists",
        F.transform(
            F.array(header("to"), header("cc"), header("bcc")),
            lambda text: F.coalesce(F.array_join(valid_addresses(text, protect), ", "), F.lit("")),
        ),
    )
    reason = (
        F.when(~F.col("_complete"), "missing_header")
        .when(F.col("body_source.reason").isNotNull(), F.col("body_source.reason"))
        .when(F.col("body_source.text") == "", "no_body")
        .when(F.col("_body").isNull(), "length_pre")
    )
    return df.select(
        *[name for name in raw.columns if name != "value"],
        protect(message_id(header("message-id"), F.col("value"))).alias("message_id"),
        parse_date(header("date")).alias("date"),
        protect(parse_address(header("from"))).alias("from_address"),
        F.get("_lists", F.lit(0)).alias("to_addresses"),
        F.get("_lists", F.lit(1)).alias("cc_addresses"),
        F.get("_lists", F.lit(2)).alias("bcc_addresses"),
        clean_subject(header("subject"), options.anchored_subject).alias("subject"),
        F.col("_body").alias("body"),
        reason.alias("reason"),
    )


def _tag(df: DataFrame, options: MailOptions, gazetteer: Gazetteer | None, stored: list[DataFrame]) -> DataFrame:
    """Entities, then patterns, then surrogates, in subject and body."""
    if gazetteer is not None:
        if not gazetteer.in_row:
            # The frame is read several times below; the parser should run once.
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint()
            stored.append(df)
        df = tag_entities(df, ROW_KEY, ("subject", "body"), gazetteer)
    for name in ("subject", "body"):
        text = tag_patterns(F.col(name), options.number_words)
        if options.fill_surrogates:
            key = F.concat_ws("|", F.lit(name), *ROW_KEY)
            text = fill_surrogates(text, key, options.salt)
        df = df.withColumn(name, text)
    return df


def classify_messages(
    raw: DataFrame,
    options: MailOptions = MailOptions(),
    gazetteer: Gazetteer | None = None,
    stored: list[DataFrame] | None = None,
) -> DataFrame:
    """Every raw row with its message columns, ``processed_date`` and ``reason``.

    ``reason`` is null for an accepted message; the message columns of a
    rejected one are null. The input has the Kafka row columns; others pass
    through, and ``value`` is dropped once it is read. Batch and streaming use this same function; a gazetteer beyond
    its limit needs a batch frame, so a stream passes one inside ``foreachBatch``; the checkpoint that it is tagged
    from is added to ``stored``, to be removed when the outcomes are written.

    The closing ``stage`` counts the outcomes at no extra pass and keeps later
    filters on ``reason`` from evaluating the cleaning expressions again.
    """
    df = _extract(raw, options)
    if options.tag_content:
        df = _tag(df, options, gazetteer, [] if stored is None else stored)
    final = F.coalesce(length_between(F.col("body"), options.final_gate), F.lit(False))
    df = df.withColumn("reason", F.coalesce(F.col("reason"), F.when(~final, "length_final")))
    accepted = F.col("reason").isNull()
    df = df.select(
        *[name for name in raw.columns if name != "value"],
        *[F.when(accepted, F.col(name)).alias(name) for name in MESSAGE_COLUMNS],
        F.to_date("timestamp").alias("processed_date"),
        "reason",
    )
    return stage(df, "messages", F.count("reason").alias("rejected"))


def accepted_messages(outcomes: DataFrame, null_rows: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The published table. ``null_rows`` keeps rejects as rows of nulls."""
    rows = outcomes if null_rows else outcomes.where(F.col("reason").isNull())
    return rows.select(*keep, *MESSAGE_COLUMNS, "processed_date")


def rejected_messages(outcomes: DataFrame) -> DataFrame:
    """The reject table: where the message came from and why it was left out."""
    return outcomes.where(F.col("reason").isNotNull()).select(
        *ROW_KEY, "timestamp", "processed_date", "reason"
    )

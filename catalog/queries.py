"""One query per operator, over the whole of the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.functions.addresses import is_address, parse_address, parse_address_list
from letterloom.functions.body import cut_inline, strip_quotes
from letterloom.functions.dates import parse_date
from letterloom.functions.hashing import hash_address, keyed_hash
from letterloom.functions.headers import (
    READ_HEADERS,
    all_headers,
    clean_subject,
    has_required,
    header_value,
    message_id,
    split_message,
)
from letterloom.functions.html import html_text
from letterloom.functions.tagging import EMAIL, URL, count_pattern, fill_surrogates, number_pattern, tag_patterns
from letterloom.functions.text import length_between, strip_punctuation, valid_text
from letterloom.operators.bow import bow_counts, bow_vectors, long_texts
from letterloom.operators.entities import tag_entities
from letterloom.operators.mime import explode_parts, with_body_source
from letterloom.operators.ranking import global_rank, half_split
from letterloom.operators.recipients import explode_recipients
from letterloom.operators.records import date_text, flat_record, render_message, tidy
from letterloom.operators.tokens import add_lemmas, explode_tokens, filter_tokens, processed_text
from letterloom.operators.vocabulary import build_vocabulary
from letterloom.options import FINAL_GATE, PRE_GATE, MailOptions
from letterloom.plans.features import daily_features
from letterloom.plans.messages import accepted_messages, classify_messages, clean_body, rejected_messages
from letterloom.schemas import MESSAGE_COLUMNS
from letterloom.session import apply_runtime_conf, work_path
from letterloom.sources.readers import read_day, read_mail_dir, read_messages, read_vocabulary
from letterloom.sources.writers import write_eml_files, write_features, write_files, write_messages
from letterloom.streaming.ingest import ingest_stream, tagged_batch_writer, write_outcome_stream

from catalog.mail import REPLY, as_kafka_rows, mail_documents, mail_raw, read_documents
from catalog.tables import (
    SALT,
    benchmark_gazetteer,
    benchmark_terms,
    lemma_lookup,
    mail_headers,
    titled,
    vocabulary_lookup,
)

EVENT_DAY = dt.date(2024, 1, 15)
MATRIX_DAY = dt.date(2024, 2, 1)
#: A run of what is no word break, with an "@" in it.
WORD_WITH_AT = r"""(?<![^ \n\t,;<>()"'])[^ \n\t,;<>()"'@]*+@[^ \n\t,;<>()"']*+"""
QUERIES = {}


def query(function):
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_runtime_conf(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that both engines compare the same type."""
    return df.select(
        *[
            (date_text(F.col(n)) if t == "timestamp" else F.col(n).cast("string") if t == "date" else F.col(n)).alias(n)
            for n, t in df.dtypes
        ]
    )


def _numbers(values: str) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("long").cast("string")), " ")


def _messages(spark: SparkSession, sf_dir: str, options: MailOptions = MailOptions()) -> DataFrame:
    return classify_messages(mail_raw(spark, sf_dir), options)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_documents(read_documents(spark, sf_dir)).select("doc_id", "full_text")


def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of files: only as a pattern may the path be either."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    return as_kafka_rows(spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]"))


# sources and sinks


@query
def stream_ingest(spark, sf_dir):
    path = work_path(spark, "stream")
    job = ingest_stream(_document_stream(spark, sf_dir), f"{path}/table", f"{path}/checkpoint", every=None)
    job.awaitTermination()
    return _plain(spark.read.parquet(f"{path}/table").select(*MESSAGE_COLUMNS, "processed_date"))


@query
def stream_outcomes(spark, sf_dir):
    path = work_path(spark, "outcomes")
    outcomes = classify_messages(_document_stream(spark, sf_dir))
    write_outcome_stream(outcomes, f"{path}/table", f"{path}/checkpoint", every=None).awaitTermination()
    table = spark.read.parquet(f"{path}/table")
    return table.select(F.col("offset").alias("doc_id"), "outcome", "reason", F.length("body").cast("long").alias("n"))


@query
def stream_restart(spark, sf_dir):
    """A stream that breaks off between the rejects and the accepted rows of a batch, and is started again."""
    path = work_path(spark, "restart")

    def stop(batch_id: int) -> None:
        raise InterruptedError(f"after the rejects of batch {batch_id}")

    for rejected in (stop, lambda batch_id: None):
        writer = tagged_batch_writer(f"{path}/accepted", MailOptions(), None, f"{path}/rejects", rejected)
        stream = _document_stream(spark, sf_dir).writeStream.option("checkpointLocation", f"{path}/checkpoint")
        job = stream.foreachBatch(writer).trigger(availableNow=True).start()
        try:
            job.awaitTermination()
        except StreamingQueryException as broken:
            if "after the rejects" not in str(broken):
                raise
    accepted, rejects = (spark.read.parquet(f"{path}/{name}") for name in ("accepted", "rejects"))
    return accepted.select(
        F.col("offset").alias("doc_id"),
        F.lit("accepted").alias("outcome"),
        F.lit(None).cast("string").alias("reason"),
        F.length("body").cast("long").alias("n"),
    ).unionByName(
        rejects.select(F.col("offset").alias("doc_id"), F.lit("rejected").alias("outcome"), "reason", F.lit(None).cast("long").alias("n"))
    )


@query
def dir_ingest(spark, sf_dir):
    """Every message as a file of its own, read back from the folder tree."""
    path = work_path(spark, "files")
    mail = mail_raw(spark, sf_dir)
    line = F.concat(F.coalesce(F.col("value").cast("string"), F.lit("")), F.lit("\n"))
    write_files(mail, line, path, ".txt", name=F.concat_ws("", F.lit("doc_id="), F.col("doc_id").cast("string")))
    outcomes = classify_messages(read_mail_dir(spark, path, "*.txt"), MailOptions(strip_payload=False))
    doc_id = F.regexp_extract("path", r"doc_id=(-?\d+)", 1).try_cast("long")
    return outcomes.select(doc_id.alias("doc_id"), "message_id", "subject", "reason", F.sha2("body", 256).alias("body_hash"))


@query
def eml_files(spark, sf_dir):
    """Accepted messages written as eml files and read back as mail."""
    path = work_path(spark, "eml")
    write_eml_files(accepted_messages(_messages(spark, sf_dir)), path)
    read = read_mail_dir(spark, path, "*.eml").select(F.col("value").cast("string").alias("eml"))
    return read.groupBy(F.sha2("eml", 256).alias("eml_hash")).agg(F.count(F.lit(1)).alias("files"))


@query
def day_partition_scan(spark, sf_dir):
    path = work_path(spark, "days")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    write_messages(events.withColumn("processed_date", F.to_date("ts")), path, ["processed_date"])
    return read_day(spark, path, EVENT_DAY, ("event_id", "event_type"))


@query
def column_scan(spark, sf_dir):
    return read_messages(spark, f"{sf_dir}/documents.parquet", ["doc_id", "lang"])


@query
def parquet_roundtrip(spark, sf_dir):
    path = work_path(spark, "messages")
    write_messages(accepted_messages(_messages(spark, sf_dir), keep=("doc_id",)), path)
    return _plain(read_messages(spark, path, ["doc_id", *MESSAGE_COLUMNS]))


@query
def eml_render(spark, sf_dir):
    return render_message(accepted_messages(_messages(spark, sf_dir), keep=("doc_id",))).select("doc_id", "eml")


@query
def feature_export(spark, sf_dir):
    path = work_path(spark, "features")
    features = daily_features(
        titled(read_documents(spark, sf_dir)), vocabulary_lookup(spark, sf_dir), lemma_lookup(spark), MATRIX_DAY,
        key="doc_id", unique=True,
    )
    write_features(features, path)
    return spark.read.parquet(path).select(
        F.col("row_id").alias("doc_id"),
        F.col("matrix_date").cast("string").alias("matrix_date"),
        "field",
        "split",
        _numbers("indices").alias("indices"),
        _numbers("values").alias("counts"),
    )


@query
def feature_rows(spark, sf_dir):
    """Features of messages whose ids repeat, each named by its position in the source."""
    path = work_path(spark, "feature-rows")
    messages = titled(read_documents(spark, sf_dir)).select(
        F.lit("documents").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.expr("cast(doc_id div 3 as string)").alias("message_id"),
        "subject",
        "body",
    )
    write_features(
        daily_features(messages, vocabulary_lookup(spark, sf_dir), lemma_lookup(spark), MATRIX_DAY), path
    )
    return spark.read.parquet(path).select(
        "row_id", "message_id", "field", "split", _numbers("indices").alias("indices"), _numbers("values").alias("counts")
    )


# streaming steps


@query
def payload_decode(spark, sf_dir):
    return mail_raw(spark, sf_dir).select("doc_id", valid_text(F.col("value")).alias("text"))


@query
def message_records(spark, sf_dir):
    return _plain(_messages(spark, sf_dir).select("doc_id", *MESSAGE_COLUMNS, "processed_date", "reason"))


@query
def message_null_rows(spark, sf_dir):
    rows = accepted_messages(_messages(spark, sf_dir), null_rows=True, keep=("doc_id",))
    return _plain(rows.select("doc_id", "message_id", "processed_date"))


@query
def messages_hashed(spark, sf_dir):
    options = MailOptions(hash_addresses=True, salt=SALT)
    rows = accepted_messages(_messages(spark, sf_dir, options), keep=("doc_id",))
    return rows.select("doc_id", "message_id", "from_address", "to_addresses", "cc_addresses", "bcc_addresses")


@query
def messages_anonymised(spark, sf_dir):
    """Hashed addresses, tagged entities and patterns, and surrogates for the tags."""
    options = MailOptions(tag_content=True, fill_surrogates=True, hash_addresses=True, salt=SALT)
    outcomes = classify_messages(mail_raw(spark, sf_dir), options, benchmark_gazetteer(spark, sf_dir))
    return _plain(accepted_messages(outcomes, keep=("doc_id",)))


@query
def ingest_date(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", F.to_date("ts").cast("string").alias("processed_date"))


@query
def rejects_by_reason(spark, sf_dir):
    rejects = rejected_messages(_messages(spark, sf_dir))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def accepted_by_day(spark, sf_dir):
    accepted = accepted_messages(_messages(spark, sf_dir))
    by_day = accepted.groupBy("processed_date").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.length("body")).alias("characters")
    )
    return _plain(by_day)


# headers


@query
def header_explode(spark, sf_dir):
    split = split_message(valid_text(F.col("value")))
    headers = all_headers(F.get(split, F.lit(0)))
    return mail_raw(spark, sf_dir).select("doc_id", F.inline(headers))


@query
def header_last_wins(spark, sf_dir):
    df = mail_headers(spark, sf_dir)
    return df.select(
        "doc_id", *[header_value(F.col("raw"), n).alias(n.replace("-", "_") + "_header") for n in READ_HEADERS]
    )


@query
def required_headers(spark, sf_dir):
    return mail_headers(spark, sf_dir).select("doc_id", has_required(F.col("raw")).alias("complete"))


@query
def header_decode(spark, sf_dir):
    return mail_headers(spark, sf_dir).select("doc_id", F.col("subject").alias("subject_header"))


@query
def from_address(spark, sf_dir):
    return mail_headers(spark, sf_dir).select("doc_id", parse_address(F.col("from")).alias("address"))


@query
def recipient_list(spark, sf_dir):
    df = mail_headers(spark, sf_dir)
    return df.select(
        "doc_id",
        *[F.array_join(parse_address_list(F.col(n)), ", ").alias(f"{n}_list") for n in ("to", "cc", "bcc")],
    )


@query
def recipients_long(spark, sf_dir):
    rows = explode_recipients(mail_headers(spark, sf_dir), "doc_id", to="to", cc="cc", bcc="bcc")
    return rows.withColumn("pos", F.col("pos").cast("long"))


@query
def address_valid(spark, sf_dir):
    # the words with an "@" are cut out at once; no other can be an address
    words = F.regexp_extract_all("full_text", F.lit(WORD_WITH_AT), F.lit(0))
    valid = F.size(F.filter(words, is_address)).cast("long")
    return _texts(spark, sf_dir).select("doc_id", valid.alias("valid"))


@query
def date_parse(spark, sf_dir):
    return mail_headers(spark, sf_dir).select("doc_id", date_text(parse_date(F.col("date"))).alias("sent"))


@query
def subject_clean(spark, sf_dir):
    return mail_headers(spark, sf_dir).select("doc_id", clean_subject(F.col("subject")).alias("subject"))


@query
def message_ids(spark, sf_dir):
    df = mail_headers(spark, sf_dir)
    return df.select("doc_id", message_id(F.col("message-id"), F.col("value")).alias("message_id"))


# bodies


@query
def mime_parts(spark, sf_dir):
    parts = explode_parts(mail_raw(spark, sf_dir), "doc_id", "value")
    return parts.select(
        "doc_id",
        *[F.col(n).cast("long").alias(n) for n in ("part_no", "depth", "parent")],
        "content_type",
        "charset",
        "payload",
        "error",
    )


def _body_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_body_source(mail_headers(spark, sf_dir), "value", "split", has_required(F.col("raw")))
    return df.select("doc_id", "body_source.*")


@query
def core_body(spark, sf_dir):
    return _body_source(spark, sf_dir).select("doc_id", "content_type", "reason")


@query
def body_decode(spark, sf_dir):
    return _body_source(spark, sf_dir).select("doc_id", F.col("text"))


@query
def body_clean(spark, sf_dir):
    df = _body_source(spark, sf_dir).withColumn("cut", cut_inline(F.col("text")))
    passed = df.where(length_between(F.col("cut"), PRE_GATE))
    return passed.select("doc_id", clean_body(F.col("cut"), F.col("content_type"), MailOptions()).alias("body"))


@query
def inline_cut(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", cut_inline(F.col("full_text")).alias("body"))


@query
def length_gate_pre(spark, sf_dir):
    gate = length_between(cut_inline(F.col("full_text")), PRE_GATE)
    return _texts(spark, sf_dir).select("doc_id", gate.alias("passes"))


@query
def length_gate_final(spark, sf_dir):
    return read_documents(spark, sf_dir).select("doc_id", length_between(F.col("text"), FINAL_GATE).alias("passes"))


@query
def html_to_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", html_text(F.col("html")).alias("text"))


@query
def quote_strip(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", strip_quotes(F.col("full_text")).alias("body"))


@query
def reply_strip(spark, sf_dir):
    """Replies that answer between the lines they quote."""
    return read_documents(spark, sf_dir).select("doc_id", strip_quotes(F.expr(REPLY)).alias("body"))


# anonymisation


@query
def salted_hash(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", keyed_hash(F.col("full_text"), SALT).alias("hash"))


@query
def salted_hash_pbkdf2(spark, sf_dir):
    """SQL has no SHA-512: it checks the hashes' form and that they are equal where texts are."""
    rows = _texts(spark, sf_dir).select("doc_id", keyed_hash(F.col("full_text"), SALT, "pbkdf2").alias("hash"))
    first = rows.groupBy("hash").agg(F.min("doc_id").alias("first_doc_id"))
    formed = F.coalesce(F.col("hash"), F.lit("")).rlike("^[0-9a-f]{16}$").alias("formed")
    return rows.join(first, "hash").select("doc_id", formed, "first_doc_id")


@query
def address_hash(spark, sf_dir):
    address = parse_address(F.col("from"))
    return mail_headers(spark, sf_dir).select("doc_id", hash_address(address, SALT).alias("address"))


@query
def entity_tag(spark, sf_dir):
    documents = read_documents(spark, sf_dir).select("doc_id", "text")
    return tag_entities(documents, ["doc_id"], ["text"], benchmark_gazetteer(spark, sf_dir))


@query
def pattern_tag(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", tag_patterns(F.col("full_text")).alias("text"))


@query
def pii_counts(spark, sf_dir):
    bare = F.regexp_replace(F.regexp_replace("text", EMAIL, ""), URL, "")
    counts = read_documents(spark, sf_dir).select(
        "lang",
        count_pattern(F.col("text"), EMAIL).alias("emails"),
        count_pattern(F.regexp_replace("text", EMAIL, ""), URL).alias("urls"),
        count_pattern(bare, number_pattern(words=False)).alias("numbers"),
    )
    return counts.groupBy("lang").agg(*[F.sum(n).alias(n) for n in ("emails", "urls", "numbers")])


@query
def surrogate_fill(spark, sf_dir):
    tagged = tag_patterns(F.col("full_text"))
    return _texts(spark, sf_dir).select("doc_id", fill_surrogates(tagged, F.col("doc_id"), SALT).alias("text"))


# records


@query
def flat_records(spark, sf_dir):
    df = mail_documents(read_documents(spark, sf_dir))

    def listed(name: str) -> Column:
        return F.split(name, ", ")

    record = df.select(
        "doc_id",
        F.col("id_value").alias("message_id"),
        F.when(F.col("date_value").isNotNull(), F.timestamp_seconds("sent_secs")).alias("date"),
        F.col("from_value").alias("from_address"),
        listed("to_value").alias("to_addresses"),
        listed("cc_value").alias("cc_addresses"),
        F.when(F.col("bcc_value").isNull(), F.array(F.lit(""), F.lit(""))).otherwise(listed("bcc_value")).alias("bcc_addresses"),
        F.col("title").alias("subject"),
        F.col("text").alias("body"),
    )
    return flat_record(record, keep=["doc_id"])


@query
def tidy_rows(spark, sf_dir):
    df = mail_documents(read_documents(spark, sf_dir))
    return tidy(df.select("doc_id", F.col("lead").alias("subject"), F.col("first_subject").alias("draft")), ["subject"])


# features


@query
def vocab_build(spark, sf_dir):
    path = work_path(spark, "vocabulary")
    benchmark_terms(spark, sf_dir).write.text(path)
    return build_vocabulary(read_vocabulary(spark, path))


@query
def vocab_from_documents(spark, sf_dir):
    tokens = explode_tokens(read_documents(spark, sf_dir), ("doc_id",), ("text",))
    return build_vocabulary(tokens, "token")


@query
def punct_strip(spark, sf_dir):
    return read_documents(spark, sf_dir).select("doc_id", strip_punctuation(F.col("text")).alias("text"))


@query
def tokens(spark, sf_dir):
    rows = explode_tokens(titled(read_documents(spark, sf_dir)), ("doc_id",), ("subject", "body"))
    return rows.groupBy("doc_id", "field", "token").agg(F.count(F.lit(1)).alias("cnt"))


def _lemmatised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_tokens(titled(read_documents(spark, sf_dir)), ("doc_id",), ("subject", "body"))
    return add_lemmas(rows, lemma_lookup(spark))


@query
def lemmatize(spark, sf_dir):
    return _lemmatised(spark, sf_dir).groupBy("token", "lemma").agg(F.count(F.lit(1)).alias("cnt"))


@query
def token_filter(spark, sf_dir):
    kept = filter_tokens(_lemmatised(spark, sf_dir), vocabulary_lookup(spark, sf_dir))
    return kept.groupBy("doc_id", "field", "lemma").agg(F.count(F.lit(1)).alias("cnt"))


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_text(
        titled(read_documents(spark, sf_dir)), ("doc_id",), ("subject", "body"), lemma_lookup(spark),
        vocabulary_lookup(spark, sf_dir),
    )


@query
def processed_texts(spark, sf_dir):
    return _processed(spark, sf_dir)


@query
def bow_count(spark, sf_dir):
    texts = long_texts(titled(read_documents(spark, sf_dir)), ("doc_id",), ("subject", "body"))
    return bow_counts(texts, ("doc_id",), vocabulary_lookup(spark, sf_dir))


@query
def bow_sparse(spark, sf_dir):
    texts = long_texts(titled(read_documents(spark, sf_dir)), ("doc_id",), ("subject", "body"))
    vectors = bow_vectors(texts, ("doc_id",), vocabulary_lookup(spark, sf_dir), in_row=True)
    return vectors.select("doc_id", "field", _numbers("indices").alias("indices"), _numbers("values").alias("counts"))


@query
def conversation_bow(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    texts = long_texts(turns, ("conv_id", "turn"), ("text",))
    counts = bow_counts(texts, ("conv_id", "turn"), vocabulary_lookup(spark, sf_dir))
    return counts.groupBy("conv_id", "idx").agg(F.sum("cnt").alias("cnt"))


@query
def order_rank(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    return global_rank(orders, "o_orderkey", total="orders")


@query
def split_halves(spark, sf_dir):
    return half_split(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id"), "doc_id")

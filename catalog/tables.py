"""Small tables and derived columns the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.functions.headers import READ_HEADERS, header_value, read_headers, split_message
from letterloom.functions.text import valid_text
from letterloom.functions.tokens import words
from letterloom.operators.entities import Gazetteer, read_gazetteer
from letterloom.operators.lookup import Lookup, measure
from letterloom.operators.mime import with_decoded_headers
from letterloom.operators.vocabulary import build_vocabulary

from catalog.mail import mail_raw

SALT = "test salt"

# Irregular forms and their lemmas.
LEMMAS = {
    "is": "be", "are": "be", "was": "be", "were": "be", "been": "be", "am": "be",
    "has": "have", "had": "have", "did": "do", "does": "do", "done": "do", "went": "go",
    "gone": "go", "said": "say", "made": "make", "men": "man", "women": "woman",
    "children": "child", "feet": "foot", "better": "good",
}


def lemma_lookup(spark: SparkSession) -> Lookup:
    return measure(spark.createDataFrame(list(LEMMAS.items()), "token string, lemma string"))


def benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return items.select(F.explode(words(F.col("text"))).alias("term"))


def vocabulary_lookup(spark: SparkSession, sf_dir: str) -> Lookup:
    return measure(build_vocabulary(benchmark_terms(spark, sf_dir)))


def benchmark_gazetteer(spark: SparkSession, sf_dir: str) -> Gazetteer:
    """Three words from a capital letter on, anywhere in a benchmark item, as names of one, two and three words."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    word = r"[\p{L}\p{N}_]+"
    runs = F.regexp_extract_all("text", F.lit(rf"\p{{Lu}}[\p{{L}}\p{{N}}_]* {word} {word}"), F.lit(0))
    items = items.select(F.explode(runs).alias("run"))
    parts = F.split("run", " ")
    names = F.array(
        F.struct(F.get(parts, F.lit(0)).alias("surface"), F.lit("PERSON").alias("label")),
        F.struct(
            F.concat_ws(" ", F.get(parts, F.lit(1)), F.get(parts, F.lit(2))).alias("surface"),
            F.lit("GPE").alias("label"),
        ),
        F.struct(F.col("run").alias("surface"), F.lit("ORG").alias("label")),
    )
    return read_gazetteer(items.select(F.inline(names)))


def titled(documents: DataFrame) -> DataFrame:
    """(doc_id, subject, body): the first sentence and the whole text."""
    return documents.select(
        "doc_id", F.split_part("text", F.lit("."), F.lit(1)).alias("subject"), F.col("text").alias("body")
    )


def mail_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, value, split, and one decoded column per header that is read."""
    df = mail_raw(spark, sf_dir).select("doc_id", "value")
    df = df.withColumn("split", split_message(valid_text(F.col("value"))))
    df = df.withColumn("raw", read_headers(F.get("split", F.lit(0))))
    df = with_decoded_headers(df, "raw", "decoded")
    return df.select(
        "doc_id",
        "value",
        "split",
        "raw",
        *[header_value(F.col("decoded"), name).alias(name) for name in READ_HEADERS],
    )

"""Texts to vocabulary tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.functions.tokens import counted, keeps, plural_stem, words
from letterloom.operators.lookup import Lookup, lookup_join


def explode_tokens(df: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, field, pos, token), one row per token; no text gives one empty token."""
    lists = F.array(*[F.struct(F.lit(f).alias("field"), words(F.col(f)).alias("list")) for f in fields])
    return df.select(*key, F.inline(lists)).select(*key, "field", F.posexplode("list").alias("pos", "token"))


def explode_token_counts(df: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, field, pos, token, cnt), one row per distinct token of a text; ``pos`` numbers those."""
    lists = F.array(*[F.struct(F.lit(f).alias("field"), counted(words(F.col(f))).alias("list")) for f in fields])
    rows = df.select(*key, F.inline(lists)).select(*key, "field", F.posexplode("list").alias("pos", "entry"))
    return rows.select(*key, "field", "pos", F.col("entry.word").alias("token"), F.col("entry.cnt").alias("cnt"))


def add_lemmas(tokens: DataFrame, lemmas: Lookup) -> DataFrame:
    """Add ``lemma``: the listed one, else the token without its plural ending."""
    listed = lookup_join(tokens, lemmas, "token", "left")
    return listed.withColumn("lemma", F.lower(F.coalesce("lemma", plural_stem(F.col("token")))))


def filter_tokens(lemmatised: DataFrame, vocabulary: Lookup) -> DataFrame:
    """Rows whose token counts and whose lemma is in the vocabulary."""
    usable = lemmatised.where(keeps(F.col("token"), F.col("lemma")))
    terms = vocabulary.derive(vocabulary.table.select(F.col("term").alias("lemma")))
    return lookup_join(usable, terms, "lemma", "left_semi")


def processed_text(
    df: DataFrame, key: Sequence[str], fields: Sequence[str], lemmas: Lookup, vocabulary: Lookup
) -> DataFrame:
    """(key, field, text): the kept lemmas in order; a text without any is empty.

    The first token of a text stays even if it does not count, so that every
    text keeps its row without a second join.
    """
    tokens = add_lemmas(explode_tokens(df, key, fields), lemmas)
    usable = tokens.withColumn("lemma", F.when(keeps(F.col("token"), F.col("lemma")), F.col("lemma")))
    terms = vocabulary.derive(
        vocabulary.table.select(F.col("term").alias("lemma"), F.lit(True).alias("known"))
    )
    marked = lookup_join(usable.select(*key, "field", "pos", "lemma"), terms, "lemma", "left")
    marked = marked.where(F.col("known") | (F.col("pos") == 0))
    ordered = F.array_sort(F.collect_list(F.when(F.col("known"), F.struct("pos", "lemma"))))
    return marked.groupBy(*key, "field").agg(
        F.array_join(F.transform(ordered, lambda t: t["lemma"]), " ").alias("text")
    )

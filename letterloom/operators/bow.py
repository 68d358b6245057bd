"""Bag-of-words counts on a fixed vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.functions.text import bind, fold_accents
from letterloom.functions.tokens import counted, keeps, plural_stem, words
from letterloom.operators.lookup import Lookup, listed_in_row, lookup_join, measure

# Words of two characters or more.
WORD = r"[\p{L}\p{N}_]{2,}"


def fold_vocabulary(vocabulary: Lookup) -> Lookup:
    """(word, idx) with accents dropped as in the texts.

    Terms that fold to one word share the lowest of their indices.
    """
    folded = vocabulary.table.groupBy(fold_accents(F.col("term")).alias("word")).agg(F.min("idx").alias("idx"))
    return vocabulary.derive(folded)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(fold_accents(text), F.lit(WORD), F.lit(0))


def _counted_words(texts: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, field, pos, word, cnt): the distinct words of each text, counted in its own row; a text without any has one row."""
    generator = F.posexplode_outer(counted(_words(F.col("text")))).alias("pos", "entry")
    return texts.select(*key, "field", generator).select(*key, "field", "pos", "entry.*")


def bow_counts(texts: DataFrame, key: Sequence[str], vocabulary: Lookup) -> DataFrame:
    """(key, field, idx, cnt) with the zero counts left out.

    ``texts`` has (key, field, text). Known words are counted in each task before the shuffle. The outer
    explode keeps Catalyst from cutting each text twice, once in a filter on the number of words.
    """
    rows = texts.select(*key, "field", F.explode_outer(_words(F.col("text"))).alias("word"))
    hits = lookup_join(rows, fold_vocabulary(vocabulary), "word", "inner")
    return hits.groupBy(*key, "field", "idx").agg(F.count(F.lit(1)).alias("cnt"))


def _sparse_rows(indexed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of (key, field, idx, cnt) to sparse rows; a null index only keeps its text.

    Dealt by text once: both aggregations then find their rows in place.
    """
    summed = indexed.repartition(*key, "field").groupBy(*key, "field", "idx").agg(F.sum("cnt").alias("cnt"))
    cells = F.array_sort(F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("idx", "cnt"))))
    return (
        summed.groupBy(*key, "field")
        .agg(cells.alias("cells"))
        .select(
            *key,
            "field",
            F.transform("cells", lambda c: c["idx"]).alias("indices"),
            F.transform("cells", lambda c: c["cnt"].cast("float")).alias("values"),
        )
    )


def _merged_rows(texts: DataFrame, key: Sequence[str], cells: str) -> DataFrame:
    """Rows of (key, field, cells of (idx, cnt)) to sparse rows, those of one key and field together.

    What is shuffled and held is a row per text, not one per word.
    """

    def summed(ordered: Column) -> Column:
        size = F.size(ordered)
        places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i)["idx"] != F.get(ordered, i - 1)["idx"]))

        def entries(starts: Column) -> Column:
            def entry(at: Column, k: Column) -> Column:
                run = F.slice(ordered, at + 1, F.coalesce(F.get(starts, k + 1), size) - at)
                total = F.aggregate(run, F.lit(0).cast("long"), lambda n, c: n + c["cnt"])
                return F.struct(F.get(ordered, at)["idx"].cast("long").alias("idx"), total.alias("cnt"))

            return F.transform(starts, entry)

        return bind(starts, entries)

    grouped = texts.repartition(*key, "field").groupBy(*key, "field").agg(F.collect_list(cells).alias("parts"))
    whole = grouped.select(*key, "field", bind(F.array_sort(F.flatten("parts")), summed).alias("cells"))
    return whole.select(
        *key,
        "field",
        F.transform("cells", lambda c: c["idx"]).alias("indices"),
        F.transform("cells", lambda c: c["cnt"].cast("float")).alias("values"),
    )


def _cell(idx: Column, cnt: Column) -> Column:
    return F.struct(idx.cast("int").alias("idx"), cnt.cast("int").alias("cnt"))


def bow_vectors(texts: DataFrame, key: Sequence[str], vocabulary: Lookup, in_row: bool = False) -> DataFrame:
    """(key, field, indices, values): one sparse row per text, empty ones included.

    With ``in_row`` a vocabulary within its limit is looked up in the text's row, and a row per text is shuffled.
    Else words are joined: of those that are not known only one a text is kept until the shuffle, for the
    text's row.
    """
    if in_row and vocabulary.fits:
        folded = fold_vocabulary(vocabulary).table
        counts = texts.select(*key, "field", counted(F.coalesce(_words(F.col("text")), F.array().cast("array<string>"))).alias("words"))
        found = counts.withColumn("idxs", listed_in_row(F.transform("words", lambda w: w["word"]), folded))
        paired = F.zip_with("words", "idxs", lambda w, idx: F.when(idx.isNotNull(), _cell(idx, w["cnt"])))
        return _merged_rows(found.withColumn("cells", F.array_compact(paired)), key, "cells")
    found = lookup_join(_counted_words(texts, key), fold_vocabulary(vocabulary), "word", "left")
    needed = found.where(F.col("idx").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0))
    return _sparse_rows(needed.select(*key, "field", "idx", "cnt"), key)


def _term_indices(vocabulary: Lookup) -> Lookup:
    """(lemma, idxs): the indices a term counts for when it stands in a text."""
    parts = vocabulary.table.select("term", F.explode_outer(_words(F.col("term"))).alias("word"))
    known = parts.join(fold_vocabulary(vocabulary).table, "word", "left")
    return measure(
        known.groupBy(F.col("term").alias("lemma")).agg(F.collect_list("idx").alias("idxs")), vocabulary.limit
    )


def lemma_vectors(lemmatised: DataFrame, key: Sequence[str], vocabulary: Lookup) -> DataFrame:
    """Sparse rows straight from (key, field, pos, token, cnt, lemma), the counted tokens of each text.

    The same as counting the processed texts, without putting the texts
    together: a kept lemma counts for the words it would have in the text.
    """
    usable = F.when(keeps(F.col("token"), F.col("lemma")), F.col("lemma"))
    rows = lemmatised.select(*key, "field", "pos", "cnt", usable.alias("lemma"))
    found = lookup_join(rows, _term_indices(vocabulary), "lemma", "left")
    counting = found.where((F.size("idxs") > 0) | (F.col("pos") == 0))
    return _sparse_rows(counting.select(*key, "field", "cnt", F.explode_outer("idxs").alias("idx")), key)


def lemma_vectors_in_row(texts: DataFrame, key: Sequence[str], lemmas: Lookup, vocabulary: Lookup) -> DataFrame:
    """The same from (key, field, text), for lemmas and a vocabulary that fit: both are looked up in the text's row."""
    counts = texts.select(*key, "field", counted(words(F.col("text"))).alias("tokens"))
    named = lemmas.table.groupBy("token").agg(F.min("lemma").alias("lemma"))
    counts = counts.withColumn("listed", listed_in_row(F.transform("tokens", lambda t: t["word"]), named))
    lemma = F.zip_with("tokens", "listed", lambda t, listed: F.lower(F.coalesce(listed, plural_stem(t["word"]))))
    counts = counts.withColumn("lemmas", lemma)
    terms = _term_indices(vocabulary).table.select("lemma", F.transform("idxs", lambda i: i.cast("int")).alias("idxs"))
    counts = counts.withColumn("idxs", listed_in_row(F.col("lemmas"), terms))
    known = F.filter(F.arrays_zip("tokens", "lemmas", "idxs"), lambda t: F.size(t["idxs"]) > 0)
    usable = F.filter(known, lambda t: keeps(t["tokens"]["word"], t["lemmas"]))
    cells = F.flatten(F.transform(usable, lambda t: F.transform(t["idxs"], lambda i: _cell(i, t["tokens"]["cnt"]))))
    return _merged_rows(counts.select(*key, "field", cells.alias("cells")), key, "cells")


def long_texts(df: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, field, text) from one text column per field."""
    return df.select(
        *key, F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]))
    )

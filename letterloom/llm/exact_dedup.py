"""Exact deduplication by 128-bit content hash, with a byte comparison inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.llm.common import cut, join_groups


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits as binary."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(
    documents: DataFrame, key: str = "doc_id", text: str = "text", hashed: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256): one row per document.

    Texts are equal when their bytes are after :func:`normalised`; of equal texts the smallest key
    stays. Null texts are empty texts and equal each other. Rows that repeat a key and a text are
    counted each, and each is kept where its key is the smallest. A null key is never the smallest,
    so a group of null keys alone has a null ``keep_id`` and stays. An empty table gives no rows;
    further columns are not read.

    Hashes are counted with partial sums, so a group of any size costs one row per task. Bytes
    are compared as the smallest and largest text under a hash, again with partial sums; only
    texts under a repeated hash take part. Where they differ, the group is split by text.
    """
    source = documents.select(F.col(key).alias("id"), normalised(F.col(text)).alias("body"))
    hashed_rows = source.withColumn("h", hashed(F.col("body")))
    prints = cut(hashed_rows.select("id", "h", F.sha2("body", 256).alias("sha")))
    groups = prints.groupBy("h").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    total = prints.count()
    repeated = groups.where("n > 1")
    texts = join_groups(hashed_rows.where("body <> ''"), repeated, "h", "n", "id", total).where("n > 1")
    spans = texts.groupBy("h").agg(F.min("body").alias("low"), F.max("body").alias("high"))
    collided = cut(spans.where("low <> high").select("h"))
    if collided.isEmpty():
        return _rows(join_groups(prints, groups, "h", "n", "id", total), key)
    sound = prints.join(collided, "h", "left_anti")
    sound_groups = groups.join(collided, "h", "left_anti")
    mixed = hashed_rows.join(collided, "h", "left_semi")
    mixed = mixed.select("id", "body", F.sha2("body", 256).alias("sha"))
    exact = mixed.groupBy("body").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    apart = join_groups(mixed, exact, "body", "n", "id", total)
    whole = join_groups(sound, sound_groups, "h", "n", "id", total)
    columns = ["id", "sha", "keep", "n"]
    return _rows(whole.select(columns).unionByName(apart.select(columns)), key)


def _rows(joined: DataFrame, key: str) -> DataFrame:
    return joined.select(
        F.col("id").alias(key),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def row_key(key: str, text: str) -> Column:
    """A hash of a row's key and text, never null; a null text is an empty one."""
    named = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string"), F.lit("\n")), F.lit("\n"))
    return F.sha2(F.concat(named, F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256)


def drop_copies(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, decided per key and text.

    Rows that repeat a key and a text all stay or all go, and rows with a null key all stay: one row per
    text is what :func:`one_per_text` keeps.
    """
    dropped = exact_groups(documents, key, text).where("not kept")
    dropped = dropped.select(F.col(key).alias("_dropped"), F.col("text_sha256").alias("_sha")).distinct()
    same = (F.col(key) == F.col("_dropped")) & (F.sha2(normalised(F.col(text)), 256) == F.col("_sha"))
    return documents.join(dropped.hint("shuffle_hash"), same, "left_anti")


def one_per_text(
    documents: DataFrame, key: str = "doc_id", text: str = "text", hashed: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per text, with all its columns: that of the smallest key, null keys last.

    :func:`exact_groups` decides, by hash and bytes, which key stays for a text. Rows that repeat a key and a
    text are one before the shuffle, so a group of any size, also one that repeats its key, costs a row per
    key and task.
    """

    def place(key: Column, sha: Column) -> Column:
        return F.concat(sha, F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")))

    kept = exact_groups(documents, key, text, hashed).where("kept")
    kept = kept.select(place(F.col(key), F.col("text_sha256")).alias("_place")).distinct()
    own = place(F.col(key), F.sha2(normalised(F.col(text)), 256)).alias("_place")
    rows = documents.groupBy(own).agg(F.min_by(F.struct(*documents.columns), F.xxhash64(text)).alias("_row"))
    return rows.join(kept.hint("shuffle_hash"), "_place", "left_semi").select("_row.*")

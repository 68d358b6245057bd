"""Near duplicates by SimHash: whole-text fingerprints, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm.common import cut, join_groups
from letterloom.llm.components import components

#: Shingles hashed at a time, so that a long text needs bounded memory.
BLOCK = 1 << 16
#: Row k: the bits of the byte k, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
LANES = np.arange(8, dtype=np.int64) * 256


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    lanes = hashes.view(np.uint8).reshape(-1, 8) + LANES
    seen = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
    return (seen @ BYTE_BITS).ravel()


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a whole text, as a signed integer; without words zero.

    Words are runs without ASCII white space, A-Z lower-cased. A bit is set when more than half
    of the shingles' hashes have it, repeats counted.
    """
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    width = min(words, len(tokens))
    count = len(tokens) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, count, BLOCK):
        part = tokens[at : at + BLOCK + width - 1]
        shingles = zip(*(part[k:] for k in range(width)))
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), seed) for s in shingles]
        ones += _set_bits(np.array(hashes, np.uint64))
    value = int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])
    return value - (1 << 64) if value >> 63 else value


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fp long) per document; fixed to storage, as it is read several times."""

    @F.pandas_udf("long")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in column], dtype="int64")

    return cut(documents.select(F.col(key).alias(key), of(F.col(text)).alias("fp")))


def _hits(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all fingerprints within the radius, in blocks of about a million pairs."""
    step = max(1, (1 << 20) // max(1, len(right)))
    found = [
        np.stack(np.nonzero(np.bitwise_count(left[at : at + step, None] ^ right[None, :]) <= radius)) + [[at], [0]]
        for at in range(0, len(left), step)
    ]
    i, j = np.concatenate(found, axis=1)
    return i, j


def _labels(i: np.ndarray, j: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` positions the smallest one that the links (i, j) lead to."""
    label = np.arange(count)
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same closure as (a, b), at most one per value."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = _labels(at[: len(a)], at[len(a) :], len(values))
    moved = np.nonzero(label != np.arange(len(values)))[0]
    return values[moved], values[label[moved]]


def _spanning(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, with those inside each tile, what links within the radius join.

    All links of two tiles may be as many as their product. Only which fingerprints hang together
    matters: what hangs together in one tile, its comparison with itself links, so two tiles need a link
    between such groups only.
    """
    i, j = _hits(left, right, radius)
    if same or len(i) < 2:
        return forest(left[i], right[j]) if same else (left[i], right[j])
    ends = []
    for tile, at in ((left, i), (right, j)):
        own, place = np.unique(at, return_inverse=True)
        label = _labels(*_hits(tile[own], tile[own], radius), len(own))
        ends.append(tile[own][label[place]])
    return forest(*ends)


def near_links(prints: DataFrame, radius: int = 3, tile: int = 2048) -> DataFrame:
    """Links (a, b) whose closure is that of all pairs of distinct ``fp`` within the radius.

    Fingerprints are dealt into cells by the population counts of their four 16-bit words. Two
    fingerprints within the radius have counts that differ by the radius at most in sum, so tiles
    of other cells are skipped; all other tile pairs are compared exactly. A cell is cut into
    tiles of about ``tile`` rows, whatever its size. There are at most 17**4 cells, which bounds
    the broadcast of their sizes.
    """
    code = F.lit(0)
    for k in range(4):
        code = code * 32 + F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)))
    cells = prints.select("fp", code.cast("int").alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    dealt = cells.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    tiles = dealt.groupBy("cell", "part").agg(F.collect_list("fp").alias("fps"))
    # of each two neighbouring cells only one step of the two, and the step to itself
    steps = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]
    moves = F.array(*[F.lit(((a * 32 + b) * 32 + c) * 32 + d) for a, b, c, d in steps])
    near = tiles.select(
        F.col("part").alias("left_part"), F.col("fps").alias("left"), F.col("cell").alias("from"), F.explode(moves).alias("move")
    ).withColumn("cell", F.col("from") + F.col("move"))
    # cells that hold nothing, dropped before any tile is moved
    near = near.join(F.broadcast(sizes.select("cell")), "cell")
    pairs = near.join(tiles, "cell").where("move <> 0 or left_part <= part")
    pairs = pairs.select("left", F.col("fps").alias("right"), F.expr("move = 0 and left_part = part").alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            u, v = forest(*(np.concatenate(side) for side in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["a", "b"])

        for batch in batches:
            (at, left), (to, right) = (
                (c.offsets.to_numpy(), c.values.to_numpy().view(np.uint64)) for c in map(batch.column, ("left", "right"))
            )
            for k, same in enumerate(batch.column("same").to_pylist()):
                links = _spanning(left[at[k] : at[k + 1]], right[to[k] : to[k + 1]], radius, same)
                if len(links[0]):
                    held.append(links)
                    size += len(links[0])
            if size > 1_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return pairs.mapInArrow(compare, "a long, b long")


def simhash_groups(
    documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """(key, fingerprint, component_id): one row per document.

    Documents are linked when their fingerprints differ in ``radius`` bits or fewer, and
    ``component_id`` is the smallest key that links lead to. Null texts, empty texts and texts
    without words have the fingerprint zero and are linked like others. Rows that repeat a key
    are rows like others. Null keys are never the smallest. An empty table gives no rows; further
    columns are not read.

    Work after the fingerprints is on distinct fingerprints, so copies cost nothing; of a group
    of any size a task emits no more links than it has fingerprints.
    """
    prints = fingerprints(documents, key, text, words)
    distinct = cut(prints.groupBy("fp").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")))
    linked = components(near_links(distinct, radius)).withColumnsRenamed({"node": "fp", "component": "root"})
    labelled = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("held"))
    named = join_groups(labelled, least, "root", "held", "fp", distinct.count()).select("fp", "n", "component_id")
    named = cut(named)
    out = join_groups(prints, named, "fp", "n", key, prints.count())
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select(key, digits.alias("fingerprint"), "component_id")


def drop_near_copies(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """The rows with the smallest key of each group, with all their columns, decided per key and fingerprint.

    Null keys stay, and rows that repeat a key and a text all stay or all go.
    """
    groups = simhash_groups(documents, key, text, words)
    dropped = groups.where(F.col(key) != F.col("component_id"))
    dropped = dropped.select(F.col(key).alias("_dropped"), F.col("fingerprint").alias("_digits")).distinct()

    @F.pandas_udf("string")
    def digits(column: pd.Series) -> pd.Series:
        return pd.Series([f"{fingerprint(t, words) % (1 << 64):016x}" for t in column], dtype=object)

    printed = documents.withColumn("_print", digits.asNondeterministic()(F.col(text)))
    same = (F.col(key) == F.col("_dropped")) & (F.col("_print") == F.col("_digits"))
    return printed.join(dropped.hint("shuffle_hash"), same, "left_anti").drop("_print")


def one_per_group(
    documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """One row of each group of :func:`simhash_groups`, with all its columns: that of the smallest key.

    Null keys come last, and of rows with one key that of the smallest SHA-256 of its text stays. Null
    texts are empty texts. An empty table gives no rows.

    A text's fingerprint is computed once. Of equal texts one row is chosen before the shuffle, which then
    moves each text once; the rows that stay are looked up where that shuffle has put them.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    order = F.struct(F.isnull(key).alias("nameless"), F.col(key).alias("key"), digest.alias("digest"))

    @F.pandas_udf("long")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in column], dtype="int64")

    distinct = cut(documents.select(of(F.col(text)).alias("fp"), order.alias("row")).groupBy("fp").agg(F.min("row").alias("row")))
    linked = components(near_links(distinct, radius)).withColumnsRenamed({"node": "fp", "component": "root"})
    groups = distinct.join(linked, "fp", "left").groupBy(F.coalesce("root", "fp"))
    staying = groups.agg(F.min("row").alias("row")).select(F.col("row.digest").alias("_digest"))
    one_row = F.min_by(F.struct(*documents.columns), F.struct(F.isnull(key), F.col(key), F.xxhash64(text))).alias("_row")
    texts = documents.groupBy(digest.alias("_digest")).agg(one_row)
    return texts.join(staying, "_digest", "left_semi").select("_row.*")

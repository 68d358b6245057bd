"""Entity tagging against a gazetteer of known names."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.functions.names import PrefixFilter, Trie, portions, prefix_hashes, relabel, segments_of, tagged, trie_matches, walk
from letterloom.operators.lookup import Lookup, lookup_join, measure

WORD_START = r"^[\p{L}\p{N}_]"
#: Names of at most so many bytes are held as a trie in every worker; more are found by a join.
TRIE_LIMIT_BYTES = 16 * 1024 * 1024
#: Bits of the filter for more names: at least and at most, whatever their number.
FILTER_BITS = (1 << 16, 1 << 26)

SPOT = "at int, span int, size int"


@dataclass(frozen=True)
class Gazetteer:
    """Known names with their labels, and what the rows of texts carry: a trie, or a filter of prefixes."""

    names: Lookup
    longest: int
    trie: Broadcast | None
    prefixes: Broadcast | None

    @property
    def in_row(self) -> bool:
        """Whether texts are tagged in their own rows, without a join; such a gazetteer also serves a stream."""
        return self.trie is not None


def read_gazetteer(table: DataFrame, limit: int = TRIE_LIMIT_BYTES) -> Gazetteer:
    """Prepare a (surface, label) table; a surface listed twice keeps its first label.

    A name starts with a letter, digit or underscore. It spans as many segments as its words and the gaps
    between them. Names are measured; those within ``limit`` bytes go through the driver into a trie.
    """
    names = (
        table.select(F.btrim("surface").alias("surface"), "label")
        .where(F.col("surface").rlike(WORD_START))
        .groupBy("surface")
        .agg(F.min("label").alias("label"))
    )
    measured, context = measure(names, limit), table.sparkSession.sparkContext
    if measured.fits:
        held = names.toArrow()
        trie = Trie.of(held["surface"].to_pylist(), held["label"].to_pylist())
        longest = max((len(segs) for segs in segments_of(trie.names)), default=0)
        return Gazetteer(measured, longest, context.broadcast(trie), None)
    prefixes = _prefix_table(names)
    longest, count = prefixes.agg(F.max("span"), F.count(F.lit(1))).first()
    bits = min(max(FILTER_BITS[0], 1 << (16 * (count or 0)).bit_length()), FILTER_BITS[1])
    return Gazetteer(measured, longest or 0, None, context.broadcast(PrefixFilter(_bits(prefixes, bits))))


def _prefix_table(names: DataFrame) -> DataFrame:
    """(hash, span): the hash of every prefix of a name, with the number of segments of the name."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            surfaces = frame["surface"].tolist()
            hashes, name, _ = prefix_hashes(surfaces)
            spans = np.array([len(segs) for segs in segments_of(surfaces)], np.int64)
            yield pd.DataFrame({"hash": hashes.view(np.int64), "span": spans[name]})

    return names.select("surface").mapInPandas(hashed, "hash long, span long")


def _bits(prefixes: DataFrame, count: int) -> np.ndarray:
    """A bit for each hash in ``count / 64`` words, which is all that reaches the driver; ``count`` is a power of two."""
    slots = prefixes.select(F.col("hash").bitwiseAND(F.lit(count - 1)).alias("slot"))
    words = slots.groupBy(F.expr("slot div 64").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")
    )
    out = np.zeros(count // 64, np.int64)
    for row in words.toLocalIterator():
        out[row["at"]] = row["bits"]
    return out.view(np.uint64)


def _found_in_row(text: Column, gazetteer: Gazetteer) -> Column:
    """Matches as structs (at, span, size, label), from the trie."""
    trie, longest = gazetteer.trie, gazetteer.longest

    @F.pandas_udf(f"array<struct<{SPOT}, label string>>")
    def found(texts: pd.Series) -> pd.Series:
        held = texts.tolist()
        parts = (trie_matches(segments_of(held[part]), trie.value, longest) for part in portions(held))
        return pd.Series([matches for part in parts for matches in part], dtype=object)

    return found(text)


def _candidates(text: Column, gazetteer: Gazetteer) -> Column:
    """Structs (at, span, size, surface) of what may be a name, by the filter."""
    prefixes, longest = gazetteer.prefixes, gazetteer.longest

    @F.pandas_udf(f"array<struct<{SPOT}, surface string>>")
    def spots(texts: pd.Series) -> pd.Series:
        held, out = texts.tolist(), []
        for part in portions(held):
            cut = segments_of(held[part])
            some = [[] for _ in cut]
            text, at, span, _ = walk(cut, prefixes.value.known, longest)
            for k, i, n in zip(text.tolist(), at.tolist(), span.tolist()):
                surface = "".join(cut[k][i : i + n])
                some[k].append((i, n, len(surface), surface))
            out += some
        return pd.Series(out, dtype=object)

    return spots(text)


def find_entities(
    df: DataFrame, key: Sequence[str], fields: Sequence[str], gazetteer: Gazetteer
) -> DataFrame:
    """(key, field, at, span, size, label) of every place a known name stands.

    ``at`` and ``span`` count segments, ``size`` characters. A gazetteer within its limit is looked up in the
    text's row. For a larger one a filter of fixed size leaves few other places, and those are joined with
    the names: a place moves with the words of its candidate, never with its text.
    """
    of = _found_in_row if gazetteer.in_row else _candidates
    texts = F.array(*[F.struct(F.lit(f).alias("field"), of(F.col(f), gazetteer).alias("spots")) for f in fields])
    spots = df.select(*key, F.inline(texts)).select(*key, "field", F.inline("spots"))
    if not gazetteer.in_row:
        spots = lookup_join(spots, gazetteer.names, "surface", "inner")
    return spots.select(*key, "field", "at", "span", "size", "label")


def tag_entities(
    df: DataFrame, key: Sequence[str], fields: Sequence[str], gazetteer: Gazetteer
) -> DataFrame:
    """Replace known names by their labels in the given text columns.

    Of names that overlap the longest stays, then the leftmost. Null texts stay null. A gazetteer within
    its limit works row by row, in batch or stream, and nothing is shuffled. For a larger one ``df`` is read
    several times, so pass a stored or checkpointed frame: only texts with a candidate meet the matches
    found in them. Rows are told apart by ``key`` and a hash of their texts, so keys may repeat or be null.
    """
    if not gazetteer.in_row:
        return _tag_by_join(df, key, fields, gazetteer)
    trie, longest = gazetteer.trie, gazetteer.longest

    @F.pandas_udf("string")
    def tag(texts: pd.Series) -> pd.Series:
        return pd.Series(tagged(texts.tolist(), trie.value, longest), dtype=object)

    return df.select(*[tag(F.col(c)).alias(c) if c in fields else df[c] for c in df.columns])


def _tag_by_join(df: DataFrame, key: Sequence[str], fields: Sequence[str], gazetteer: Gazetteer) -> DataFrame:
    own = [*key, "_print"]
    printed = df.withColumn("_print", F.xxhash64(*fields))
    hit = reduce(or_, [F.coalesce(F.size(_candidates(F.col(f), gazetteer)) > 0, F.lit(False)) for f in fields])
    found = find_entities(printed, own, fields, gazetteer)
    per_row = found.groupBy(*own).agg(
        F.collect_set(F.struct("field", "at", "span", "size", "label")).alias("_found")
    )
    named = per_row.select(*[F.col(name).alias(f"_own{i}") for i, name in enumerate(own)], "_found")
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_own{i}")) for i, name in enumerate(own)])

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, found: pd.Series, fields: pd.Series) -> pd.Series:
        out = []
        for text, spots, field in zip(texts, found, fields):
            own = [(s["at"], s["span"], s["size"], s["label"]) for s in spots if s["field"] == field] if spots is not None else []
            out.append(relabel(segments_of([text])[0], own) if own else text)
        return pd.Series(out, dtype=object)

    met = printed.where(hit).join(named, same, "left")
    labelled = met.select(
        *[replaced(F.col(c), F.col("_found"), F.lit(c)).alias(c) if c in fields else F.col(c) for c in df.columns]
    )
    return df.where(~hit).unionByName(labelled)

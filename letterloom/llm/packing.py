"""Best-fit packing of token sequences under several capacities."""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm.common import bucketed_rank, cut
from letterloom.llm.token_cache import SpaceSplit


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, documents, and attention cost (the sum of squared lengths).

    ``weights`` are those of the three in the choice of a bin, each residual taken as a share of
    its capacity. ``rule`` is ``norm`` (smallest weighted residual norm after placing) or ``dot``
    (largest weighted product of demand and residual).
    """

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    @property
    def limits(self) -> tuple[int, int, int]:
        return (self.tokens, self.documents or self.tokens, self.attention or self.tokens**2)


def _demand(length: int) -> tuple[int, int, int]:
    return (length, 1, length * length)


def _fits(left: tuple, need: tuple) -> int:
    """How many pieces of one length a residual takes."""
    return min(have // want for have, want in zip(left, need))


def plan(counts: dict[int, int], capacity: Capacity) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, for ``counts`` pieces of each length.

    Rows (length, from, to, sequence, each, offset): piece number r of a length, from <= r < to, goes to
    sequence + (r - from) // each, at offset + (r - from) % each * length. Bins with the same residual
    are one class with a count, so the work and the plan depend on the number of lengths, at most
    ``capacity.tokens``, not on the number of pieces.
    """
    limits = capacity.limits
    open_bins: dict[tuple, list[tuple[int, int]]] = {}
    rows, opened = [], 0

    def score(left: tuple, need: tuple) -> float:
        shares = [(w, have / cap, want / cap) for w, have, want, cap in zip(capacity.weights, left, need, limits)]
        if capacity.rule == "dot":
            return -sum(w * have * want for w, have, want in shares)
        return sum(w * (have - want) ** 2 for w, have, want in shares)

    def put(length: int, done: int, amount: int, each: int, left: tuple, first: int) -> None:
        """``amount`` pieces, ``each`` per bin, into bins from ``first`` on that have ``left`` free."""
        need, full, rest = _demand(length), *divmod(amount, each)
        rows.append((length, done, done + amount, first, each, limits[0] - left[0]))
        for bins, at, taken in ((full, first, each), (1 if rest else 0, first + full, rest)):
            after = tuple(have - taken * want for have, want in zip(left, need))
            if bins and min(after) > 0:
                open_bins.setdefault(after, []).append((at, bins))

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        need, done, total = _demand(length), 0, counts[length]
        if _fits(limits, need) == 0:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while done < total:
            left = min((b for b in open_bins if _fits(b, need)), key=lambda b: (score(b, need), b), default=None)
            if left is None:
                each = _fits(limits, need)
                put(length, done, total - done, each, limits, opened)
                opened += math.ceil((total - done) / each)
                break
            # the bin just filled is the best again under the norm, and no longer under the product
            each = _fits(left, need) if capacity.rule == "norm" else 1
            first, bins = open_bins[left].pop()
            used = min(bins, math.ceil((total - done) / each))
            if used < bins:
                open_bins[left].append((first + used, bins - used))
            if not open_bins[left]:
                del open_bins[left]
            amount = min(total - done, used * each)
            put(length, done, amount, each, left, first)
            done += amount
    return rows


@lru_cache(maxsize=1)
def _byte_bpe(tokenizer_json: str, ranks_file: str | None) -> SpaceSplit:
    """Ids of a byte-level BPE; its words are independent of each other.

    ``tokenizers`` encodes texts. With the same vocabulary as ranks, words go through ``tiktoken``, which
    gives the same ids in a third of the time.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_json)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    reaches = re.compile("|".join([r"\s ", r" \s", *map(re.escape, added)]))

    def encode_text(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    encode_word = encode_text
    if ranks_file:
        import public_tokenizers
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        words = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        encode_word = words.encode_ordinary
    return SpaceSplit(encode_text, lambda w: encode_word(f" {w}"), lambda t: reaches.search(t) is not None)


def token_pieces(
    documents: DataFrame,
    tokenizer_json: str,
    ranks_file: str | None = None,
    end_id: int = 2,
    tokens: int = 1024,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): the whole text's ids and ``end_id``.

    A document longer than ``tokens`` is cut into pieces of that length; the first takes what is over.
    """
    schema = "key {}, piece int, start long, length long, ids_crc32 long".format(
        documents.schema[key].dataType.simpleString()
    ) + (", ids array<int>" if with_ids else "")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _byte_bpe(tokenizer_json, ranks_file)
        ending = np.array([end_id], np.uint32)
        for batch in batches:
            rows, values, checks, runs = [], [], [], []
            for k, value in enumerate(batch.column("text")):
                ids = np.concatenate([words.ids(value.as_py() or ""), ending])
                starts = [0, *range(len(ids) % tokens or tokens, len(ids), tokens)]
                for piece, (lo, hi) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append(k)
                    values.append((piece, lo, hi - lo))
                    checks.append(zlib.crc32(ids[lo:hi].astype("<u4").tobytes()))
                    if with_ids:
                        runs.append(ids[lo:hi].astype(np.int32))
            if not rows:
                continue
            piece, start, length = np.array(values, np.int64).T
            columns = [batch.column("key").take(pa.array(rows)), piece.astype(np.int32), start, length]
            columns = [*columns[:1], *map(pa.array, columns[1:]), pa.array(checks, pa.int64())]
            if with_ids:
                columns.append(pa.array(runs, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in schema.split(", ")])

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(cut_up, schema).withColumnRenamed("key", key)


def pack_documents(
    documents: DataFrame,
    tokenizer_json: str,
    ranks_file: str | None = None,
    end_id: int = 2,
    capacity: Capacity = Capacity(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): one row per piece.

    Null and empty texts are the end token alone. Rows that repeat a key are packed like others;
    pieces of one length are interchangeable, so ties change no count. An empty table gives no
    rows; further columns are not read.

    Texts are tokenised once. The number of pieces per length, at most ``capacity.tokens`` rows,
    reaches the driver; the plan made from it is bounded likewise and broadcast. Pieces are numbered
    within their length in buckets of bounded size, so that no length, however common, is one task.
    """
    pieces = cut(token_pieces(documents, tokenizer_json, ranks_file, end_id, capacity.tokens, key, text))
    counts = cut(pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")))
    spark = documents.sparkSession
    layout = spark.createDataFrame(
        plan({r["length"]: r["n"] for r in counts.collect()}, capacity),
        "length long, low long, high long, first long, each long, at long",
    )
    spread = F.xxhash64(key, "piece", "ids_crc32")
    ranked = bucketed_rank(pieces, counts, "length", spread, [key, "piece", "ids_crc32"], "r")
    placed = ranked.join(F.broadcast(layout), "length").where("low <= r and r < high")
    return placed.select(
        key,
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.expr("first + (r - low) div each").alias("sequence_id"),
        F.expr("at + (r - low) % each * length").alias("offset"),
    )

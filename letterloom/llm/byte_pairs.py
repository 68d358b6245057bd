"""Byte-level BPE: merges from a priority queue over a linked list of symbols, and decoding."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm.token_cache import WordCache

#: Words that are longer than this many characters are merged anew each time, so caches are bounded in bytes too.
CACHED = 64
#: Ids that leave a task at a time, about.
HELD = 1_000_000


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: itself where it is printable, else one from 256 on."""
    shown = {b for b in range(256) if chr(b).isprintable() and b != 0x20 or b == 0xAD} - {0xAD}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def merge(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges, the lowest rank first and of equal ranks the leftmost.

    ``ranks`` gives the rank of a pair and the symbol that it becomes. Symbols form a doubly linked
    list; the queue keeps one entry per pair that has come up, and an entry whose symbols have
    changed since is skipped, so n symbols take n log n steps.
    """
    size = len(symbols)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    queue = []
    for i in range(size - 1):
        found = ranks.get((symbols[i], symbols[i + 1]))
        if found:
            queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapify(queue)
    while queue:
        _, i, left, right, made = heappop(queue)
        j = after[i]
        if symbols[i] != left or j == size or symbols[j] != right:
            continue
        symbols[i], symbols[j] = made, -1
        h, k = before[i], after[j]
        after[i] = k
        if k < size:
            before[k] = i
            found = ranks.get((made, symbols[k]))
            if found:
                heappush(queue, (found[0], i, made, symbols[k], found[1]))
        if h >= 0:
            found = ranks.get((symbols[h], made))
            if found:
                heappush(queue, (found[0], h, symbols[h], made, found[1]))
    return [s for s in symbols if s >= 0]


class ShortWords(WordCache):
    """A cache that passes long words through."""

    def __missing__(self, word: str) -> bytes:
        if len(word) > CACHED:
            return np.array(self.encode(word), np.uint32).tobytes()
        return super().__missing__(word)


class BytePairs:
    """Ids and texts of one byte-level model, read from its JSON file.

    A file that asks for more than this class does (a normaliser, a prefix space, dropout, ...) raises
    ``ValueError``.
    """

    def __init__(self, tokenizer_json: str, pattern: str, cached: int = 400_000):
        with open(tokenizer_json, encoding="utf-8") as source:
            spec = json.load(source)
        model, splitter, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = (
            model["type"] == "BPE"
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter["add_prefix_space"]
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not spec["normalizer"]
            and (spec["decoder"] or {}).get("type") == "ByteLevel"
            and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError(f"{tokenizer_json} is not a plain byte-level BPE")
        vocabulary, symbols = model["vocab"], byte_symbols()
        self.start = [vocabulary[s] for s in symbols]
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        self.added = {t["content"]: t["id"] for t in added}
        self.strings = self._bytes({**{i: s for s, i in vocabulary.items()}, **{i: s for s, i in self.added.items()}}, symbols)
        self.words = regex.compile(pattern)
        # a space between two characters that are not white space always begins a word: texts are taken apart there
        self.cuts, self.runs = regex.compile(r"(?<=\S) (?=\S)"), regex.compile(r"\s | \s|^ | $")
        names = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.names = regex.compile("(" + "|".join(names) + ")") if names else None
        self.merged = ShortWords(lambda w: merge([self.start[b] for b in w.encode()], self.ranks), cached // 2)
        self.first, self.rest = ShortWords(self._ids, cached // 4), ShortWords(lambda p: self._ids(f" {p}"), cached)

    @staticmethod
    def _bytes(names: dict[int, str], symbols: list[str]) -> list[bytes]:
        """The bytes of each id; a string with a character that stands for no byte is taken as it is."""
        byte_of = {s: b for b, s in enumerate(symbols)}
        out = [b""] * (max(names) + 1)
        for i, name in names.items():
            known = all(c in byte_of for c in name)
            out[i] = bytes(byte_of[c] for c in name) if known else name.encode()
        return out

    def _ids(self, piece: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.merged.__getitem__, self.words.findall(piece))), np.uint32)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text; the string of an added token is that token."""
        parts: list[bytes] = []
        for k, span in enumerate(self.names.split(text) if self.names else [text]):
            if k % 2:
                parts.append(np.array([self.added[span]], np.uint32).tobytes())
            elif span:
                first, *rest = self.cuts.split(span) if self.runs.search(span) else span.split(" ")
                parts.append(self.first[first])
                parts += map(self.rest.__getitem__, rest)
        return np.frombuffer(b"".join(parts), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids' strings one after the other; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def load(tokenizer_json: str, pattern: str) -> BytePairs:
    return BytePairs(tokenizer_json, pattern)


def encode_byte_pairs(
    documents: DataFrame, tokenizer_json: str, pattern: str, key: str = "doc_id", text: str = "text", decoded: bool = True
) -> DataFrame:
    """(key, ids[, decoded]): one row per document, over whole texts.

    ``ids`` are those of the ``tokenizers`` library without its special tokens' templates; ``decoded`` is its
    decoding of them, special tokens included. Null texts are empty texts: no ids, an empty decoding. Rows
    that repeat a key are rows like others; an empty table gives no rows; further columns are not read. No
    shuffle; a text of any length takes n log n steps, results leave in small batches, and a task holds one
    batch and a bounded cache of pieces.
    """
    kind = documents.schema[key].dataType.simpleString()
    schema = f"key {kind}, ids array<int>" + (", decoded string" if decoded else "")

    def flush(keys: pa.Array, ids: list[np.ndarray], texts: list[str]) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).view(np.int32)))
        columns = [keys, lists, pa.array(texts, pa.string())][: 2 + decoded]
        return pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"][: 2 + decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(tokenizer_json, pattern)
        for batch in batches:
            ids, texts, first, held = [], [], 0, 0
            for k, value in enumerate(batch.column("text")):
                ids.append(pairs.encode(value.as_py() or ""))
                texts.append(pairs.decode(ids[-1]) if decoded else "")
                held += len(ids[-1])
                if held > HELD:
                    yield flush(batch.column("key").slice(first, len(ids)), ids, texts)
                    ids, texts, first, held = [], [], k + 1, 0
            if ids:
                yield flush(batch.column("key").slice(first, len(ids)), ids, texts)

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)

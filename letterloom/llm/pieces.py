"""SentencePiece encoding with the original byte span of every piece, and decoding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm.token_cache import SpaceSplit

MARK = "▁"
MARK_BYTES = MARK.encode()


class Normaliser:
    """Longest-prefix replacement through a compiled character map, with source alignment.

    The map is a double-array trie over UTF-8 bytes whose values are places in a list of
    zero-ended replacements. Without a map every character stays.
    """

    def __init__(self, spec):
        blob = spec.precompiled_charsmap
        self.trie, self.texts = None, b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.trie = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
            self.texts = blob[4 + size :]
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces

    def _longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that starts here."""
        units, best = self.trie, None
        node = self._child(units[0], 0)
        for k in range(at, len(data)):
            node ^= data[k]
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node = self._child(unit, node)
            if unit >> 8 & 1:
                best = (k + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        end = self.texts.index(0, best[1])
        return best[0], self.texts[best[1] : end]

    @staticmethod
    def _child(unit: int, node: int) -> int:
        return node ^ unit >> 10 << ((unit & 1 << 9) >> 6)

    def _steps(self, data: bytes) -> Iterator[tuple[bytes, int, int]]:
        """(replacement, start, end) over the whole text."""
        at = 0
        while at < len(data):
            found = self._longest(data, at) if self.trie else None
            if found is None:
                lead = data[at]
                size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = (size, data[at : at + size])
            yield found[1], at, at + found[0]
            at += found[0]

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of their n + 1 borders the border in ``data``.

        White space that is dropped or replaced goes with the piece before it; the added first space
        covers nothing.
        """
        space = MARK_BYTES if self.escape else b" "
        out, borders = bytearray(), [0]
        steps = list(self._steps(data))
        if self.squeeze:
            while steps and not steps[0][0].strip(b" "):
                borders[0] = steps.pop(0)[2]
            while steps and not steps[-1][0].strip(b" "):
                steps.pop()
        if self.prefix and steps:
            out += space
            borders += [borders[0]] * len(space)
        blank = self.squeeze and bool(steps)
        for value, _, end in steps:
            if self.squeeze and blank:
                value = value.lstrip(b" ")
            blank = value.endswith(b" ") if value else blank
            if self.squeeze and value:
                value = value.rstrip(b" ") + b" " * blank
            value = value.replace(b" ", space)
            out += value
            borders += [borders[-1]] * (len(value) - 1) + [end] * bool(value)
            if not value:
                borders[-1] = end
        return bytes(out), np.array(borders, np.int64)


class Pieces:
    """Ids, spans and texts of one model."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = schema.ModelProto()
        with open(model_file, "rb") as source:
            proto.ParseFromString(source.read())
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        self.normalise = Normaliser(spec)
        names = [p.piece for p in proto.pieces]
        is_byte = [self.model.is_byte(k) for k in range(len(names))]
        # bytes of the normalised text, and of the original where marks stand for spaces
        self.inner = np.array([1 if b else len(n.encode()) for n, b in zip(names, is_byte)], np.int64)
        self.outer = np.array([1 if b else len(n.replace(MARK, " ").encode()) for n, b in zip(names, is_byte)], np.int64)
        self.unknown = self.model.unk_id()
        self.plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces
        inside = any(MARK in n.lstrip(MARK) for n in names)
        symbols = any(p.type == schema.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces)
        by_word = self.plain and not inside and not symbols and not trainer.treat_whitespace_as_suffix
        # a word after a space is what the model reads after its added first space
        self.words = SpaceSplit(self.model.encode, self.model.encode, lambda t: not by_word or MARK in t)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids as the library gives them, and the end of each piece's bytes in the original text.

        Pieces lie side by side: each begins where the one before it ends. The space that the model
        adds in front covers no byte. A piece inside one replaced character ends with it.
        """
        ids = self.words.ids(text)
        if self.plain and MARK not in text and not (ids == self.unknown).any():
            ends = np.cumsum(self.outer[ids]) - 1
            return ids, ends
        sizes = self.inner[ids]
        if (ids == self.unknown).any():
            surfaces = self.model.encode(text, out_type=str)
            sizes = np.array([len(s.encode()) if i == self.unknown else n for s, i, n in zip(surfaces, ids, sizes)])
        _, borders = self.normalise(text.encode())
        return ids, borders[np.cumsum(sizes)]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


@lru_cache(maxsize=1)
def load(model_file: str) -> Pieces:
    return Pieces(model_file)


def encode_pieces(documents: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", decoded: bool = True):
    """(key, ids, ends[, decoded]): one row per document, over whole texts.

    ``ids`` are exactly the library's, without begin or end ids; ``ends`` has for each piece the end of its
    bytes in the original text; ``decoded`` is the library's decoding of the ids. Null texts are empty
    texts: no ids, no ends, an empty decoding. Rows that repeat a key are rows like others; an empty
    table gives no rows; further columns are not read. No shuffle; results leave in small batches, so a
    task holds one batch and a bounded cache of words.
    """
    kind = documents.schema[key].dataType.simpleString()
    schema = f"key {kind}, ids array<int>, ends array<int>" + (", decoded string" if decoded else "")

    def flush(keys: pa.Array, rows: list) -> pa.RecordBatch:
        lists = [pa.ListArray.from_arrays(_offsets(c), pa.array(np.concatenate(c).astype(np.int32))) for c in zip(*[r[:2] for r in rows])]
        texts = [pa.array([r[2] for r in rows], pa.string())] if decoded else []
        return pa.RecordBatch.from_arrays([keys, *lists, *texts], ["key", "ids", "ends", "decoded"][: 3 + decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_file)
        for batch in batches:
            rows, first, held = [], 0, 0
            for k, value in enumerate(batch.column("text")):
                ids, ends = pieces.encode(value.as_py() or "")
                rows.append((ids, ends, pieces.decode(ids) if decoded else None))
                held += len(ids)
                if held > 1_000_000:
                    yield flush(batch.column("key").slice(first, len(rows)), rows)
                    rows, first, held = [], k + 1, 0
            if rows:
                yield flush(batch.column("key").slice(first, len(rows)), rows)

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def _offsets(columns: tuple) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum([len(c) for c in columns])]).astype(np.int32))

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from letterloom.llm.packing import Capacity, pack_documents, plan, token_pieces
from letterloom.llm.queries import BYTE_BPE


def tokens_of(texts):
    tokenizer = Tokenizer.from_file(BYTE_BPE["tokenizer_json"])
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_pieces(docs, texts):
    got = defaultdict(list)
    for r in token_pieces(docs, **BYTE_BPE, with_ids=True).collect():
        got[r["doc_id"]].append(r)
    for k, ids in zip([k for k, _ in texts], tokens_of(t for _, t in texts)):
        if k in (0, None):
            continue
        rows = sorted(got[k], key=lambda r: r["piece"])
        assert [i for r in rows for i in r["ids"]] == ids
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert [r["start"] for r in rows] == list(np.cumsum([0, *[r["length"] for r in rows]])[:-1])
        assert all(r["length"] == 1024 for r in rows[1:]) and 0 < rows[0]["length"] <= 1024
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)


def test_words_give_the_ids_of_whole_texts(spark):
    rng = random.Random(2)
    parts = ["a", "don't", " ", "  ", "\n", "é", "🙂", "x.", "12", "<|endoftext|>", "　", "_", "'s", "Z-z", "\t"]
    made = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = token_pieces(rows, **BYTE_BPE, with_ids=True).toPandas().sort_values("doc_id")["ids"]
    assert [list(ids) for ids in got] == tokens_of(made)


def test_packed(docs, no_docs):
    got = pack_documents(docs, **BYTE_BPE).toPandas()
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert list(part["offset"]) == list(np.cumsum([0, *part["length"]])[:-1]) and part["length"].sum() <= 1024
    assert got["sequence_id"].nunique() == -(-got["length"].sum() // 1024)
    assert len(got) == token_pieces(docs, **BYTE_BPE).count()
    assert pack_documents(no_docs, **BYTE_BPE).collect() == []


def unrolled(counts, capacity):
    bins = defaultdict(list)
    for length, low, high, first, each, at in plan(counts, capacity):
        for r in range(high - low):
            bins[first + r // each].append((at + r % each * length, length))
    return bins


def plain_best_fit(counts, capacity):
    """One piece after the other, every bin looked at."""
    bins = []
    for length in sorted(counts, reverse=True):
        need = (length, 1, length * length)
        for _ in range(counts[length]):
            fit = [b for b in bins if all(x >= y for x, y in zip(b, need))]
            if not fit:
                fit = [list(capacity.limits)]
                bins.append(fit[0])
            share = lambda b: [(w, x / c, y / c) for w, x, y, c in zip(capacity.weights, b, need, capacity.limits)]
            if capacity.rule == "dot":
                best = min(fit, key=lambda b: (-sum(w * x * y for w, x, y in share(b)), b))
            else:
                best = min(fit, key=lambda b: (sum(w * (x - y) ** 2 for w, x, y in share(b)), b))
            best[:] = [x - y for x, y in zip(best, need)]
    return sorted(map(tuple, bins))


@pytest.mark.parametrize("capacity", [
    Capacity(100), Capacity(100, documents=3), Capacity(100, attention=4000, weights=(1, 1, 1)),
    Capacity(100, documents=4, attention=5000, rule="dot", weights=(1, 0.5, 0.5)),
])
def test_plan_is_best_fit(capacity):
    rng = random.Random(7)
    top = 60
    counts = {n: rng.randint(1, 30) for n in rng.sample(range(1, top), 35)}
    bins = unrolled(counts, capacity)
    tokens, documents, attention = capacity.limits
    for held in bins.values():
        lengths = [n for _, n in sorted(held)]
        assert [at for at, _ in sorted(held)] == list(np.cumsum([0, *lengths])[:-1])
        assert sum(lengths) <= tokens and len(lengths) <= documents and sum(n * n for n in lengths) <= attention
    assert sorted(n for held in bins.values() for _, n in held) == sorted(n for n, c in counts.items() for _ in range(c))
    assert len(bins) == len(plain_best_fit(counts, capacity))
    assert plan({}, capacity) == []
    with pytest.raises(ValueError):
        plan({101: 1}, capacity)

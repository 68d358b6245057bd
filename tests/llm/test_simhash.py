from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash

from letterloom.llm import simhash
from letterloom.llm.simhash import _spanning, drop_near_copies, fingerprint, near_links, one_per_group, simhash_groups


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(keys, links):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "ÄB ab AB ab", "a b c d e f g " * 500])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert fingerprint(text) % (1 << 64) == plain(text)


def test_groups(docs, texts, no_docs):
    got = simhash_groups(docs).collect()
    prints = [plain(t) for _, t in texts]
    places = range(len(texts))
    links = [(a, b) for a in places for b in places if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = closure(places, links)
    least = {r: min((texts[p][0] for p in places if roots[p] == r and texts[p][0] is not None), default=None) for r in set(roots.values())}
    want = [(texts[p][0], f"{prints[p]:016x}", least[roots[p]]) for p in places]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert simhash_groups(no_docs).collect() == []
    dropped = {k for k, _, c in want if k is not None and k != c}
    assert {r["doc_id"] for r in drop_near_copies(docs).collect()} == {k for k, _ in texts} - dropped


@pytest.mark.parametrize("tile", [3, 2048])
def test_links_reach_what_all_pairs_reach(spark, tile):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [base]
    for _ in range(4):
        near = base.copy()
        for _ in range(rng.integers(1, 4)):
            near ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        flips.append(near)
    values = sorted({int(v) for v in np.concatenate([*flips, [0, 7, 2**64 - 1]])})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = [(r.a, r.b) for r in near_links(rows, tile=tile).collect()]
    pairs = [(a, b) for a, x in zip(signed, values) for b, y in zip(signed, values) if a < b and (x ^ y).bit_count() <= 3]
    assert pairs and closure(signed, got) == closure(signed, pairs)


def test_a_tile_emits_fewer_links_than_it_has_rows():
    dense = np.arange(16, dtype=np.uint64)
    a, b = _spanning(dense, dense, 3, True)
    assert len(a) == 15 and set(b.tolist()) == {0}


def test_a_repeated_key_loses_no_text(spark):
    rows = [(1, "one and the same text"), (5, "one and the same text"), (5, "quite another one, with nothing in common")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, drop_near_copies(docs).collect())) == [rows[0], rows[2]]


def test_one_row_of_each_group_stays(spark, docs, texts, no_docs):
    """Groups by brute force; of each the row with the smallest key, then the smallest digest."""
    rng = np.random.default_rng(7)
    base = [[f"w{rng.integers(300)}" for _ in range(400)] for _ in range(12)]
    near = [" ".join([*b[:at], "other", *b[at + 1 :]]) for b in base for at in (0, 7, 399)]
    rows = [*texts, *((500 - k, t) for k, t in enumerate(near)), (None, near[0]), (450, near[1]), (450, near[2]), (7, near[3])]
    prints = [plain(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots, groups = closure(range(len(rows)), links), {}
    for p, (k, t) in enumerate(rows):
        groups.setdefault(roots[p], []).append((k is None, k or 0, hashlib.sha256((t or "").encode()).hexdigest(), k, t or ""))
    want = [min(g)[3:] for g in groups.values()]
    many = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, row string").repartition(5)
    got = one_per_group(many)
    assert got.columns == many.columns
    assert sorted(((r["doc_id"], r["text"] or "") for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert len(groups) <= len(rows) - 30
    assert one_per_group(no_docs).collect() == []

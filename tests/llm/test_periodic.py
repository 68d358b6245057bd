from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from letterloom.llm import periodic
from letterloom.llm.common import table
from letterloom.llm.periodic import Rule, find_runs, minimizers, runs_of
from letterloom.llm.queries import op12_periodic, with_planted_runs


def smallest_period(words):
    """By the border table."""
    border = [0] * (len(words) + 1)
    border[0] = k = -1
    for i, w in enumerate(words):
        while k >= 0 and words[k] != w:
            k = border[k]
        k += 1
        border[i + 1] = k
    return len(words) - border[-1]


def brute(words, least=6, times=4):
    """Each lag on its own, word by word; then the stretches whose smallest period is the lag."""
    found = []
    for lag in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - lag:
            j = i
            while j < len(words) - lag and words[j] == words[j + lag]:
                j += 1
            size = j - i + lag
            if j > i and size >= max(least, times * lag) and smallest_period(words[i : i + size]) == lag:
                found.append((i, size, lag))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def made(seed):
    """Word lists with nested, neighbouring and broken repetitions over small and large word sets."""
    rng = random.Random(seed)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 700, ["a", "b"] * 300]
    for _ in range(60):
        words = []
        while len(words) < rng.choice([10, 60, 400]):
            unit = rng.choices("abcdefgh"[: rng.randint(1, 8)], k=rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 40]))
            if rng.random() < 0.3:
                unit = unit * rng.randint(2, 5) + rng.choices("xyz", k=1)
            words += (unit * rng.randint(1, 6))[: rng.randint(1, 200)]
        out.append(words)
    for size in (50, 500):
        out.append([f"w{rng.randrange(3)}" for _ in range(size)])
    a, b = "a", "ab"
    for _ in range(11):
        a, b = b, b + a
    out.append(list(b))  # Fibonacci words
    out.append([str(bin(k).count("1") % 2) for k in range(600)])  # Thue-Morse
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    lists = made(seed)
    number = {w: k for k, w in enumerate(sorted({w for ws in lists for w in ws}))}
    rows = runs_of([np.array([number[w] for w in ws], np.int64) for ws in lists])
    got = [[] for _ in lists]
    for k, *run in zip(*(c.tolist() for c in rows)):
        got[k].append(tuple(run))
    assert got == [brute(ws) for ws in lists]
    assert sum(map(len, got)) > 50


@pytest.mark.parametrize("window", [1, 2, 8, 64])
def test_minimizers(window):
    values = np.random.default_rng(window).integers(0, 9, 200).astype(np.uint64)
    want = {int(i + np.argmin(values[i : i + window])) for i in range(len(values) - window + 1)}
    assert minimizers(values, window).tolist() == sorted(want)
    assert minimizers(values[: window - 1], window).tolist() == []


def test_documents(docs, texts, no_docs, monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 30)
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in find_runs(docs).collect()]
    want = []
    for k, t in texts:
        words = (t or "").encode().split()
        runs = [(0, len(words), 1)] if len(words) > 50_000 and len(set(words)) == 1 else brute(words) if len(words) < 5000 else [(0, len(words) - 1, 1)]
        decoded = [w.decode() for w in words]
        want.append((k, runs, collapse(decoded, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert find_runs(no_docs).collect() == []
    assert find_runs(docs, collapsed=False).columns == ["doc_id", "runs"]
    with pytest.raises(ValueError):
        find_runs(docs, rule=Rule(times=3))


def test_another_rule(spark):
    docs = spark.createDataFrame([(1, "a b " * 5 + "c"), (2, "x " * 9)], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in find_runs(docs, rule=Rule(9, 5)).collect()}
    assert got == {1: [(0, 10, 2)], 2: [(0, 9, 1)]}


def test_time_grows_with_the_length():
    rng = np.random.default_rng(3)
    texts = [np.tile(rng.integers(0, 2, 1000), 300), rng.integers(0, 2, 300_000), np.zeros(300_000, np.int64)]
    started = time.monotonic()
    assert len(runs_of(texts)[0]) > 1000
    assert time.monotonic() - started < 30


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planting(docs, texts):
    got = [(r["doc_id"], (r["text"] or "").split()) for r in with_planted_runs(docs).collect() if r["doc_id"] is not None]
    want = [(k, [w.decode() for w in planted(k, (t or "").encode().split())]) for k, t in texts if k is not None]
    assert sorted(got) == sorted(want)
    assert any(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in texts)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r.asDict() for r in op12_periodic(spark, sf).collect()}
    rows = table(spark, sf, "documents").collect()
    assert len(got) == len(rows)
    seen = 0
    for r in rows:
        words = [w.decode() for w in planted(r["doc_id"], (r["text"] or "").encode().split())]
        runs = brute(words) if len(words) < 4000 else None
        if runs is None:
            continue
        seen += len(runs)
        best = None
        for s, n, q in runs:
            if best is None or n * best[2] > best[1] * q:
                best = (s, n, q)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert got[r["doc_id"]] == {
            "doc_id": r["doc_id"],
            "n_runs": len(runs),
            **dict(zip(("start", "length", "period"), best or (None,) * 3)),
            "exponent_milli": best and 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(collapse(words, runs).encode()).hexdigest(),
        }
    assert seen > 10

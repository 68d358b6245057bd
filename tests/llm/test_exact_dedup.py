from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from letterloom.llm import exact_dedup
from letterloom.llm.exact_dedup import drop_copies, exact_groups, one_per_text


def brute(texts):
    body = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for k, t in texts:
        groups[body(t)].append(k)
    out = []
    for k, t in texts:
        held = groups[body(t)]
        keep = min((x for x in held if x is not None), default=None)
        out.append((k, keep, len(held), k == keep, hashlib.sha256(body(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(docs, texts, no_docs):
    assert sorted(map(tuple, exact_groups(docs).collect()), key=repr) == brute(texts)
    assert exact_groups(no_docs).collect() == []


def test_colliding_hashes_are_told_apart_by_bytes(docs, texts):
    weak = lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)
    assert sorted(map(tuple, exact_groups(docs, hashed=weak).collect()), key=repr) == brute(texts)


def test_documents_that_stay(docs, texts):
    got = drop_copies(docs)
    assert got.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    dropped = {k for k, keep, _, stays, _ in brute(texts) if not stays and k is not None}
    assert sorted(kept, key=repr) == sorted(((k, t) for k, t in texts if k not in dropped), key=repr)


def test_a_repeated_key_loses_no_text(spark):
    rows = [(1, "copy"), (5, "copy"), (5, "alone"), (5, "alone"), (None, "copy"), (None, "nameless"), (None, "nameless")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in drop_copies(docs).collect()} == set(rows) - {(5, "copy")}
    assert sorted(map(tuple, one_per_text(docs).collect()), key=repr) == [(1, "copy"), (5, "alone"), (None, "nameless")]


def test_one_row_per_text(docs, texts, no_docs):
    got = one_per_text(docs)
    assert got.columns == docs.columns
    body = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    want = {(keep, body(t)) for (_, t), (_, keep, *_) in zip(texts, [next(g for g in brute(texts) if g[0] == k and g[4] == hashlib.sha256(body(t).encode()).hexdigest()) for k, t in texts])}
    assert sorted(((r["doc_id"], body(r["text"])) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert one_per_text(no_docs).collect() == []


def test_one_row_per_text_is_the_operators_choice(docs, monkeypatch):
    """The rows that stay are those of the operator, by hash and bytes, also where hashes collide."""
    calls, weak = [], lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)
    monkeypatch.setattr(exact_dedup, "exact_groups", lambda *args: calls.append(args) or exact_groups(*args))
    want = sorted(map(tuple, one_per_text(docs).collect()), key=repr)
    assert len(calls) == 1
    assert sorted(map(tuple, one_per_text(docs, hashed=weak).collect()), key=repr) == want

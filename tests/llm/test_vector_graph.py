from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from letterloom.llm.common import table
from letterloom.llm.vector_graph import GraphOptions, audit_recall, linked_vectors


def brute(rows):
    good = [(k, np.array(v, float)) for k, v in rows if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    names = [k for k, _ in good]
    x = np.stack([np.pad(v, (0, 64 - len(v))) for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    near = defaultdict(list)
    for i, j in zip(*np.nonzero(linked)):
        near[names[i]].append(names[j])
    out = {}
    for k, _ in rows:
        reached, todo = {k}, [k]
        while todo:
            new = set(near[todo.pop()]) - reached
            reached |= new
            todo += new
        out[k] = (len(near[k]), min(reached), min(reached) == k)
    return out


def made():
    rng = np.random.default_rng(3)
    rows = [rng.normal(size=64) for _ in range(1500)]
    heavy = rng.normal(size=64)
    rows += [heavy + rng.normal(size=64) * 0.1 for _ in range(700)]  # one large group of near copies
    rows += [rows[k] + rng.normal(size=64) * 0.3 for k in range(200)]
    rows += [heavy] * 50
    lists = [v.astype(np.float32).tolist() for v in rows]
    lists += [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None] + [1.0] * 63, [1.0] * 32, [2.0] * 32]
    return [(k * 7 % 100_003, v) for k, v in enumerate(lists)]


@pytest.mark.parametrize("options", [GraphOptions(), GraphOptions(shard_rows=200, largest=500)])
def test_against_brute_force(spark, options):
    rows = made()
    frame = spark.createDataFrame([(k, v, 1, "c") for k, v in rows], "vec_id long, embedding array<float>, n int, h string").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in linked_vectors(frame, options=options).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    found, true = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert true > 100_000 and 0.97 * true <= found <= true
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(got[k] == want[k] for k in want) > 0.97 * len(want)
    assert all(got[k][:2] == (0, k) for k, v in rows[-8:-2])


def test_table(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    want = brute([(r[0], list(r[1])) for r in rows.select("vec_id", "embedding").collect()])
    got = {r[0]: tuple(r[1:]) for r in linked_vectors(rows).collect()}
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert sum(got[k] == want[k] for k in want) > 0.97 * len(want)


def test_no_rows_and_null_keys(spark):
    schema = "vec_id long, embedding array<float>"
    assert linked_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [0.0, 1.0]), (None, None)]
    got = sorted(map(tuple, linked_vectors(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True), (None, 0, None, True)], key=repr)


def test_a_key_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, 2.0]), (3, [-1.0, 0.0]), (3, [-1.0, 0.0])]
    got = sorted(map(tuple, linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()))
    pair = [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]
    assert got == sorted([*pair, (3, 1, 3, True), (3, 1, 3, True)])


def test_planted_pairs_and_groups(spark):
    """Pairs, triples and one group that holds a third of the rows, all within the link range."""
    rng = np.random.default_rng(11)
    lone = rng.normal(size=(1200, 64))
    near = [lone[k] + rng.normal(size=64) * 0.15 for k in range(300) for _ in range(1 + k % 2)]
    heavy = rng.normal(size=64) + rng.normal(size=(800, 64)) * 0.05
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate([*lone, *near, *heavy])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in linked_vectors(frame, options=GraphOptions(shard_rows=300, largest=500)).collect()}
    want = brute(rows)
    few = [k for k in want if 1 <= want[k][0] <= 2]
    assert len(few) > 600 and sum(got[k] == want[k] for k in few) > 0.97 * len(few)
    assert sum(got[k] == want[k] for k in want) > 0.97 * len(want)


def test_the_audit_sees_small_groups(spark):
    """Pairs that all were missed count, beside a large group whose links all were found."""
    heavy, lone = np.eye(64)[0], np.eye(64)[1:41]
    rows = [(k, heavy.tolist(), 1, [0]) for k in range(400)]
    rows += [(1000 + k, lone[k // 2].tolist(), 1, [1]) for k in range(80)]
    assigned = spark.createDataFrame(rows, "id long, v array<double>, copies long, clusters array<int>")
    found = spark.createDataFrame([(k, 399) for k in range(400)], "id long, n long")
    every = spark.createDataFrame([(r[0], 399 if r[0] < 400 else 1) for r in rows], "id long, n long")
    for largest in (100, 10_000):
        options = GraphOptions(largest=largest)
        assert audit_recall(assigned, every, options, 16) == 1.0
        got = audit_recall(assigned, found, options, 16)
        assert got == 0.0 if largest == 100 else abs(got - 400 / 480) < 0.01
    alone = spark.createDataFrame([(k, np.eye(64)[k].tolist(), 1, [0]) for k in range(20)], assigned.schema)
    assert audit_recall(alone, found.where("n < 0"), GraphOptions(), 16) is None

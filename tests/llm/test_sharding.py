from __future__ import annotations

import math
import zlib
from collections import Counter
from hashlib import md5

from pyspark.sql import functions as F

from letterloom.llm import common
from letterloom.llm.sharding import Node, grown_tree, place, shard_rows


def python_place(key: str, node: Node) -> int:
    while node.shard is None:
        draws = []
        for child in node.children:
            u = (int(md5(f"{key}@{child.name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            draws.append((-math.log(u) / child.weight, child.name, child))
        node = min(draws, key=lambda d: d[:2])[2]
    return node.shard


def test_rows(docs, texts, no_docs):
    got = shard_rows(docs, grown_tree(24), grown_tree(25)).collect()
    assert len(got) == len(texts)
    want = Counter((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), python_place("null" if k is None else str(k), grown_tree(24))) for k, t in texts)
    assert Counter(tuple(r[:4]) for r in got) == want
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 24) for r in got)
    assert shard_rows(no_docs, grown_tree(24)).collect() == []


def test_slots_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(common, "WINDOW_ROWS", 37)
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = shard_rows(rows, grown_tree(5)).toPandas()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_weights_and_movement(spark):
    def tree(weights):
        racks = [Node(f"r{k}", children=tuple(Node(f"s{s}", s, weights[s]) for s in (2 * k, 2 * k + 1))) for k in (0, 1)]
        return Node("root", children=(Node("A", children=(racks[0],)), Node("B", children=(racks[1],))))

    before, after = tree([1, 3, 2, 2]), tree([1, 3, 2, 6])
    key = F.col("id").cast("string")
    got = spark.range(20_000).select(place(key, before).alias("a"), place(key, after).alias("b")).toPandas()
    shares = got["a"].value_counts(normalize=True)
    assert all(abs(shares[s] - w / 8) < 0.02 for s, w in enumerate([1, 3, 2, 2]))
    moved = got[got["a"] != got["b"]]
    assert set(moved["b"]) <= {2, 3} and not ((moved["a"] == 3) & (moved["b"] != 3)).any()
    empty = Node("root", children=(Node("s0", 0, 0.0), Node("s1", 1, 1.0)))
    assert {r[0] for r in spark.range(50).select(place(key, empty)).collect()} == {1}

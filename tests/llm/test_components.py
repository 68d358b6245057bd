from __future__ import annotations

import random

from letterloom.llm.components import components


def test_components(spark):
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    odd = [(5000, 5000), (6001, 6000), (6000, 6001), (6001, 6000)]
    edges = [*chain, *star, *odd]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1300)} | {6000: 6000, 6001: 6000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

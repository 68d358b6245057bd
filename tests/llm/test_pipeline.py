from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from letterloom.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    columns, held = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        now = {r["doc_id"]: r for r in docs.collect()}
        assert set(now) <= set(held) and len(now) == docs.count()
        if name != "pii":
            assert all(now[k] == held[k] for k in now)
        if name == "exact_dedup":
            texts = defaultdict(list)
            for k, r in held.items():
                texts[" ".join(r["text"].split())].append(k)
            assert set(now) == {min(ks) for ks in texts.values()}
        held = now
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(rows["doc_id"]) == set(held)
    assert rows.groupby("sequence_id")["length"].sum().max() <= 1024


def test_run_and_odd_tables(spark, docs, no_docs):
    assert corpus_pipeline.run(spark, SF).count() > 100
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).collect() == []
        assert stage(spark, docs, SF).count() > 0

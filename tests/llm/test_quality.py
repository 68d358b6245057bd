from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from letterloom.llm.common import table
from letterloom.llm.quality import FEATURES, fit_trees, keep_good, rate_documents, statistics


def test_statistics():
    for text in (None, "", " \n", "a", "🙂🙂", "x " * 5000):
        values = statistics(text)
        assert values.shape == (len(FEATURES),) and np.isfinite(values).all()
    assert dict(zip(FEATURES, statistics("AB cd. 1")))["upper"] == 0.25


def test_trees_learn_what_one_cut_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = fit_trees(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    node = trees.root[0]
    while trees.left[node] != node:  # the flat arrays of one tree, walked by hand
        node = trees.left[node] if x[0, trees.feature[node]] <= trees.cut[node] else trees.right[node]
    assert trees.value[node] != 0
    for labels in (np.ones(10), np.zeros(0)):
        constant = fit_trees(np.zeros((len(labels), 4)), labels)
        assert len(set(constant.score(x[:5]))) == 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = rate_documents(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels"), "doc_id")
    got = rows.toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda k: zlib.crc32(str(k).encode()) % 3 == 1)).all()
    away = got[got["held_out"]]
    assert len(away) > 500 and (away["predicted"] == away["quality"]).mean() > 0.97


def test_odd_rows(spark, docs, texts, no_docs):
    labels = spark.createDataFrame([(3, 1), (6, 0), (None, 1), (9, None), (3, 1), (12345, 0)], "doc_id long, quality int")
    got = rate_documents(docs, labels).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)
    assert rate_documents(no_docs, labels).collect() == []
    all_good = rate_documents(docs, labels.where("quality = 1"))
    assert all_good.where("predicted = 0").count() == 0
    kept = keep_good(docs, labels.where("quality = 1"))
    assert kept.columns == docs.columns and kept.count() == len(texts)
    assert rate_documents(docs, labels.where(F.lit(False))).count() == len(texts)

from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000


@pytest.fixture(scope="session")
def texts():
    """Rows (doc_id, text) with nulls, empties, ties, repeated rows and a very long text."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "délta", "x", "12", "end."]
    made = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]
    made += [made[0], made[1], f"  {made[2]}\n", "", None, " \n\t", LONG, f"{LONG}!", "🙂 emoji ▁ mark", "a\x00b", "ab" * 3000]
    rows = [(k * 3, t) for k, t in enumerate(made)]
    return [*rows, (0, made[0]), (None, "alone"), (None, made[3]), (7, "alpha Beta gamma")]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The rows with further columns, some with names that operators use inside."""
    rows = [(k, t, "en", "s", 1, "clash") for k, t in texts]
    columns = "doc_id long, text string, lang string, source string, n_chars long, "
    return spark.createDataFrame(rows, f"{columns} h string").repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")

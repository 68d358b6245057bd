from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction
from itertools import permutations

import pytest

from letterloom.llm.filter_audit import audit_filters, failure_masks, shapley


def fails(text):
    text = text or ""
    words = text.encode().split()
    out = "A" if len(words) < 100 else ""
    out += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else ""
    return out + ("D" if set(text) & set("#$%&*|") else "")


def all_fails(rows):
    """Per row (id, text): the letters, each pair of rows compared for E."""
    out = []
    for k, t in rows:
        copied = any(o is not None and k is not None and o < k and (t or "") == (u or "") for o, u in rows)
        out.append(fails(t) + ("E" if copied else ""))
    return out


def brute(rows, labels):
    """Every order applied filter by filter to (id, text, part)."""
    quality, toxic = ({k for k, *flags in labels if k is not None and flags[at] == 1} for at in (0, 1))
    told = list(zip(rows, all_fails([(k, t) for k, t, _ in rows])))
    out, totals = [], Counter()
    for part in {p or "" for _, _, p in rows}:
        own = [(k, f) for (k, _, p), f in told if (p or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(k, f) for k, f in left if x in f]
                left = [(k, f) for k, f in left if x not in f]
                failing = [f for _, f in own if x in f]
                totals[part, x] += len(gone)
                lost = [sum(k in flagged for k, _ in gone) for flagged in (quality, toxic)]
                out.append((part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), failing.count(x), *lost))
    return sorted((*r, totals[r[0], r[1][r[2] - 1]]) for r in out)


def made():
    rng = random.Random(8)
    rows = []
    for k in range(160):
        words = [f"w{rng.randrange(rng.choice([60, 100_000]))}" for _ in range(rng.choice([0, 20, 99, 100, 101, 200]))]
        if rng.random() < 0.3:
            words = [w.upper() * 3 for w in words]
        if rng.random() < 0.2:
            words.append(rng.choice("#$%&*|"))
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(words), rng.choice(["en", "de", None, ""])))
    rows += [(200 + k, rows[rng.randrange(20)][1], rng.choice(["en", "fr"])) for k in range(60)]
    rows += [(None, rows[0][1], "en"), (None, None, None), (0, rows[0][1], "de"), (3, "other", "en"), (999, None, "en"), (1, "", "xx")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 260, 2)]
    return rows, [*labels, (4, 1, 0), (4, 0, 1), (None, 1, 1), (5000, 1, 1)]


def test_audit_against_all_orders(spark):
    rows, labels = made()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, mask string").repartition(3)
    flags = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = sorted(map(tuple, audit_filters(docs, flags).collect()))
    assert got == brute(rows, labels)
    none = audit_filters(docs.where("false"), flags)
    assert none.collect() == [] and none.columns == audit_filters(docs, flags).columns
    unlabelled = audit_filters(docs, flags.where("false"))
    assert unlabelled.where("good_lost <> 0 or toxic_lost <> 0").isEmpty()


def test_masks(docs, texts):
    got = sorted(((r["id"], r["part"], r["mask"]) for r in failure_masks(docs).collect()), key=repr)
    want = [(k, "en", sum(1 << "ABCDE".index(x) for x in f)) for (k, _), f in zip(texts, all_fails(texts))]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("players", [1, 2, 3, 5])
def test_shapley_is_the_mean_over_all_orders(players):
    if players == 1:
        assert shapley([0, 7]) == [7]
        return
    rng = random.Random(players)
    worth = [0, *(rng.randrange(100) for _ in range((1 << players) - 1))]
    orders = list(permutations(range(players)))
    want = [Fraction()] * players
    for order in orders:
        before = 0
        for k in order:
            want[k] += Fraction(worth[before | 1 << k] - worth[before], len(orders))
            before |= 1 << k
    assert shapley(worth) == want

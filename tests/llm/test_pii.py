from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from letterloom.llm.pii import (
    KINDS, LABELERS, LEVELS, base_spans, candidates, decided_spans, estimate, fit_classifier, luhn, redact, span_digest,
)

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for rank, kind in enumerate(KINDS):
        for m in re.finditer(FORMS[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            tests = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }
            if tests[kind]():
                out.append((m.start(), rank, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_luhn():
    assert luhn("4111111111111111") and luhn("79927398713") and not luhn("4111111111111112")


def test_base_is_that_of_the_patterns():
    rng = random.Random(4)
    parts = ["a@b.co", "@", "x", ".", "..", "-", "+", "1", "12", "255", "256", " ", "(", ")", "4111 1111 1111 1111", "é", "a.b", "%", "+1 (377) 555-0271", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert base_spans(text) == plain(text), text


@pytest.mark.parametrize("part", ["a", "1", "a.", "1.", "@", "a@", "+1", "1 ", "a@b", "a(at)", "x at y dot ", "123-", "a(dot)", "x(at)y(dot)", "x at "])
def test_hostile_texts_take_linear_time(part):
    text = part * 200_000
    candidates(text, base_spans(text))


def test_estimation_finds_the_reliable_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < p, np.where(truth, 1, -1), np.where(truth, -1, 1)) for p in (0.95, 0.9, 0.8, 0.6, 0.55)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = estimate(patterns, counts.astype(float))
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.93 and abs(model.prior - 0.4) < 0.05
    assert len(LABELERS) == 5


def test_documents(spark, docs, texts, no_docs):
    more = [
        (901, "write to jane (at) example (dot) com or call 212-555-0187."), (902, "a.b@c.de, +1 (377) 555-0271; 10.0.0.1"),
        (903, "pay 4111 1111 1111 1111 now"), (904, "we meet at home. It is late; look at it. 1.5 2,000 2024-01-02"),
    ]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = span_digest(rows).collect()
    assert len(got) == len(texts) + len(more)
    by_key = {r["doc_id"]: r for r in got}
    for k, t in more:
        spans = plain(t)
        listed = ",".join(f"{a}:{b}:{c}" for a, b, c in spans)
        r = by_key[k]
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(s[0] == kind for s in spans) for kind in KINDS]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))
    assert "email:9:36" in by_key[901]["spans"] and by_key[904]["spans"] == ""
    assert span_digest(no_docs).collect() == []
    clean = redact(rows)
    assert clean.columns == rows.columns and clean.count() == rows.count()
    shown = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert shown[902] == "[EMAIL], [PHONE]; [IP]" and shown[903] == "pay [CARD] now" and shown[904] == more[3][1]
    unspoilt = sorted(((k, t) for k, t in texts if k not in (0, None)), key=repr)
    assert sorted(((k, t) for k, t in shown.items() if k is not None and k < 900 and k), key=repr) == unspoilt


def test_wide_forms_have_no_longest_length():
    for text in (
        "x" * 70_000 + " at example dot com", "jane (at) " + " dot ".join(["part"] * 5_000), "jane at " + "y" * 9_000 + " dot org",
    ):
        assert candidates(f"mail {text}!", []) == [("email", 5, 5 + len(text))]


def test_the_classifier_learns_from_shape():
    """Two groups with the same votes, believed differently, come apart by their lengths alone."""
    kinds = np.array(["phone"] * 8)
    marks = np.ones((8, len(LEVELS)), int)
    marks[:, len(LABELERS)] = np.arange(8)
    model = fit_classifier(kinds, marks, np.full(8, 100.0), (np.arange(8) >= 4).astype(float))
    scores = [model.score("phone", m) for m in marks]
    assert max(scores[:4]) < 0 < min(scores[4:])


def test_masks_and_spans_agree(spark):
    """The expression of the classifier decides as its plain form; hostile votes, null and empty texts included."""
    rng = random.Random(9)
    parts = [
        "call 212-555-0187", "code 011-555-0187x", "(212) 555-0199", "jane (at) example (dot) com", "we met at home dot it was late",
        "bob@example.org", "+1 (377) 555-0271", "4111 1111 1111 1111", "1234 5678 9012 3456", "10.0.0.1", "tel 999-999-9999", "no data",
    ]
    rows = [(k, " ; ".join(rng.choices(parts, k=rng.randint(0, 9)))) for k in range(400)] + [(None, None), (401, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for least in (0.0, 0.3, 0.5, 0.9, 1.0):
        spans = {r[0]: r[1] for r in decided_spans(frame, least=least).collect()}
        shown = {r[0]: r[1] for r in redact(frame, least=least).collect()}
        assert set(spans) == set(shown)
        for key, text in rows:
            out, at = [], 0
            for s in spans[key]:
                if s["start"] >= at:
                    out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
                at = max(at, s["end"])
            assert shown[key] == (None if text is None else "".join([*out, text[at:]]))
    assert sum(len(v) for v in spans.values()) == sum(len(base_spans(t or "")) for _, t in rows)

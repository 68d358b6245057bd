"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.llm.common import cut

KINDS = ("email", "ip", "card", "phone")

# The character sets and forms of the base patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Words that stand near personal data, in the languages of the tables.
CONTEXT = {
    "email": ("mail", "e-mail", "contact", "write", "correo", "courriel", "schreib", "kontakt"),
    "ip": ("ip", "address", "host", "server", "adresse", "rechner", "servidor", "serveur"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "anruf", "llama", "teléfono", "téléphone"),
}
# Frequent ends of mail domains, and first digits of card issuers.
TOP_DOMAINS = frozenset("com org net edu gov info io de fr es uk eu it nl ch at be us".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|3[068]")
DIGIT = re.compile(r"[0-9]")

# Wider forms, whose matches are candidates that the votes decide on. None has two ways to read one text.
WIDE = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++"
        r"(?: ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?: ?(?:\(dot\)|\[dot\]) ?| dot |\.)[A-Za-z0-9-]++)++"
        r"| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++)"
    ),
    "phone": re.compile(r"(?<![0-9+A-Za-z.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z-])"),
    "card": re.compile(r"(?<![0-9A-Za-z.-])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9A-Za-z-])"),
}

#: The labelers, in the order of their votes.
LABELERS = ("form", "checksum", "gazetteer", "context", "neighbours")
#: The context labeler looks for its words in this many characters before a span.
NEAR = 40
#: What only the classifier sees, and the number of levels of each: length, separators, and both sides.
SHAPE = {"length": 8, "separators": 8, "opens": 2, "closes": 2}
#: Levels of all marks of a span: the votes -1, 0 and 1, then the shape.
LEVELS = (3,) * len(LABELERS) + tuple(SHAPE.values())


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What the base pattern matches, in linear time: the local part is the run in front of an @."""
    end, at = 0, text.find("@")
    while at >= 0:
        local = text[end:at]
        size = len(local) - len(local.rstrip(LOCAL))
        host = DOMAIN.match(text, at + 1) if size else None
        if host:
            yield at - size, host.end()
        end = host.end() if host else at + 1
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start and then kind; ends are exclusive."""
    found = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) < 256 for part in match[0].split(".")):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = match[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(DIGIT.findall(match[0])) <= 15:
            found.append((match.start(), 3, match.end()))
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def _votes(text: str, kind: str, start: int, end: int, based: bool) -> tuple[int, ...]:
    """Each labeler's vote on a span: 1 for, -1 against, 0 none."""
    body = text[start:end]
    digits = "".join(DIGIT.findall(body))
    form = 1 if based else 0
    if kind == "card":
        checksum = 1 if luhn(digits) else -1
    elif kind == "phone":
        area = digits[-10:-7]
        checksum = -1 if area[:1] in ("0", "1") or len(set(digits)) < 3 else 0
    else:
        checksum = 0
    if kind == "email":
        gazetteer = 1 if re.split(r"[^A-Za-z0-9]+", body.lower().rstrip(")] "))[-1] in TOP_DOMAINS else -1
    elif kind == "card":
        gazetteer = 1 if ISSUERS.match(digits) else -1
    elif kind == "ip":
        gazetteer = -1 if digits.startswith("0") or body.startswith("127.") else 1
    else:
        gazetteer = 0
    near = text[max(0, start - NEAR) : start].lower()
    context = 1 if any(re.search(rf"\b{word}\b", near) for word in CONTEXT[kind]) else 0
    sides = text[max(0, start - 1) : start], text[end : end + 1]
    neighbours = -1 if any(s and (s.isalnum() or s in "_/=#$%") for s in sides) else 0
    return form, checksum, gazetteer, context, neighbours


def _marks(text: str, kind: str, start: int, end: int, based: bool) -> tuple[int, ...]:
    """The level of each mark in the order of ``LEVELS``: votes from 0 to 2, then the shape."""
    body = text[start:end]
    separators = len(body) - sum(map(str.isalnum, body))
    shape = (
        min((end - start).bit_length(), SHAPE["length"] - 1),
        min(separators, SHAPE["separators"] - 1),
        int(start == 0 or text[start - 1].isspace() or text[start - 1] in ":([<"),
        int(end == len(text) or text[end].isspace() or text[end] in ".,;:)]>"),
    )
    return (*[vote + 1 for vote in _votes(text, kind, start, end, based)], *shape)


def candidates(text: str, based: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the wider forms that overlap no base span, leftmost first and without overlaps."""
    found = []
    for kind, form in WIDE.items():
        if kind == "email" and " at " not in text and "at)" not in text and "at]" not in text:
            continue
        found += [(m.start(), m.end(), kind) for m in form.finditer(text)]
    taken = sorted((s, e) for _, s, e in based)
    kept, last, k = [], 0, 0
    for start, end, kind in sorted(found):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if start >= last and (k == len(taken) or taken[k][0] >= end):
            kept.append((kind, start, end))
            last = end
    return kept


SPANS = "array<struct<kind:string,start:int,end:int,based:boolean,marks:array<int>>>"


def voted_spans(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): base spans and candidates with their marks, which are votes and shape."""
    kind = documents.schema[key].dataType.simpleString()
    arrow = pa.list_(pa.struct({"kind": pa.string(), "start": pa.int32(), "end": pa.int32(), "based": pa.bool_(), "marks": pa.list_(pa.int32())}))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                body = value.as_py() or ""
                based = base_spans(body)
                both = [(s, True) for s in based] + [(s, False) for s in candidates(body, based)]
                rows.append([
                    {"kind": k, "start": a, "end": b, "based": sure, "marks": list(_marks(body, k, a, b, sure))}
                    for (k, a, b), sure in both
                ])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, arrow)], ["key", "spans"])

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(read, f"key {kind}, spans {SPANS}").withColumnRenamed("key", key)


@dataclass(frozen=True)
class Reliability:
    """Per kind: how likely a labeler votes 1, 0 or -1 on a true and on a false span, and the prior."""

    prior: float
    true: np.ndarray
    false: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        at = np.arange(votes.shape[1])
        yes = np.log(self.prior) + np.log(self.true[at, votes + 1]).sum(axis=1)
        no = np.log(1 - self.prior) + np.log(self.false[at, votes + 1]).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> Reliability:
    """Expectation-maximisation over distinct vote patterns and how often each occurs.

    It starts from the votes' majority. A few pseudo-votes keep every probability away from zero,
    with a labeler taken to be right more often than wrong.
    """
    hope = np.array([[0.2, 1.0, 1.0]] * votes.shape[1])
    belief = 1 / (1 + np.exp(-2.0 * votes.sum(axis=1)))
    for _ in range(rounds):
        tables = []
        for weight, start in ((counts * belief, hope), (counts * (1 - belief), hope[:, ::-1])):
            seen = np.stack([[weight[votes[:, k] == v].sum() for v in (-1, 0, 1)] for k in range(votes.shape[1])])
            tables.append((seen + start) / (seen + start).sum(axis=1, keepdims=True))
        prior = ((counts * belief).sum() + 1) / (counts.sum() + 2)
        model = Reliability(float(np.clip(prior, 0.01, 0.99)), *tables)
        belief = model.posterior(votes)
    return model


@dataclass(frozen=True)
class Classifier:
    """Weights of a logistic regression: one per kind, and one per level of each mark."""

    kinds: dict[str, float]
    levels: list[list[float]]

    def score(self, kind: str, marks: Sequence[int]) -> float:
        """The log odds that a span is personal data."""
        return self.kinds.get(kind, 0.0) + sum(weights[mark] for weights, mark in zip(self.levels, marks))

    def column(self, kind: Column, marks: Column) -> Column:
        """The same as an expression."""
        known = F.coalesce(*[F.when(kind == name, weight) for name, weight in self.kinds.items()], F.lit(0.0))
        for place, weights in enumerate(self.levels):
            known = known + F.get(F.lit(weights), F.get(marks, F.lit(place)))
        return known


def _features(kinds: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """One column per kind, then one per level of each mark."""
    of_kind = np.stack([kinds == k for k in KINDS], axis=1)
    return np.concatenate([of_kind, *[marks[:, k, None] == np.arange(n) for k, n in enumerate(LEVELS)]], axis=1).astype(float)


def fit_classifier(kinds: np.ndarray, marks: np.ndarray, counts: np.ndarray, target: np.ndarray) -> Classifier:
    """A logistic regression on soft targets, by damped Newton steps."""
    x = _features(kinds, marks)
    share = counts / max(1, counts.sum())
    weights = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        slope = x.T @ (share * (p - target)) + 1e-3 * weights
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(weights))
        weights -= np.linalg.solve(curve, slope)
    starts = np.cumsum([len(KINDS), *LEVELS])
    levels = [weights[a : a + n].tolist() for a, n in zip(starts, LEVELS)]
    return Classifier(dict(zip(KINDS, weights[: len(KINDS)].tolist())), levels)


def learn(spans: DataFrame) -> Classifier:
    """The final span classifier, trained on what expectation-maximisation believes of the votes.

    The labelers' reliabilities are estimated from votes alone; the classifier also sees the kind and the
    shape of a span. Patterns of marks are counted by Spark: a kind has as many as the product of
    ``LEVELS`` at most, so what reaches the driver is bounded whatever the corpus. No spans give a
    classifier without weights.
    """
    flat = spans.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.marks").count()
    flat = flat.orderBy("kind", "marks").collect()
    if not flat:
        return Classifier({}, [[0.0] * n for n in LEVELS])
    kinds = np.array([r["kind"] for r in flat])
    marks = np.array([r["marks"] for r in flat])
    counts = np.array([r["count"] for r in flat], float)
    belief = np.zeros(len(flat))
    for kind in KINDS:
        at = np.nonzero(kinds == kind)[0]
        if len(at):
            votes, place = np.unique(marks[at, : len(LABELERS)] - 1, axis=0, return_inverse=True)
            model = estimate(votes, np.bincount(place.ravel(), counts[at], len(votes)))
            belief[at] = model.posterior(votes)[place.ravel()]
    return fit_classifier(kinds, marks, counts, belief)


def decided_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(key, spans): every base span, and the candidates that the classifier gives ``least`` or more.

    Spans are structs (kind, start, end, based) in code points with exclusive ends, by start and
    then kind as listed. One row per document; null texts are empty and have no spans; rows that
    repeat a key are rows like others; an empty table gives no rows; further columns are not read.
    """
    spans = cut(voted_spans(documents, key, text))
    model, bar = learn(spans), log_odds(least)
    kept = F.filter("spans", lambda s: s["based"] | (model.column(s["kind"], s["marks"]) >= bar))
    rank = F.lit([*KINDS])
    keyed = F.transform(
        kept,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"),
            s["kind"].alias("kind"), s["end"].alias("end"), s["based"].alias("based"),
        ),
    )
    ordered = F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["based"].alias("based"))
    )
    return spans.select(key, ordered.alias("spans"))


def log_odds(chance: float) -> float:
    return math.log(chance / (1 - chance)) if 0 < chance < 1 else math.copysign(math.inf, chance - 0.5)


def span_digest(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans) from :func:`decided_spans`.

    Counts and ``base_sha256`` are of the base spans; ``spans`` lists all as kind:start:end.
    """
    found = decided_spans(documents, key, text)
    listed = lambda column: F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["based"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        key, *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def redact(documents: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents with each span replaced by its kind in brackets, other columns as they are.

    One pass counts votes and one masks every row in its own task, by the same spans as
    :func:`decided_spans`: no shuffle of texts, so repeated keys and hot ones cost nothing. Where spans
    overlap, the run they cover becomes one mark of the first kind. Texts without spans, null ones
    included, stay.
    """
    model, bar = learn(voted_spans(documents, key, text)), log_odds(least)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([_masked(value, model, bar) for value in texts], dtype=object)

    clean = masked.asNondeterministic()(F.col(text)).alias(text)
    return documents.select(*[clean if c == text else documents[c] for c in documents.columns])


def _masked(text: str | None, model: Classifier, bar: float) -> str | None:
    if not text:
        return text
    based = base_spans(text)
    wider = [s for s in candidates(text, based) if model.score(s[0], _marks(text, *s, False)) >= bar]
    out, at = [], 0
    for kind, start, end in sorted(based + wider, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])

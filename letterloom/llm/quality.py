"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "log_bytes", "letters", "upper", "digits", "spaces", "lines", "stops", "commas", "marks", "pipes", "currency",
    "other_signs", "high_bytes", "entropy", "word_length", "word_spread", "long_words", "unique_words",
    "unlettered_words", "upper_words", "signed_words", "line_length", "repeated_lines", "ended_lines", "top_word",
)

#: Byte classes by what they hold.
CLASSES = {
    "letters": bytes(range(65, 91)) + bytes(range(97, 123)),
    "upper": bytes(range(65, 91)),
    "digits": b"0123456789",
    "spaces": b" \t",
    "lines": b"\n\r",
    "stops": b".",
    "commas": b",;:",
    "marks": b"!?",
    "pipes": b"|<>{}[]\\/_=",
    "currency": b"$%&#*@^~+",
    "other_signs": b"\"'()-`",
    "high_bytes": bytes(range(128, 256)),
}
MEMBERS = np.array([[b in held for b in range(256)] for held in CLASSES.values()], float)


def statistics(text: str | None) -> np.ndarray:
    """The features of a whole text; of an empty or null text all are zero."""
    data = (text or "").encode()
    if not data:
        return np.zeros(len(FEATURES))
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = seen[seen > 0] / len(data)
    head = [np.log1p(len(data)), *(MEMBERS @ seen / len(data)), -(share * np.log2(share)).sum()]
    words = text.split()
    if not words:
        return np.array([*head, *[0.0] * (len(FEATURES) - len(head))])
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    n = len(words)
    of_words = lambda test: sum(k for w, k in counts.items() if test(w)) / n
    lines = [line for line in text.split("\n") if line.strip()]
    tail = [
        sizes.mean(), sizes.std(), (sizes > 12).mean(), len(counts) / n,
        of_words(lambda w: not any(map(str.isalpha, w))), of_words(str.isupper),
        of_words(lambda w: w[-1] in "$%&#*|!"),
        np.log1p(len(text) / len(lines)), 1 - len(set(lines)) / len(lines),
        sum(line.rstrip()[-1] in ".!?\"'" for line in lines) / len(lines), max(counts.values()) / n,
    ]
    return np.array([*head, *tail])


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays; node k of a leaf points to itself, so a row may stay there.

    A row of ``feature`` and so on per node; ``root`` has the first node of each tree.
    """

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    depth: int
    base: float

    def score(self, rows: np.ndarray, block: int = 2048) -> np.ndarray:
        """Probabilities: every row walks all trees at once, a level at a time."""
        out = np.empty(len(rows))
        for at in range(0, len(rows), block):
            part = rows[at : at + block]
            node = np.repeat(self.root[None, :], len(part), axis=0)
            line = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[line, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
            out[at : at + block] = 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))
        return out


def fit_trees(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    ridge: float = 1.0,
    least: int = 8,
) -> Trees:
    """Boosting of the log loss on binned features; a table of one class gives a constant.

    Equal inputs give equal trees: ties go to the first feature and the lowest cut.
    """
    flat: list[list[float]] = []  # feature, cut, left, right, value
    root = []
    mean = min(max(labels.mean() if len(labels) else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    if len(np.unique(labels)) == 2:
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in rows.T]
        binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, rows.T)], axis=1)
        lanes = binned + np.arange(rows.shape[1]) * bins
        margin = np.full(len(rows), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - labels, p * (1 - p)
            root.append(len(flat))
            work = [(len(flat), np.arange(len(rows)), 0)]
            flat.append([])
            while work:
                node, held, level = work.pop()
                g, h = grad[held].sum(), hess[held].sum()
                value = -rate * g / (h + ridge)
                split = _best(lanes[held], grad[held], hess[held], bins, ridge, least, g, h) if level < depth else None
                if split is None:
                    flat[node] = [0, 0.0, node, node, value]
                    margin[held] += value
                    continue
                feature, at = split
                goes_left = binned[held, feature] <= at
                flat[node] = [feature, edges[feature][at], len(flat), len(flat) + 1, 0.0]
                work += [(len(flat), held[goes_left], level + 1), (len(flat) + 1, held[~goes_left], level + 1)]
                flat += [[], []]
    table = np.array(flat, float).reshape(-1, 5)
    ints = table.astype(np.int64)
    return Trees(
        ints[:, 0], table[:, 1], ints[:, 2], ints[:, 3], table[:, 4], np.array(root, np.int64), depth, base
    )


def _best(lanes, grad, hess, bins, ridge, least, g, h) -> tuple[int, int] | None:
    """Feature and bin of the split with the largest gain, or none."""
    width = lanes.shape[1]
    flat = lanes.ravel()
    sums = [
        np.bincount(flat, np.repeat(w, width), minlength=width * bins).reshape(width, bins).cumsum(axis=1)
        for w in (grad, hess, np.ones(len(grad)))
    ]
    gl, hl, nl = sums
    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
    gain[(nl < least) | (len(grad) - nl < least)] = 0
    at = int(gain.argmax())
    return divmod(at, bins) if gain.ravel()[at] > 1e-9 else None


def held_out(key: Column) -> Column:
    """The third of the documents whose labels are never learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def train_quality(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", bound: int = 20_000, **boosting
) -> Trees:
    """Trees from a sample of at most ``bound`` labelled documents, none of them held out.

    The sample is the labelled keys with the smallest hashes, so it is the same on every run; its
    size is bounded because the trees are fitted on the driver. Keys without a document, and null
    keys or labels, take no part; a repeated key takes part once for each row. No label left gives
    a constant score.
    """

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(statistics)

    known = labels.select(F.col(key).alias("id"), F.col("quality").cast("double").alias("label")).dropna()
    chosen = known.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "label").limit(bound)
    texts = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", features("text").alias("x"))
    # at most ``bound`` labels, but a key may repeat among documents
    found = rows.orderBy(F.xxhash64("id"), "label").limit(bound).toPandas()
    matrix = np.stack(found["x"].to_list()) if len(found) else np.zeros((0, len(FEATURES)))
    return fit_trees(matrix, found["label"].to_numpy(float), **boosting)


def score_quality(documents: DataFrame, trees: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """The documents with the probability of the label 1, from whole texts; null texts are empty.

    Every row is scored alone, in the task that reads it: no shuffle, no key.
    """
    held = documents.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        rows = [statistics(t) for t in texts]
        return pd.Series(held.value.score(np.stack(rows)) if rows else [], dtype=float)

    return documents.withColumn(out, scored.asNondeterministic()(F.col(text)))


def rate_documents(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted): one row per document, null texts included.

    A null key is not held out. An empty table gives no rows; clashing columns are not read.
    """
    trees = train_quality(documents, labels, key, text)
    scored = score_quality(documents.select(key, text), trees, text)
    away = F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out")
    return scored.select(key, away, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that score 0.5 or more, with all their columns."""
    scored = score_quality(documents, train_quality(documents, labels, key, text), text, "_quality_score")
    return scored.where("_quality_score >= 0.5").drop("_quality_score")

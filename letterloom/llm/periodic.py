"""Periodic runs of words: minimizer pairs at every scale seed them, lag scans find the shortest periods."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Periods below this are found by comparing the words with themselves at each lag.
SHORT = 8
#: Words that are looked at together, about: texts share a block until it holds so many; a longer text has its own.
BLOCK = 500_000


@dataclass(frozen=True)
class Rule:
    """A run of period q has at least ``max(least, times * q)`` words; ``times`` is 4 or more."""

    least: int = 6
    times: int = 4


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _joined(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of two neighbouring stretches as one, for stretches of ``step`` words."""
    return _mixed(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + _mixed(h[step:] + np.uint64(step)))


def minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """The places of the leftmost least value of every ``window`` neighbouring values; ``window`` is a power of two."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    value, place, width = grams, np.arange(len(grams)), 1
    while width < window:
        right = value[width:] < value[:-width]
        place = np.where(right, place[width:], place[:-width])
        value = np.where(right, value[width:], value[:-width])
        width *= 2
    return place[np.concatenate([[True], place[1:] != place[:-1]])]


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words on from ``at`` (back, if ``step`` is -1) equal the word ``lag`` after them."""
    done, size = 0, 64
    while True:
        lo = at + done if step > 0 else max(0, at - done - size + 1)
        hi = min(len(words) - lag, at + done + size) if step > 0 else at - done + 1
        if hi <= lo:
            return done
        differs = words[lo:hi] != words[lo + lag : hi + lag]
        stop = int(np.argmax(differs if step > 0 else differs[::-1]))
        if differs[stop if step > 0 else len(differs) - 1 - stop]:
            return done + stop
        done, size = done + hi - lo, size * 2


def _lag_runs(words: np.ndarray, lag: int, rule: Rule) -> list[tuple[int, int, int]]:
    """(start, length, lag) of each longest stretch whose words equal those ``lag`` later, if it is long enough."""
    same = np.zeros(max(0, len(words) - lag) + 2, np.int8)
    same[1:-1] = words[: len(words) - lag] == words[lag:] if len(words) > lag else 0
    edges = np.diff(same)
    start, end = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    length = end - start + lag
    long = length >= max(rule.least, rule.times * lag)
    return [(s, n, lag) for s, n in zip(start[long].tolist(), length[long].tolist())]


def _scale_runs(words: np.ndarray, grams: np.ndarray, scale: int, rule: Rule) -> list[tuple[int, int, int]]:
    """Runs with periods from ``scale`` to below twice that; ``grams`` hash stretches of ``2 * scale`` words.

    A run of period q has 4 q words or more. The windows of ``scale`` grams that lie in it and their copies q
    words on have their minima q words apart, and inside it no gram comes again at less than q words, since
    two grams of 2 * scale words that overlap so would make the period shorter. So some neighbours among
    the equal minimizers are q apart, and comparing words from there on to both sides gives the whole run.
    """
    places = minimizers(grams, scale)
    order = np.lexsort((places, grams[places]))
    places = places[order]
    value = grams[places]
    lag = places[1:] - places[:-1]
    seed = (value[1:] == value[:-1]) & (lag >= scale) & (lag < 2 * scale)
    at, lag = places[:-1][seed], lag[seed]
    order = np.lexsort((at, lag))
    found, last, covered = [], -1, -1
    for i, q in zip(at[order].tolist(), lag[order].tolist()):
        if q == last and i < covered:
            continue
        on = _reach(words, i, q, 1)
        back = _reach(words, i - 1, q, -1)
        last, covered = q, i + on
        if on + back + q >= max(rule.least, rule.times * q):
            found.append((i - back, on + back + q, q))
    return found


def runs_of(texts: list[np.ndarray], rule: Rule = Rule()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of several texts, given as arrays of word numbers: (text, start, length, period), sorted.

    Texts are laid end to end, the longest first, with a number of its own between each two, which no
    run passes; a scale then concerns a leading part only.
    """
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)])
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    words = np.empty(int(firsts[-1]), np.int64)
    for k, first in zip(order, firsts.tolist()):
        words[first : first + len(texts[k])] = texts[k]
    words[firsts[1:] - 1] = top + np.arange(len(order))

    found = [r for lag in range(1, SHORT) for r in _lag_runs(words, lag, rule)]
    with np.errstate(over="ignore"):
        grams, width, scale = _mixed(words.view(np.uint64) + np.uint64(1)), 1, SHORT
        while True:
            # texts long enough for this scale come first
            used = int(firsts[np.searchsorted(-sizes, -rule.times * scale, "right")])
            if not used:
                break
            grams = grams[:used]
            while width < 2 * scale:
                grams, width = _joined(grams, width), 2 * width
            found += _scale_runs(words[:used], grams, scale, rule)
            scale *= 2
    if not found:
        return tuple(np.zeros((4, 0), np.int64))
    start, length, period = np.array(found, np.int64).T
    # a multiple of the smallest period shows the same stretch: of equal stretches the smallest period stays
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])
    start, length, period = start[first], length[first], period[first]
    row = np.searchsorted(firsts, start, "right") - 1
    start, row = start - firsts[row], np.array(order, np.int64)[row]
    by = np.lexsort((period, start, row))
    return row[by], start[by], length[by], period[by]


def repeats(count: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of a text's words some run contains after its first period."""
    edges = np.zeros(count + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) > 0


def find_runs(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule(), collapsed: bool = True
) -> DataFrame:
    """(key, runs[, collapsed]): one row per document, over whole texts.

    Words are runs without ASCII white space, numbered from 0. ``runs`` are all stretches with the smallest
    period q and at least ``max(least, times * q)`` words that no neighbouring word extends, as structs
    (start, length, period) by start, then period. ``collapsed`` is the text without the words that a run
    contains after its first q words, joined by single spaces. Null texts are empty texts: no runs, an empty
    collapsed text. Rows that repeat a key are rows like others; an empty table gives no rows; further
    columns are not read. No shuffle; a task holds the words of one batch's block, or of one long text.
    """
    if rule.times < 4:
        raise ValueError("runs are found from four periods on")
    kind = documents.schema[key].dataType.simpleString()
    run = "struct<start: long, length: long, period: long>"
    schema = f"key {kind}, runs array<{run}>" + (", collapsed string" if collapsed else "")

    def block(keys: pa.Array, words: list[list[bytes]]) -> pa.RecordBatch:
        numbers, _ = pd.factorize(np.array([w for ws in words for w in ws] + [None], object)[:-1])
        ends = np.cumsum([len(ws) for ws in words])
        row, start, length, period = runs_of(np.split(numbers.astype(np.int64), ends[:-1]), rule)
        offsets = np.searchsorted(row, np.arange(len(words) + 1)).astype(np.int32)
        structs = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], ["start", "length", "period"])
        columns = [keys, pa.ListArray.from_arrays(pa.array(offsets), structs)]
        if collapsed:
            texts = []
            for k, ws in enumerate(words):
                lo, hi = offsets[k], offsets[k + 1]
                if lo < hi:
                    gone = repeats(len(ws), start[lo:hi], length[lo:hi], period[lo:hi]).tolist()
                    ws = [w for w, g in zip(ws, gone) if not g]
                texts.append(b" ".join(ws).decode())
            columns.append(pa.array(texts, pa.string()))
        return pa.RecordBatch.from_arrays(columns, ["key", "runs", "collapsed"][: len(columns)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, first, held = [], 0, 0
            for value in batch.column("text"):
                words.append((value.as_py() or "").encode().split())
                held += len(words[-1])
                if held > BLOCK:
                    yield block(batch.column("key").slice(first, len(words)), words)
                    words, first, held = [], first + len(words), 0
            if words:
                yield block(batch.column("key").slice(first, len(words)), words)

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(scan, schema).withColumnRenamed("key", key)

"""Known names inside texts: hashed word prefixes in flat arrays, walked for many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import regex
import xxhash

# Runs of word characters, and the runs between them.
SEGMENT = regex.compile(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+")
#: Hashes of segments that are kept for later texts.
CACHED = 50_000
#: Characters of the texts that are cut into segments at a time; a segment takes about 100 bytes.
PORTION = 1 << 20


class _Hashes(dict):
    """segment -> its 64-bit hash; emptied when full."""

    def __missing__(self, segment: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        value = self[segment] = xxhash.xxh64_intdigest(segment)
        return value


_hashes = _Hashes()


def _longer(prefix: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of prefixes with one more segment each."""
    h = prefix * np.uint64(0x9E3779B97F4A7C15) + hashes
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hashes(names: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, name, whole) of every prefix of every name, in segments; ``whole`` marks the name itself."""
    cut = [SEGMENT.findall(name) for name in names]
    sizes = np.array([len(segs) for segs in cut], np.int64)
    hashes = np.array([_hashes[s] for segs in cut for s in segs], np.uint64)
    firsts = np.cumsum(sizes) - sizes
    out, live, prefix = [], np.nonzero(sizes > 0)[0], np.zeros(len(names), np.uint64)
    for level in range(int(sizes.max(initial=0))):
        live = live[sizes[live] > level]
        prefix[live] = _longer(prefix[live], hashes[firsts[live] + level])
        out.append((prefix[live], live, sizes[live] == level + 1))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(columns) for columns in zip(*out))


@dataclass(frozen=True)
class Trie:
    """Names by the sorted hashes of their prefixes; ``name`` is the place of the name that ends there, or -1."""

    prefixes: np.ndarray
    name: np.ndarray
    names: list[str]
    labels: list[str]

    @classmethod
    def of(cls, names: Sequence[str], labels: Sequence[str]) -> Trie:
        hashes, name, whole = prefix_hashes(names)
        prefixes, at = np.unique(hashes, return_inverse=True)
        ends = np.full(len(prefixes), -1, np.int64)
        ends[at[whole]] = name[whole]
        return cls(prefixes, ends, list(names), list(labels))

    def known(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.prefixes, hashes)
        at[at == len(self.prefixes)] = 0
        return self.prefixes[at] == hashes if len(self.prefixes) else np.zeros(len(hashes), bool)

    def ends(self, hashes: np.ndarray) -> np.ndarray:
        """For known prefixes the name that ends with it, or -1."""
        return self.name[np.searchsorted(self.prefixes, hashes)]


@dataclass(frozen=True)
class PrefixFilter:
    """A bit per hash of a prefix, in an array of fixed size; a prefix may pass that no name has."""

    bits: np.ndarray

    def known(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes % np.uint64(64 * len(self.bits))).astype(np.int64)
        return (self.bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def segments_of(texts: Iterable[str | None]) -> list[list[str]]:
    return [SEGMENT.findall(text) if text else [] for text in texts]


def walk(cut: list[list[str]], known, longest: int):
    """(text, at, span, prefix hash) arrays for each place and number of segments that ``known`` accepts.

    All places of all texts go one segment further at a time, and those go on whose prefix is known: the
    work is the number of known prefixes.
    """
    sizes = np.array([len(segs) for segs in cut], np.int64)
    hashes = np.array([_hashes[s] for segs in cut for s in segs], np.uint64)
    text = np.repeat(np.arange(len(cut)), sizes)
    ends = np.cumsum(sizes)[text]
    live, prefix = np.arange(len(hashes)), np.zeros(len(hashes), np.uint64)
    found = []
    for span in range(1, longest + 1):
        prefix = _longer(prefix, hashes[live + span - 1])
        ok = known(prefix)
        live, prefix = live[ok], prefix[ok]
        if not len(live):
            break
        found.append((live, np.full(len(live), span), prefix))
        on = live + span < ends[live]
        live, prefix = live[on], prefix[on]
    if not found:
        return tuple(np.zeros((3, 0), np.int64)) + (np.zeros(0, np.uint64),)
    place, span, prefix = (np.concatenate(columns) for columns in zip(*found))
    return text[place], place - (np.cumsum(sizes) - sizes)[text[place]], span, prefix


def keep_longest(count: int, matches: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(at, span, label) of matches (at, span, size, label) that do not overlap: the longest first, then the leftmost.

    A match kept before is no shorter, so it cannot lie inside a later one without one of its ends: two
    looks at the taken places decide.
    """
    taken, kept = bytearray(count), []
    for at, span, _, label in sorted(matches, key=lambda m: (-m[2], m[0])):
        if not taken[at] and not taken[at + span - 1]:
            taken[at : at + span] = b"\1" * span
            kept.append((at, span, label))
    return sorted(kept)


def relabel(segs: list[str], matches: list[tuple[int, int, int, str]]) -> str:
    """The text of the segments with each kept match replaced by its label."""
    out, done = [], 0
    for at, span, label in keep_longest(len(segs), matches):
        out += segs[done:at]
        out.append(label)
        done = at + span
    return "".join([*out, *segs[done:]])


def trie_matches(cut: list[list[str]], trie: Trie, longest: int) -> list[list[tuple[int, int, int, str]]]:
    """For each text its matches (at, span, size, label); the text of each is compared with the name."""
    out: list[list[tuple[int, int, int, str]]] = [[] for _ in cut]
    text, at, span, prefix = walk(cut, trie.known, longest)
    name = trie.ends(prefix) if len(prefix) else np.zeros(0, np.int64)
    whole = name >= 0
    for k, i, n, m in zip(text[whole].tolist(), at[whole].tolist(), span[whole].tolist(), name[whole].tolist()):
        surface = "".join(cut[k][i : i + n])
        if surface == trie.names[m]:
            out[k].append((i, n, len(surface), trie.labels[m]))
    return out


def portions(texts: Sequence[str | None], most: int = PORTION) -> Iterator[slice]:
    """Neighbouring texts of at most so many characters together; a longer text is alone."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        size = len(text) if text else 0
        if at > first and held + size > most:
            yield slice(first, at)
            first, held = at, 0
        held += size
    if first < len(texts):
        yield slice(first, len(texts))


def tagged(texts: Sequence[str | None], trie: Trie, longest: int) -> list[str | None]:
    """The texts with known names replaced by their labels; a text without any is the same.

    Segments are held for a portion of the texts at a time, however many there are.
    """
    out: list[str | None] = []
    for part in portions(texts):
        cut = segments_of(texts[part])
        found = trie_matches(cut, trie, longest)
        out += [relabel(segs, hits) if hits else text for text, segs, hits in zip(texts[part], cut, found)]
    return out

"""Token ids of whole texts through a bounded cache of their space-separated words."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np


class WordCache(dict):
    """word -> its ids as bytes; two generations of at most ``limit`` words bound its memory.

    ``encode`` gives the ids of a word as a list. A word that both generations have lost is encoded
    again, so the size of the cache changes no result.
    """

    def __init__(self, encode: Callable[[str], Iterable[int]], limit: int = 400_000):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = np.array(self.encode(word), np.uint32).tobytes()
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


class SpaceSplit:
    """Encodes a text word by word where that gives the ids of the whole text.

    ``encode_text`` encodes any text; ``encode_word`` a word that follows a space. Words may be
    taken apart at a space only between characters that are not white space, and
    where ``whole`` finds nothing in the text that reaches across spaces.
    """

    def __init__(self, encode_text, encode_word, whole: Callable[[str], bool], limit: int = 400_000):
        self.encode_text, self.whole = encode_text, whole
        self.first, self.rest = WordCache(encode_text, limit // 4), WordCache(encode_word, limit)

    def ids(self, text: str) -> np.ndarray:
        words = text.split(" ")
        if "" in words or self.whole(text):
            return np.array(self.encode_text(text), np.uint32)
        parts = [self.first[words[0]], *map(self.rest.__getitem__, words[1:])]
        return np.frombuffer(b"".join(parts), np.uint32)

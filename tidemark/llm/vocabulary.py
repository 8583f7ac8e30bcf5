"""A bounded set of words that whole texts are looked up in, by hash and then byte by byte.

Words are runs of letters, digits and bytes beyond ASCII, A-Z lowered.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from .text import FOLDED, LETTERS, prefix_hash, ranges, span_hash, word_spans

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK = 1 << 20  # bytes looked up at once


def words_of(data: np.ndarray, offsets: np.ndarray) -> list[list[bytes]]:
    """The lowered words of each text, in order."""
    starts, ends, places = word_spans(data, offsets, LETTERS)
    raw = LOWER[data].tobytes()
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    return [words[a:b] for a, b in zip(places[:-1].tolist(), places[1:].tolist())]


class Vocabulary:
    """Distinct words numbered from 0 in order of their bytes."""

    def __init__(self, words: Iterable[bytes]):
        self.words = sorted(set(words))
        self.number = {w: i for i, w in enumerate(self.words)}
        data = np.frombuffer(b" ".join(self.words), dtype=np.uint8)
        starts, ends, _ = word_spans(data, np.array([0, len(data)]), LETTERS)
        hashes = span_hash(prefix_hash(data, FOLDED), starts, ends)
        self.data, self.starts, self.sizes = data, starts, ends - starts
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        if len(self.hashes) > 1 and (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two words of the vocabulary share a 64-bit hash")

    def __len__(self) -> int:
        return len(self.words)

    def find(self, data: np.ndarray, offsets: np.ndarray):
        """Word numbers (-1: not in the set), starts and ends of all words, and each text's range of them."""
        starts, ends, places = word_spans(data, offsets, LETTERS)
        found = np.full(len(starts), -1, dtype=np.int32)
        low = 0
        while low < len(starts) and len(self):
            high = max(low + 1, int(np.searchsorted(ends, starts[low] + CHUNK, side="right")))
            found[low:high] = self._find(data[starts[low] : ends[high - 1]], starts[low:high] - starts[low], ends[low:high] - starts[low])
            low = high
        return found, starts, ends, places

    def _find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = np.full(len(starts), -1, dtype=np.int32)
        hashes = span_hash(prefix_hash(data, FOLDED), starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        number = self.order[at]
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[number] == ends - starts))
        if len(hit):
            number, size = number[hit], self.sizes[number[hit]]
            same = LOWER[data[ranges(starts[hit], size)]] == self.data[ranges(self.starts[number], size)]
            whole = np.logical_and.reduceat(same, np.cumsum(size) - size)
            found[hit[whole]] = number[whole]
        return found

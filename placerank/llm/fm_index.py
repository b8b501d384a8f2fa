"""A compressed full-text index over a sequence of integers: Burrows-Wheeler transform in a
wavelet matrix, searched backwards for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """A sequence stored bit plane by bit plane, each plane stably sorted by the planes before;
    a plane is 64-bit words with counts of ones before each word."""

    def __init__(self, values: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.n = len(values)
        self.words, self.ones, self.zeros = [], [], []
        values = values.astype(np.int64)
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b) & 1
            padded = np.zeros((self.n // 64 + 1) * 64, dtype=np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            counts = np.bitwise_count(words).astype(np.int32)
            self.ones.append(np.concatenate([np.zeros(1, np.int32), np.cumsum(counts, dtype=np.int32)[:-1]]))
            self.zeros.append(int(self.n - counts.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol occurs at places below ``before`` (arrays of equal size)."""
        low = np.zeros(len(symbol), dtype=np.int32)
        high = before.astype(np.int32)
        both = np.concatenate([low, high])
        k = len(symbol)
        for level, (words, ones, zeros) in enumerate(zip(self.words, self.ones, self.zeros, strict=True)):
            block = both >> 6
            mask = (np.uint64(1) << (both & 63).astype(np.uint64)) - np.uint64(1)
            one = ones[block] + np.bitwise_count(words[block] & mask).astype(np.int32)
            up = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            both = np.where(np.concatenate([up, up]), zeros + one, both - one)
        return both[k:] - both[:k]


class FMIndex:
    """Index of a sequence of symbols >= 1 with 0 as separator, for patterns of up to ``order``
    symbols: its suffixes are sorted by their first ``order`` symbols."""

    def __init__(self, sequence: np.ndarray, order: int = 32):
        n = len(sequence)
        rank = sequence.astype(np.int64)
        span = 1
        while span < order:  # prefix doubling
            after = np.zeros(n, dtype=np.int64)
            after[: n - span] = rank[span:] + 1 if n > span else 0
            rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + after, return_inverse=True)[1]
            span *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.top = int(sequence.max(initial=0))
        self.transform = WaveletMatrix(sequence[self.suffixes - 1], self.top)
        self.smaller = np.searchsorted(sequence[self.suffixes], np.arange(self.top + 2)).astype(np.int32)

    def repeated(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of patterns (rows of equal length): numbers of those that occur at
        least twice, and their ranges of suffixes. A pattern is dropped as soon as its range
        has one suffix left."""
        last = patterns[:, -1]
        alive = np.arange(len(patterns))
        low, high = self.smaller[last], self.smaller[last + 1]
        for j in range(patterns.shape[1] - 2, -2, -1):
            stay = high - low > 1
            if not stay.all():
                alive, low, high = alive[stay], low[stay], high[stay]
            if j < 0 or not len(alive):
                break
            symbol = patterns[alive, j]
            counts = self.transform.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low = self.smaller[symbol] + counts[: len(alive)]
            high = self.smaller[symbol] + counts[len(alive) :]
        return alive, low, high

"""FM-index over integer symbols: suffix array, wavelet matrix ranks, backward search and sampled locate.

All steps work on whole numpy arrays, many patterns or rows at a time.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffix positions by prefix doubling. The last symbol must be smaller than all others."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, step = rank.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while rank.max() < n - 1:
        later = np.zeros(n, np.int64)
        later[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        step *= 2
    return order


class BitRank:
    """Packed bits with a running count per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits ahead of position i."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Rank and access over a sequence of symbols, one bit level after another from the highest."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.depth = max(1, int(largest).bit_length())
        self.levels, self.zeros = [], []
        for level in reversed(range(self.depth)):
            bits = (symbols >> level) & 1
            self.levels.append(BitRank(bits.astype(np.uint8)))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, *positions: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands ahead of each of the given positions."""
        points = [np.zeros_like(positions[0]), *positions]
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            up = (symbol >> (self.depth - 1 - k)) & 1 == 1
            for j, p in enumerate(points):
                one = bits.ones(p)
                points[j] = np.where(up, zeros + one, p - one)
        return [p - points[0] for p in points[1:]]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it stands ahead of it."""
        symbol, first, p = np.zeros_like(i), np.zeros_like(i), i
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            up, one, one_first = bits.get(p), bits.ones(p), bits.ones(first)
            symbol = symbol * 2 + up
            first = np.where(up, zeros + one_first, first - one_first)
            p = np.where(up, zeros + one, p - one)
        return symbol, p - first


class FMIndex:
    """Index of a sequence of symbols >= 1; symbol 0 is its end mark."""

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        text = np.concatenate([symbols.astype(np.int64), [0]])
        order = suffix_array(text)
        self.n, self.largest = len(text), int(text.max())
        self.ranks = WaveletMatrix(text[order - 1], self.largest)
        counts = np.bincount(text, minlength=self.largest + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        kept = order % sample == 0
        self.sampled, self.samples = BitRank(kept.astype(np.uint8)), order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array intervals [low, high) of the rows of ``patterns`` (equal lengths), by backward search."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.flatnonzero((patterns <= self.largest).all(axis=1))
        high[np.setdiff1d(np.arange(len(patterns)), alive, assume_unique=True)] = 0
        for symbol in patterns.T[::-1]:
            if not len(alive):
                break
            s = symbol[alive]
            at_low, at_high = self.ranks.rank(s, low[alive], high[alive])
            low[alive], high[alive] = self.first[s] + at_low, self.first[s] + at_high
            alive = alive[at_high > at_low]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix array rows: walk back to a sampled position and add the steps."""
        rows, found, steps, left = rows.copy(), np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(left):
            here = self.sampled.get(rows[left])
            done = left[here]
            found[done] = self.samples[self.sampled.ones(rows[done])] + steps
            left = left[~here]
            symbol, before = self.ranks.access_rank(rows[left])
            rows[left] = self.first[symbol] + before
            steps += 1
        return found

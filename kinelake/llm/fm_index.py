"""An FM-index over integer symbols in numpy: suffix order, wavelet-matrix ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with a rank directory of one running count per 64 bits."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """The number of ones before position i."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """A wavelet matrix: rank of any symbol before any position in one step per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels, self.zeros = [], []
        for shift in range(self.depth - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = np.zeros_like(i)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbol >> (self.depth - 1 - k)) & 1 == 1
            a, b = level.ones(i), level.ones(start)
            i, start = np.where(one, zeros + a, i - a), np.where(one, zeros + b, start - b)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            one, a = level.get(i), level.ones(i)
            out = out * 2 + one
            i = np.where(one, zeros + a, i - a)
        return out


class FMIndex:
    """Index of a sequence in which 0 parts its texts; patterns hold no 0.

    Separators are told apart by place, so that suffix order is settled inside each text, and the first symbol of each
    text is always sampled, so that no walk to a sample crosses a separator.
    """

    SAMPLE = 16

    def __init__(self, sequence: np.ndarray, sigma: int):
        n = self.n = len(sequence)
        sequence = sequence.astype(np.int64)
        gap = sequence == 0
        rank = np.where(gap, np.cumsum(gap) - 1, sequence - 1 + gap.sum())
        step = 1
        while n:
            follow = np.full(n, -1, np.int64)
            follow[:-step] = rank[step:] if step < n else follow[:-step]
            _, new = np.unique(rank * (n + sigma + 2) + follow + 1, return_inverse=True)
            if int(new.max(initial=0)) == n - 1 or step >= n:
                rank = new
                break
            rank, step = new, step * 2
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        bwt = sequence[suffix - 1]
        self.tree = Wavelet(bwt, sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=sigma))])
        kept = (suffix % self.SAMPLE == 0) | (bwt == 0)
        self.marked = Bits(kept)
        self.sample = suffix[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns at once (rows aligned to the right): the range of suffixes of each."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        live = np.arange(len(patterns))
        for k in range(width):
            live = live[(high[live] > low[live])]
            now = live[lengths[live] > k]
            if not len(now):
                break
            symbol = patterns[now, width - 1 - k]
            low[now] = self.first[symbol] + self.tree.rank(symbol, low[now])
            high[now] = self.first[symbol] + self.tree.rank(symbol, high[now])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes in these rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.marked.get(rows))
        while len(open_):
            symbol = self.tree.access(rows[open_])
            rows[open_] = self.first[symbol] + self.tree.rank(symbol, rows[open_])
            steps[open_] += 1
            open_ = open_[~self.marked.get(rows[open_])]
        return self.sample[self.marked.ones(rows)] + steps

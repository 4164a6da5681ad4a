"""A compressed FM-index over word sequences: a wavelet matrix of the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector, 64 to a word, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Rank of any symbol before any position, a bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels: list[Bits] = []
        for level in range(self.depth - 1, -1, -1):
            one = (symbols >> level) & 1
            self.levels.append(Bits(one.astype(np.uint8)))
            symbols = np.concatenate([symbols[one == 0], symbols[one == 1]])
        every = np.arange(n_symbols)
        self.first = self._down(every, np.zeros(n_symbols, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for n, bits in enumerate(self.levels):
            ones = bits.rank(at)
            right = (symbol >> (self.depth - 1 - n)) & 1 == 1
            at = np.where(right, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.first[symbol]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` by the suffix that starts there, by prefix doubling.

    The first order is by as many symbols as fit into one number.
    """
    n = len(text)
    bits = int(text.max()).bit_length() + 1
    step = max(1, 62 // bits)
    first = np.zeros(n, dtype=np.int64)
    for k in range(step):
        shifted = np.zeros(n, dtype=np.int64)
        shifted[: max(0, n - k)] = text[k:] + 1
        first = first << bits | shifted
    rank = np.unique(first, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Index of word sequences, laid end to end; symbols of words count from 1, 0 ends a sequence.

    ``search`` walks backward from the last word; an interval holds the rows of the sorted
    suffixes that begin with what was read.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray, n_symbols: int):
        count = len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        self.starts = ends - lengths
        self.text = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
        word = np.ones(len(self.text), dtype=bool)
        word[ends] = False
        self.text[word] = words
        # every end is a symbol of its own, so no order depends on what follows it
        apart = self.text + count
        apart[ends] = np.arange(count)
        self.order = suffix_order(apart)
        self.matrix = WaveletMatrix(self.text[self.order - 1], n_symbols)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=n_symbols))])

    def owners(self) -> np.ndarray:
        """Sequence of each sorted suffix."""
        return np.searchsorted(self.starts, self.order, side="right") - 1

    def matches(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number in ``at``, first row, end row) of the windows of the text that occur more than once.

        ``at`` are positions of windows of ``length`` words.  A window occurs at least where it
        is, so the search for it ends as soon as one row is left.
        """
        lane = np.arange(len(at))
        symbol = self.text[at + length - 1]
        low, high = self.smaller[symbol], self.smaller[symbol + 1]
        for back in range(length - 2, -1, -1):
            open_ = high - low > 1
            lane, low, high = lane[open_], low[open_], high[open_]
            if not len(lane):
                break
            symbol = self.text[at[lane] + back]
            both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low = self.smaller[symbol] + both[: len(lane)]
            high = self.smaller[symbol] + both[len(lane) :]
        open_ = high - low > 1
        return lane[open_], low[open_], high[open_]

"""A compressed full-text index over sequences of numbers: Burrows-Wheeler transform in a wavelet matrix.

All operations take arrays of queries. Suffixes are sorted by their first 32 symbols, which is exact for
patterns of up to 31; ties keep the order of the text.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words with the count of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)))

    def ones(self, end: np.ndarray) -> np.ndarray:
        """Ones in [0, end)."""
        word = end >> 6
        mask = (np.uint64(1) << (end & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol at any place, in one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.levels.append((shift, Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the occurrences of ``symbol`` before ``at`` end in the lowest level."""
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at


def _paired(a: np.ndarray, distance: int, last: np.ndarray) -> np.ndarray:
    """One number per place for (a at the place, last ``distance`` further on); zero beyond the end."""
    far = np.zeros_like(last)
    far[:len(last) - distance] = last[distance:]
    return a * (int(last.max(initial=0)) + 1) + far


class FMIndex:
    """Index of ``text``, an array of symbols from 0 to ``alphabet`` - 1, for windows of ``width`` symbols."""

    def __init__(self, text: np.ndarray, alphabet: int, width: int):
        if not 16 < width < 32:
            raise ValueError("windows of 17 to 31 symbols are supported")
        rank = text.astype(np.int64)
        for distance in (1, 2, 4, 8):
            rank = np.unique(_paired(rank, distance, rank), return_inverse=True)[1].astype(np.int64)
        order = np.argsort(_paired(rank, 16, rank), kind="stable")
        self.size = len(text)
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet))))
        self.wavelet = WaveletMatrix(text[order - 1], alphabet)  # before the first symbol stands the last
        self.base = self.wavelet.place(np.arange(alphabet), np.zeros(alphabet, dtype=np.int64))
        self.shorter = self._groups(_paired(rank, width - 1 - 16, rank)[order])
        full = self._groups(_paired(rank, width - 16, rank)[order])
        # The first place in the text of each group of suffixes that agree in ``width`` symbols.
        self.group = np.cumsum(np.bincount(full[:-1], minlength=self.size)[:self.size]) - 1
        self.first = np.minimum.reduceat(order, full[:-1])

    @staticmethod
    def _groups(keys: np.ndarray) -> np.ndarray:
        """Starts of runs of equal keys, and the end."""
        return np.concatenate((np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))), [len(keys)]))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the suffixes that begin with ``symbol`` and go on as those given."""
        shift = self.counts[symbol] - self.base[symbol]
        return shift + self.wavelet.place(symbol, low), shift + self.wavelet.place(symbol, high)

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes that agree with suffix ``low`` in all but the last symbol of a window."""
        at = np.searchsorted(self.shorter, low, side="right")
        return self.shorter[at - 1], self.shorter[at]

    def earliest(self, low: np.ndarray) -> np.ndarray:
        """First place in the text of the window that suffix ``low`` begins with."""
        return self.first[self.group[low]]


def repeated_windows(sequences: list[np.ndarray], width: int) -> list[int]:
    """Per sequence a bit mask of the windows that stand earlier: in an earlier sequence, or further left.

    Matching statistics, cut off at ``width``: each sequence is read from its end; a match of ``width``
    symbols loses its last symbol before the next is put in front. A window whose matching suffixes are
    more than one is reported if the earliest of them is not itself.
    """
    if not sequences:
        return []
    lengths = np.array([len(s) for s in sequences])
    values, symbols = np.unique(np.concatenate(sequences), return_inverse=True)
    # 0 stands between sequences, so no window crosses from one into the next.
    begin = np.cumsum(lengths + 1) - lengths
    text = np.zeros(int(lengths.sum()) + len(lengths) + 1, dtype=np.int64)
    inside = np.arange(len(symbols)) + np.repeat(np.arange(1, len(lengths) + 1), lengths)
    text[inside] = symbols + 1
    index = FMIndex(text, len(values) + 1, width)
    masks = np.zeros(len(sequences), dtype=np.int64)
    low, high = np.zeros(len(sequences), dtype=np.int64), np.full(len(sequences), index.size, dtype=np.int64)
    for taken in range(int(lengths.max())):
        on = np.flatnonzero(lengths > taken)
        at = begin[on] + lengths[on] - 1 - taken
        if taken >= width:
            low[on], high[on] = index.shorten(low[on])
        low[on], high[on] = index.extend(text[at], low[on], high[on])
        if taken >= width - 1:
            more = high[on] - low[on] > 1
            hit = on[more]
            earlier = index.earliest(low[hit]) < at[more]
            masks[hit[earlier]] |= np.int64(1) << (lengths[hit[earlier]] - 1 - taken)
    return masks.tolist()

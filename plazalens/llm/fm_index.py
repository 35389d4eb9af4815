"""An FM-index of a sequence of numbered words: suffix order, wavelet ranks, sampled positions.

Number 0 separates stretches. Separators count as smaller than any word and differ from one
another, so no suffix is compared beyond its stretch. All steps work on many patterns or rows at
once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

STEP = 8
"""Every so many places a row keeps its position, and at the start of each stretch."""
_AT_ONCE = 1 << 18


class Bits:
    """A row of bits and the number of ones before each place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self._words = words
        self._before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self._before[1:])

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self._words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """The number of ones before a place."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[at >> 6] + np.bitwise_count(self._words[at >> 6] & below)


class Wavelet:
    """Ranks of numbers in a sequence: a row of bits for each bit of the numbers, the highest
    first, with the sequence parted by that bit before the next."""

    def __init__(self, numbers: np.ndarray, top: int):
        self._levels: list[tuple[int, Bits, int]] = []
        rest = numbers
        for shift in range(top.bit_length() - 1, -1, -1):
            ones = (rest >> np.uint32(shift)) & np.uint32(1) == 1
            zeros = rest[~ones]
            self._levels.append((shift, Bits(ones), len(zeros)))
            rest = np.concatenate((zeros, rest[ones]))
        every = np.arange(top + 1, dtype=np.uint32)
        self._first = self._follow(every, np.zeros(top + 1, np.int64))

    def _follow(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self._levels:
            ones = bits.ones(at)
            at = np.where((numbers >> np.uint32(shift)) & np.uint32(1) == 1, zeros + ones, at - ones)
        return at

    def rank(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each number stands before a place."""
        return self._follow(numbers, at) - self._first[numbers]

    def number_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number at each place, and how often it stands before it."""
        number = np.zeros(len(at), np.uint32)
        for shift, bits, zeros in self._levels:
            bit, ones = bits.get(at) == 1, bits.ones(at)
            number |= bit.astype(np.uint32) << np.uint32(shift)
            at = np.where(bit, zeros + ones, at - ones)
        return number, at - self._first[number]


def _packed(numbers: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """As many numbers from each place on as fit a word; nothing after a separator."""
    count, n = max(1, 64 // bits), len(numbers)
    keys, alive = np.zeros(n, np.uint64), np.ones(n, bool)
    for ahead in range(count):
        there = np.zeros(n, np.uint32)
        there[: max(0, n - ahead)] = numbers[ahead:]
        there[~alive] = 0
        keys = (keys << np.uint64(bits)) | there
        alive = there != 0
    return keys, count


def suffix_order(numbers: np.ndarray, top: int) -> np.ndarray:
    """The places of a sequence that ends with a separator, by what stands from there on. Places
    that agree so far are told apart by twice as many words in each round."""
    n = len(numbers)
    keys, known = _packed(numbers, max(1, top.bit_length()))
    order = np.argsort(keys, kind="stable")
    in_order = keys[order]
    starts = np.concatenate(([True], in_order[1:] != in_order[:-1]))
    del keys, in_order
    separators = np.flatnonzero(numbers == 0)
    left = separators[np.searchsorted(separators, np.arange(n))] - np.arange(n)
    over = left[order] < known  # the separator is among the words compared: earlier ones are smaller
    group = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = np.where(over, np.arange(n), group)
    open_ = np.flatnonzero(~over & ~(starts & np.concatenate((starts[1:], [True]))))
    del over, left, starts, group
    while len(open_):
        places = order[open_]
        keys = rank[places] * np.int64(n + 1) + rank[places + known]
        by_key = np.argsort(keys, kind="stable")
        places, keys = places[by_key], keys[by_key]
        order[open_] = places
        starts = np.concatenate(([True], keys[1:] != keys[:-1]))
        rank[places] = open_[np.maximum.accumulate(np.where(starts, np.arange(len(open_)), 0))]
        open_ = open_[~(starts & np.concatenate((starts[1:], [True])))]
        known *= 2
    return order


class FMIndex:
    """``numbers``: 0 to ``top``, the last one 0."""

    def __init__(self, numbers: np.ndarray, top: int, step: int = STEP):
        numbers = numbers.astype(np.uint32)
        order = suffix_order(numbers, top)
        before = numbers[order - 1]
        self.size = len(numbers)
        self._wavelet = Wavelet(before, top)
        self._smaller = np.concatenate(([0], np.cumsum(np.bincount(numbers, minlength=top + 1))))
        known = (order % step == 0) | (before == 0)
        self._known, self._positions = Bits(known), order[known].astype(np.int64)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of the suffixes that start with each pattern, a row of words; from
        the last word back to the first. Patterns that do not occur get an empty stretch."""
        last = patterns[:, -1]
        low, high = self._smaller[last].copy(), self._smaller[last + 1].copy()
        for column in range(patterns.shape[1] - 2, -1, -1):
            there = np.flatnonzero(low < high)
            words = patterns[there, column]
            low[there] = self._smaller[words] + self._wavelet.rank(words, low[there])
            high[there] = self._smaller[words] + self._wavelet.rank(words, high[there])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start: back word by word to a kept position."""
        out, walked = np.empty(len(rows), np.int64), 0
        at, which = rows, np.arange(len(rows))
        while len(at):
            known = self._known.get(at) == 1
            out[which[known]] = self._positions[self._known.ones(at[known])] + walked
            at, which = at[~known], which[~known]
            number, rank = self._wavelet.number_and_rank(at)
            at, walked = self._smaller[number] + rank, walked + 1
        return out

    def occurrences(self, patterns: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of patterns and the places where they stand, all of them, in pieces."""
        low, high = self.search(patterns)
        there = np.flatnonzero(low < high)
        ends = np.cumsum(high[there] - low[there])
        for first in range(0, int(ends[-1]) if len(ends) else 0, _AT_ONCE):
            places = np.arange(first, min(first + _AT_ONCE, int(ends[-1])))
            which = np.searchsorted(ends, places, "right")
            pattern = there[which]
            yield pattern, self.locate(high[pattern] - (ends[which] - places))

"""A compressed full-text index over words, as NumPy arrays.

The text is a sequence of segments of symbols.  Its Burrows-Wheeler transform is kept in a
wavelet matrix of packed bits, whose ranks answer backward search; suffix positions are
kept for every ``sample``-th place and for segment starts, and others are found by walking
back to one of those.  All operations work on many patterns at a time.
"""

from __future__ import annotations

import numpy as np


def suffix_array(segments: np.ndarray) -> np.ndarray:
    """Sorted suffixes of ``segments``: symbols from 1, and a 0 after each segment.

    The zeros count as symbols of their own, smaller than all others, in text order, so no
    comparison passes the end of a segment.  Prefixes are doubled, and only suffixes that are
    still tied are sorted again.
    """
    n = len(segments)
    ends = np.flatnonzero(segments == 0)
    symbols = segments.astype(np.int64) + len(ends)
    symbols[ends] = np.arange(len(ends))
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    heads = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    sizes = np.diff(np.append(heads, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, sizes)
    tied = order[np.repeat(sizes > 1, sizes)]
    width = 1
    while len(tied):
        first, second = rank[tied], rank[tied + width]
        order = np.argsort(first * n + second, kind="stable")
        tied, first, second = tied[order], first[order], second[order]
        new_first = np.concatenate(([True], first[1:] != first[:-1]))
        new = new_first | np.concatenate(([True], second[1:] != second[:-1]))
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(tied)))
        group = np.flatnonzero(new_first)
        group_of_head = group[np.searchsorted(group, heads, side="right") - 1]
        rank[tied] = np.repeat(first[heads] + heads - group_of_head, sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        width *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


class _Bits:
    """Packed bits with ranks."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes() + bytes(16 - len(packed) % 8), np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate((np.zeros(1, np.int32), np.cumsum(counts, dtype=np.int32)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << shift) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    def __init__(self, segments: np.ndarray, sample: int = 32) -> None:
        """``segments`` as for `suffix_array`; it must end with a 0."""
        self.size = n = len(segments)
        suffixes = suffix_array(segments)
        last = segments[suffixes - 1]  # of the whole text for the suffix that is all of it
        top = int(segments.max(initial=0))
        self.levels: list[_Bits] = []
        self.zeros: list[int] = []
        self.shifts = range(max(top.bit_length(), 1) - 1, -1, -1)
        row = last
        for shift in self.shifts:
            bits = (row >> shift) & 1 == 1
            self.levels.append(_Bits(bits))
            self.zeros.append(n - int(bits.sum()))
            row = np.concatenate((row[~bits], row[bits]))
        # A symbol's first row, less where its block begins below the last level.
        counts = np.bincount(segments, minlength=top + 1)
        symbols = np.arange(top + 1)
        self.first = np.zeros(top + 1, np.int64)
        below = self._step(symbols, np.zeros(top + 1, np.int64))
        self.first = np.cumsum(counts) - counts - below
        starts = np.concatenate(([True], segments[:-1] == 0))
        kept = starts[suffixes] | (suffixes % sample == 0)
        self.sampled = _Bits(kept)
        self.samples = suffixes[kept]

    def _step(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of ``symbol`` + suffix for the rows ``at``, one symbol each."""
        for bits, zeros, shift in zip(self.levels, self.zeros, self.shifts, strict=True):
            ones = bits.rank(at)
            at = np.where((symbols >> shift) & 1, zeros + ones, at - ones)
        return at + self.first[symbols]

    def _back(self, at: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        symbols = np.zeros(len(at), np.int64)
        for bits, zeros, shift in zip(self.levels, self.zeros, self.shifts, strict=True):
            one, ones = bits.get(at), bits.rank(at)
            symbols |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return at + self.first[symbols]

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Row ranges of the patterns with one more symbol at their front."""
        both = self._step(np.concatenate((symbols, symbols)), np.concatenate((low, high)))
        return both[: len(symbols)], both[len(symbols) :]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns of one length, as rows of symbols that the text may lack."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        top = len(self.first) - 1
        live = np.flatnonzero((patterns <= top).all(axis=1))
        high[np.setdiff1d(np.arange(len(patterns)), live, assume_unique=True)] = 0
        for column in range(patterns.shape[1] - 1, -1, -1):
            low[live], high[live] = self.extend(patterns[live, column], low[live], high[live])
            live = live[high[live] > low[live]]
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes given by row."""
        found = np.empty(len(rows), np.int64)
        steps, at, which = 0, rows, np.arange(len(rows))
        while len(at):
            known = self.sampled.get(at)
            found[which[known]] = self.samples[self.sampled.rank(at[known])] + steps
            at, which, steps = self._back(at[~known]), which[~known], steps + 1
        return found


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of the ranges, and the range each belongs to."""
    sizes = high - low
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of], of

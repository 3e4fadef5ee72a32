"""A compressed full-text index of word sequences: backward search over a wavelet tree.

The Burrows-Wheeler transform of a block of sequences is held as one packed bit vector for each bit
of a word's number, with a running count for every 64 bits, so a word takes about 1.5 bits for each
doubling of the vocabulary. Searches are arrays: all of them take one step to the left at a time.
"""

from __future__ import annotations

import numpy as np


def _heads(fresh: np.ndarray) -> np.ndarray:
    """Of each place, the last place up to it where ``fresh`` holds."""
    return np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of symbols in order. Zeros end sequences and differ: the earlier is smaller.

    Ranks by h symbols give ranks by 2h symbols. Only suffixes that are still tied take part, and
    ties end with a sequence, so rounds are bounded by the logarithm of the longest one.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    counts = np.bincount(symbols)
    rank = (np.cumsum(counts) - counts)[symbols]
    rank[ends] = np.arange(len(ends))
    active = np.flatnonzero((counts[symbols] > 1) & (symbols > 0))
    h = 1
    while len(active):
        base, key = rank[active], rank[active + h]
        sort = np.lexsort((key, base))
        at, base, key = active[sort], base[sort], key[sort]
        group = np.r_[True, base[1:] != base[:-1]]
        fresh = group | np.r_[True, key[1:] != key[:-1]]
        rank[at] = base + _heads(fresh) - _heads(group)
        alone = fresh & np.r_[fresh[1:], True]
        active = at[~alone]
        h *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


class WaveletTree:
    """How often a symbol stands before a place of a sequence, level by level from its highest bit."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level & 1).astype(np.uint8)
            packed = np.packbits(bits, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view("<u8")
            ones = np.bitwise_count(packed)
            self.words.append(packed)
            self.counts.append((np.cumsum(ones, dtype=np.uint32) - ones).astype(np.uint32))
            self.zeros.append(len(bits) - int(bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.first = np.zeros(size, dtype=np.int64)
        self.first = self.rank(np.arange(size), np.zeros(size, dtype=np.int64))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            word = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.words[k][word] & below).astype(np.int64)
            place = np.where(symbol >> (self.levels - 1 - k) & 1, self.zeros[k] + ones, place - ones)
        return place - self.first[symbol]


class FMIndex:
    """Sequences, each followed by a zero, and how much each of them counts."""

    def __init__(self, symbols: np.ndarray, weights: np.ndarray):
        self.size = len(symbols)
        order = suffix_array(symbols)
        counts = np.bincount(symbols)
        self.starts = np.cumsum(counts) - counts
        self.tree = WaveletTree(symbols[order - 1], len(counts))
        owner = np.cumsum(symbols == 0) - (symbols == 0)
        self.weight = np.r_[0, np.cumsum(weights[owner[order]])]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the suffixes that begin with the symbol and go on as those of the given ones."""
        both = self.tree.rank(np.r_[symbol, symbol], np.r_[low, high])
        start = self.starts[symbol]
        return start + both[: len(symbol)], start + both[len(symbol) :]

    def search(self, text: np.ndarray, first: np.ndarray, last: np.ndarray, least: int) -> np.ndarray:
        """Backward search of text[first..last], each: the place below the longest part up to ``last``
        that counts ``least`` or more, ``first`` - 1 where all of it does."""
        out = first - 1
        active = np.arange(len(first))
        place, low = last.copy(), np.zeros(len(first), dtype=np.int64)
        high = np.full(len(first), self.size, dtype=np.int64)
        while len(active):
            low, high = self.extend(text[place], low, high)
            enough = self.weight[high] - self.weight[low] >= least
            out[active[~enough]] = place[~enough]
            go = enough & (place > first[active])
            active, place, low, high = active[go], place[go] - 1, low[go], high[go]
        return out


def repeated(index: FMIndex, text: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> list[tuple]:
    """Intervals (from, to) of window starts between ``first`` and ``last`` whose windows count twice or more.

    The longest match up to the end of an interval decides all windows inside it. Where it is too
    short, the match of the first window shows how many windows hold its mismatch; what neither
    decides is halved.
    """
    found = []
    while len(first):
        stop = index.search(text, first, last + window - 1, 2)
        from_ = np.maximum(stop + 1, first)
        some = from_ <= last
        found.append((from_[some], last[some]))
        # A mismatch behind the last start rules out that window alone.
        last = np.where(some, from_, last) - 1
        left = first <= last
        first, last = first[left], last[left]
        if not len(first):
            break
        stop = index.search(text, first, first + window - 1, 2)
        some = stop < first
        found.append((first[some], first[some]))
        first = np.where(some, first, stop) + 1
        left = first <= last
        first, last = first[left], last[left]
        middle = (first + last) // 2
        more = middle < last
        first, last = np.r_[first, middle[more] + 1], np.r_[middle, last[more]]
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 2

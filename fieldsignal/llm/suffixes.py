"""Suffix sorting of a block of text: the bucket's suffixes by difference-cover ranks."""

from __future__ import annotations

import numpy as np

#: Period of the difference cover. Every difference of two residues is one of two members.
PERIOD = 64
COVER = np.array(sorted({8 * k % PERIOD for k in range(1, 9)} | set(range(1, 9))))
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: By difference d: a residue x such that x and x + d are both in the cover.
_MEET = np.array([next(x for x in COVER if _IN_COVER[(x + d) % PERIOD]) for d in range(PERIOD)])
#: Zero bytes that have to follow the text.
PAD = 4 * PERIOD


def _heads(fresh: np.ndarray) -> np.ndarray:
    """Of each place, the last place up to it where ``fresh`` holds."""
    return np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))


def _split(base: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Refine by a key the groups of ``active``, which share a base; returns those still tied."""
    sort = np.lexsort((key, base[active])) if base[active[0]] != base[active[-1]] or len(active) < 2 else None
    if sort is None:
        first = base[active].min() == base[active].max()
        sort = np.argsort(key, kind="stable") if first else np.lexsort((key, base[active]))
    a, k = active[sort], key[sort]
    b = base[a]
    group = np.r_[True, b[1:] != b[:-1]]
    fresh = group | np.r_[True, k[1:] != k[:-1]]
    head = _heads(fresh)
    base[a] = b + head - _heads(group)
    alone = fresh & np.r_[fresh[1:], True]
    return a[~alone]


def _by_prefix(text: np.ndarray, places: np.ndarray, words: int) -> np.ndarray:
    """Of each place, its rank among all by ``8 * words`` bytes; equal ones share the least rank."""
    view = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    base, active = np.zeros(len(places), dtype=np.int64), np.arange(len(places))
    for w in range(words):
        if not len(active):
            break
        active = _split(base, active, view[places[active] + 8 * w].astype(np.uint64))
    return base


def cover_ranks(text: np.ndarray) -> np.ndarray:
    """By place: the rank of each cover-sample place by its first two periods of bytes, elsewhere 0."""
    size = len(text) - PAD
    sample = np.flatnonzero(np.tile(_IN_COVER, -(-(size + PERIOD) // PERIOD)))
    rank = np.zeros(len(text), dtype=np.int64)
    base = _by_prefix(text, sample, PERIOD // 8)
    rank[sample] = base + 1
    tied = np.bincount(base, minlength=len(base))[base] > 1
    active = np.flatnonzero(tied)
    if len(active):
        active = active[np.argsort(base[active], kind="stable")]
        _split(base, active, rank[sample[active] + PERIOD])
        rank[sample] = base + 1
    return rank


def sort_suffixes(text: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at the places, and of each in that order its rank by the first period.

    Suffixes that agree in a whole period are told apart by the ranks of the cover-sample places
    that both reach by one shift: groups are parted round a pivot until each holds one suffix, or
    suffixes that agree in two periods.
    """
    base = _by_prefix(text, places, PERIOD // 8)
    first = base.copy()
    counts = np.bincount(base, minlength=len(places) or 1)
    active = np.flatnonzero(counts[base] > 1)
    active = active[np.argsort(base[active], kind="stable")]
    rank = cover_ranks(text) if len(active) else None
    while len(active):
        b = base[active]
        group = np.r_[True, b[1:] != b[:-1]]
        head = _heads(group)
        sizes = np.diff(np.r_[np.flatnonzero(group), len(active)])
        pivot = places[active[head + np.repeat(sizes // 2, sizes)]]
        mine = places[active]
        shift = (_MEET[(pivot - mine) % PERIOD] - mine) % PERIOD
        side = np.sign(rank[mine + shift] - rank[pivot + shift])
        sort = np.lexsort((side, b))
        a, s = active[sort], side[sort]
        fresh = group | np.r_[True, s[1:] != s[:-1]]
        base[a] = base[a] + _heads(fresh) - _heads(group)
        alone = fresh & np.r_[fresh[1:], True]
        active = a[~alone & (s != 0)]
    order = np.argsort(base, kind="stable")
    return order, first[order]


def repeats(text: np.ndarray, places: np.ndarray, order: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Along the sorted suffixes: whether each agrees with the one before in ``length`` bytes."""
    same = np.r_[False, first[1:] == first[:-1]]
    at = np.flatnonzero(same)
    view = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    for k in [*range(PERIOD, length - 7, 8), length - 8]:
        a, b = places[order[at]] + k, places[order[at - 1]] + k
        at = at[view[a] == view[b]]
    out = np.zeros(len(order), dtype=bool)
    out[at] = True
    return out

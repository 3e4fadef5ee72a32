"""Small numpy helpers for one block of consecutive samples of a signal.

A block knows its neighbourhood through two tuples, so that its result is the one the
whole series would give: ``left`` is (value, first position, direction) of the run of
equal samples that ends just before the block, ``right`` is (value, last position,
direction after it) of the run that starts just behind it. Both are None at the ends.
"""

from __future__ import annotations

import numpy as np

# Sifts per mode, and extrema of each kind needed to go on.
SIFTS_PER_MODE = 8
MIN_EXTREMA = 3


def turning_points(h: np.ndarray, start: int = 0, left=None, right=None):
    """Positions of the block's peaks and troughs in the series.

    A run of equal samples counts once, at its midpoint; runs that touch an end of the
    series do not count. A run across blocks belongs to the block of its midpoint.
    """
    change = np.flatnonzero(h[1:] != h[:-1])
    first = np.concatenate(([0], change + 1)) + start
    last = np.concatenate((change, [h.size - 1])) + start
    level = h[first - start]
    steps = np.sign(np.diff(level))
    rise, fall = np.concatenate(([0.0], steps)), np.concatenate((steps, [0.0]))
    if left is not None:
        value, position, direction = left
        if value == level[0]:
            first[0], rise[0] = position, direction
        else:
            rise[0] = np.sign(level[0] - value)
    if right is not None:
        value, position, direction = right
        if value == level[-1]:
            last[-1], fall[-1] = position, direction
        else:
            fall[-1] = np.sign(value - level[-1])
    middle = (first + last) // 2
    own = (middle >= start) & (middle < start + h.size)
    return middle[own & (rise > 0) & (fall < 0)], middle[own & (rise < 0) & (fall > 0)]


def envelope(h: np.ndarray, start: int, size: int, points: np.ndarray, before=None, after=None) -> np.ndarray:
    """Straight lines through the extrema and the two ends of the series, per sample.

    ``before`` and ``after`` are the nearest (position, value) outside the block;
    ``size`` is the length of the series.
    """
    ends = [p for p in (0, size - 1) if start <= p < start + h.size]
    at = np.unique(np.concatenate((points, np.array(ends, dtype=points.dtype))))
    value = h[at - start]
    if before is not None:
        at, value = np.concatenate(([before[0]], at)), np.concatenate(([before[1]], value))
    if after is not None:
        at, value = np.concatenate((at, [after[0]])), np.concatenate((value, [after[1]]))
    return np.interp(np.arange(start, start + h.size), at, value)


def _turns(h: np.ndarray):
    """Turning points of a piece; the short way where no two neighbours are equal or missing."""
    step = h[1:] - h[:-1]
    up = step > 0
    if np.count_nonzero(up) + np.count_nonzero(step < 0) < step.size:
        return turning_points(h)
    turn = np.flatnonzero(up[1:] != up[:-1])
    peak = up[turn]
    return turn[peak] + 1, turn[~peak] + 1


def _lines(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Straight lines through the samples at the sorted positions, from the first to the last of them."""
    value, length = h[at], np.diff(at)
    made = np.arange(at[0], at[-1] + 1.0)
    made[:-1] -= np.repeat(at[:-1], length)
    made[:-1] *= np.repeat(np.diff(value) / length, length)
    made[:-1] += np.repeat(value[:-1], length)
    made[-1] = value[-1]
    return made


def proven_mode(x: np.ndarray, start: int, size: int):
    """The first mode of a series of ``size`` samples, as far as a window of it from ``start`` proves it.

    Returns the proven samples and their offset in the window; None if the window does not show that
    a sift goes on. A sift is known between the outermost extrema of both kinds that are known, since
    envelopes do not look further; at an end of the series it is known up to the end. A window of the
    whole series proves everything.
    """
    h, low = x, 0
    to_left, to_right = start == 0, start + x.size == size
    for _ in range(SIFTS_PER_MODE):
        peaks, troughs = _turns(h)
        if min(peaks.size, troughs.size) < MIN_EXTREMA:
            return (h, low) if to_left and to_right else None
        ends = [p for p, known in ((0, to_left), (h.size - 1, to_right)) if known]
        if ends:
            peaks, troughs = (np.union1d(points, ends) for points in (peaks, troughs))
        first, stop = max(peaks[0], troughs[0]), min(peaks[-1], troughs[-1]) + 1
        if stop <= first:
            return None
        upper, lower = (_lines(h, at)[first - at[0] : stop - at[0]] for at in (peaks, troughs))
        h, low = h[first:stop] - (upper + lower) / 2, low + int(first)
    return h, low


def first_mode(x: np.ndarray) -> np.ndarray:
    """Repeated subtraction of the mean envelope, for a signal that is one whole block."""
    return proven_mode(x, 0, x.size)[0]


def window_mode(x: np.ndarray, start: int, size: int):
    """``proven_mode`` as (samples of the whole window, NaN where nothing is proven, low, high)."""
    made = proven_mode(x, start, size)
    if made is None:
        return None
    low, high = made[1], made[1] + made[0].size
    h = np.full(x.size, np.nan)
    h[low:high] = made[0]
    return h, low, high


def noise_mode(seed: int, series: int, trial: int, start: int, stop: int, size: int, number: int):
    """Mode ``number`` of a trial's noise (0: the noise itself) as far as the window [start, stop) proves it.

    Returns its samples, or None for a noise that ends before, and their offset in the window; None if
    the window does not prove which it is.
    """
    rest, low = white_noise(seed, series, trial, start, stop - start), 0
    for k in range(1, number + 1):
        made = proven_mode(rest, start + low, size)
        if made is None:
            return None
        mode, skipped = made
        low += skipped
        if k == number:
            return mode, low
        rest = rest[skipped : skipped + mode.size] - mode
        if not is_oscillating(rest):
            return (None, 0) if rest.size == size else None
    return rest, low


def ensemble_mode(
    x: np.ndarray, start: int, size: int, own: tuple[int, int], spread: float, number: int, trials: int, scale: float,
    seed: int, series: int,
):
    """Mean over the trials of the first mode of a signal with mode ``number`` of their noise, for the positions
    ``own`` of a window from ``start``; None if the window does not prove it for some trial.

    A trial whose noise has no such mode goes on without noise.
    """
    found = []
    for trial in range(1, trials + 1):
        noise = noise_mode(seed, series, trial, start, start + x.size, size, number)
        if noise is None:
            return None
        added, low = noise
        disturbed = x if added is None else x[low : low + added.size] + added * spread * scale
        made = proven_mode(disturbed, start + low, size)
        if made is None:
            return None
        at = start + low + made[1]
        if own[0] < at or at + made[0].size < own[1]:
            return None
        found.append(made[0][own[0] - at : own[1] - at])
    return np.mean(np.stack(found), axis=0)


def is_oscillating(h: np.ndarray) -> bool:
    return sum(points.size for points in _turns(h)) > 2


def all_modes(x: np.ndarray, limit: int) -> list[np.ndarray]:
    """Up to ``limit`` modes of a signal that is one whole block, and what they leave."""
    found, rest = [], x
    while len(found) < limit:
        found.append(first_mode(rest))
        rest = rest - found[-1]
        if not is_oscillating(rest):
            break
    return [*found, rest]


def edge_changes(h: np.ndarray, start: int):
    """First and last position inside the block where the sample differs from the one
    before, each with the sign of that step; None if the block is flat."""
    change = np.flatnonzero(h[1:] != h[:-1]) + 1
    if not change.size:
        return None, None
    return tuple((int(start + i), int(np.sign(h[i] - h[i - 1]))) for i in (change[0], change[-1]))


def white_noise(seed: int, series: int, trial: int, start: int, size: int) -> np.ndarray:
    """Standard normal samples that depend only on seed, series, trial and position.

    Positions are hashed by the splitmix64 finaliser and paired by Box and Muller, so a
    block gets the same noise however the data is partitioned.
    """
    mask = (1 << 64) - 1
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + series * 0xBF58476D1CE4E5B9 + trial * 0x94D049BB133111EB) & mask)

    def uniform(offset: int) -> np.ndarray:
        z = (2 * np.arange(start, start + size, dtype=np.uint64) + np.uint64(offset)) * np.uint64(0x9E3779B97F4A7C15) + key
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)

    return np.sqrt(-2.0 * np.log1p(-uniform(0))) * np.cos(2 * np.pi * uniform(1))

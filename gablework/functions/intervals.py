"""Intervals and values in numpy: for each value the interval that holds it, or else the nearest."""

from __future__ import annotations

import numpy as np


def _level(n: np.ndarray) -> np.ndarray:
    """The exponent of the largest power of two that is no larger."""
    return np.frexp(n)[1] - 1


def least_cover(lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """For each place below size the least k with lo[k] <= place < hi[k], or len(lo). Every range is two of a power of two, and these are halved
    together from the longest on."""
    none = len(lo)
    table, level = np.full(size, none), np.where(hi > lo, _level(hi - lo), -1)
    for n in range(level.max(initial=-1), -1, -1):
        (at,) = np.nonzero(level == n)
        np.minimum.at(table, lo[at], at)
        np.minimum.at(table, hi[at] - (1 << n), at)
        if n:
            half, wide = 1 << (n - 1), table
            table = wide.copy()
            table[half:] = np.minimum(table[half:], wide[:-half])
    return table


def least_within(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of values[lo:hi] for each pair; none may be empty."""
    tables, width = [values], 1
    while 2 * width <= len(values):
        tables.append(np.minimum(tables[-1][:-width], tables[-1][width:]))
        width *= 2
    out, level = np.empty(len(lo), values.dtype), _level(hi - lo)
    for n in np.unique(level):
        at = level == n
        out[at] = np.minimum(tables[n][lo[at]], tables[n][hi[at] - (1 << n)])
    return out


def _beyond(v: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest interval that starts above each value, of equally near ones the first, and how far away it is; len(starts) and infinity
    if there is none."""
    order = np.argsort(starts, kind="stable")
    sorted_ = starts[order]
    first = np.searchsorted(sorted_, v, "right")
    k, d = np.full(len(v), len(starts)), np.full(len(v), np.inf)
    (at,) = np.nonzero(first < len(starts))
    lo = first[at]
    d[at] = sorted_[lo] - v[at]
    hi = np.searchsorted(sorted_, sorted_[lo], "right")
    # Different starts may be equally far away once the difference is rounded.
    while (more := np.nonzero((hi < len(starts)) & (sorted_[np.minimum(hi, len(starts) - 1)] - v[at] == d[at]))[0]).size:
        hi[more] = np.searchsorted(sorted_, sorted_[hi[more]], "right")
    if at.size:
        k[at] = least_within(order, lo, hi)
    return k, d


def nearest(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the k with the least (max(low[k] - v, v - high[k], 0), k), and that distance. There must be an interval. Values and
    ends that are not finite or not in order are compared one by one."""
    plain = (low <= high) & (low < np.inf) & (high > -np.inf)
    own = np.flatnonzero(plain)
    at = np.isfinite(v)
    u, back = np.unique(v[at], return_inverse=True)
    k, d = np.full(len(v), len(low)), np.full(len(v), np.inf)
    if len(u) and len(own):
        lo, hi = low[own], high[own]
        held = least_cover(np.searchsorted(u, lo, "left"), np.searchsorted(u, hi, "right"), len(u))
        (above, up), (below, down) = _beyond(u, lo), _beyond(-u, -hi)
        out = np.where(up < down, above, np.where(down < up, below, np.minimum(above, below)))
        out, away = np.where(held < len(own), held, out), np.where(held < len(own), 0.0, np.minimum(up, down))
        k[at], d[at] = own[out][back], away[back]
    for n in np.flatnonzero(~plain):
        _take(k, d, at, n, v, low, high)
    if not at.all():
        for n in range(len(low)):
            _take(k, d, ~at, n, v, low, high)
    return k, d


def _take(k: np.ndarray, d: np.ndarray, at: np.ndarray, n: int, v: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Interval n for the values at, where it is nearer, or as near and before the one they have. No number is the largest distance."""
    far = np.zeros(len(v))
    with np.errstate(invalid="ignore"):
        # An open end says nothing of any value.
        if low[n] != -np.inf:
            far = np.maximum(far, low[n] - v)
        if high[n] != np.inf:
            far = np.maximum(far, v - high[n])
    same = (far == d) | (np.isnan(far) & np.isnan(d))
    nearer = at & ((k == len(low)) | (far < d) | (np.isnan(d) & ~np.isnan(far)) | (same & (n < k)))
    k[nearer], d[nearer] = n, far[nearer]

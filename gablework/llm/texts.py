"""Vectorised views of whole texts: words, their hashes and shingles, for batches of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text that are worked on at a time (a longer text is worked on alone).
RUN = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []


def runs(offsets: np.ndarray, size: int = RUN) -> Iterator[tuple[int, int]]:
    """Row ranges of about size bytes."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[:] = [np.concatenate(([np.uint64(1)], np.multiply.accumulate(np.full(size, b, np.uint64)))) for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def spans(letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of true bytes within rows, and the index of each row's first run."""
    n = len(letters)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n, bool)
    inner = offsets[1:-1]
    cut[inner[inner < n]] = True
    before = np.concatenate(([False], letters[:-1]))
    starts = np.flatnonzero(letters & (~before | cut))
    after = np.concatenate((letters[1:], [False]))
    ends = np.flatnonzero(letters & (~after | np.concatenate((cut[1:], [True])))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes (starts ascending). Spans are worked on by about RUN bytes at a time."""
    if len(data) <= 2 * RUN:
        return _hashes(data, starts, ends)
    out, lo = np.empty(len(starts), np.uint64), 0
    while lo < len(starts):
        a = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(starts, a + RUN)))
        out[lo:hi] = _hashes(data[a : ends[hi - 1]], starts[lo:hi] - a, ends[lo:hi] - a)
        lo = hi
    return out


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def distinct(rows: np.ndarray, keys: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of each row with their counts: row, key (44 bits), count; sorted by row. Row numbers below 2**20."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    both = (rows.astype(np.uint64) << np.uint64(44)) | (keys >> np.uint64(20))
    both.sort()
    new = np.concatenate(([True], both[1:] != both[:-1]))
    at = np.flatnonzero(new)
    return (both[at] >> np.uint64(44)).astype(np.int64), both[at] & np.uint64((1 << 44) - 1), np.diff(np.append(at, len(both)))

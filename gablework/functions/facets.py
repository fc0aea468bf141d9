"""Faces of the line work of whole groups, in numpy: groups follow one another, so many are worked on at once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Pairs of rings, or sides, that are compared at once.
PAIRS = 1 << 18


class Faces(NamedTuple):
    """Rings are stretches (first, size) of xy; each face is a ring, with the area that its holes leave. Holes follow one another by face."""

    xy: np.ndarray
    group: np.ndarray
    first: np.ndarray
    size: np.ndarray
    area: np.ndarray
    holes: np.ndarray
    hole_first: np.ndarray
    hole_size: np.ndarray


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all stretches, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def parts(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbouring items whose sizes sum up to no more than most, or single ones."""
    ends, k = np.cumsum(sizes), 0
    while k < len(sizes):
        stop = max(k + 1, int(np.searchsorted(ends, ends[k] - sizes[k] + most, "right")))
        yield slice(k, stop)
        k = stop


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a key of neighbouring rows differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _walked(ends: np.ndarray, vertex: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ring (the least half-edge around the face on the left) and off (how many steps lead to it) of half-edges 2 k and 2 k + 1, from
    either end of edge k (ends: edge, end, coordinate; vertex: edge, end) to the other."""
    d, at = (ends[:, ::-1] - ends).reshape(-1, 2), vertex.ravel()
    order = np.lexsort((np.arctan2(d[:, 1], d[:, 0]), at))
    first = _starts(at[order])
    before = np.roll(order, 1)
    before[first] = order[np.append(first[1:], len(order)) - 1]
    to = np.empty_like(order)
    to[order ^ 1] = before
    ring, off, step = np.arange(len(to)), np.zeros(len(to), np.int64), 1
    while not (near := ring <= ring[to]).all():
        off, ring = np.where(near, off, off[to] + step), np.where(near, ring, ring[to])
        to, step = to[to], step * 2
    return ring, off


def _held(outer: np.ndarray, shell: np.ndarray, group: np.ndarray, first: np.ndarray, size: np.ndarray, area: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """For outer rings the smallest shell of their group that lies all around them, or -1."""
    low, high = (f.reduceat(xy, first) for f in (np.minimum, np.maximum))
    begin = np.searchsorted(group[shell], group[outer])
    count = np.searchsorted(group[shell], group[outer], "right") - begin
    of = np.full(len(outer), -1)
    for part in parts(count, PAIRS):
        k, s = np.repeat(np.arange(len(outer))[part], count[part]), shell[ranges(begin[part], count[part])]
        wide = ((low[s] < low[outer[k]]) & (high[s] > high[outer[k]])).all(axis=1)
        k, s = k[wide], s[wide]
        inside = np.zeros(len(k), bool)
        for few in parts(size[s], PAIRS):
            n, start = size[s[few]], first[s[few]]
            i = ranges(start, n)
            (x1, y1), (x2, y2) = xy[i].T, xy[np.repeat(start, n) + (i - np.repeat(start, n) + 1) % np.repeat(n, n)].T
            x, y = np.repeat(xy[first[outer[k[few]]]], n, axis=0).T
            crossed = ((y1 > y) != (y2 > y)) & (((x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) > 0) == (y2 > y1))
            inside[few] = np.add.reduceat(crossed.astype(np.int64), np.cumsum(n) - n) % 2 == 1
        k, s = k[inside], s[inside]
        order = np.lexsort((s, area[s], k))
        k, s = k[order], s[order]
        new = _starts(k)
        of[k[new]] = s[new]
    return of


def faces(group: np.ndarray, ends: np.ndarray, least_area: float) -> Faces | None:
    """Faces larger than least_area of edges (ends: edge, end, coordinate; finite, with a length) of groups (rising numbers), as
    planar.faces has them."""
    if not len(group):
        return None
    x, y = (np.unique(ends[..., c], return_inverse=True)[1].reshape(-1, 2) for c in (0, 1))
    # Numbers of corners rise with group, x and y; there are far fewer rows than 2^20 in a task.
    vertex = np.unique((group[:, None] * (x.max(initial=0) + 1) + x) * (y.max(initial=0) + 1) + y, return_inverse=True)[1].reshape(-1, 2)
    turned = vertex[:, 0] > vertex[:, 1]
    vertex, ends = (np.where(turned.reshape((-1,) + (1,) * (v.ndim - 1)), v[:, ::-1], v) for v in (vertex, ends))
    one = np.unique(vertex[:, 0] * (vertex.max(initial=0) + 1) + vertex[:, 1], return_index=True)[1]
    group, ends, vertex = group[one], ends[one], vertex[one]
    ring, off = _walked(ends, vertex)
    plain = ring[::2] != ring[1::2]
    if not plain.all():
        group, ends, vertex = group[plain], ends[plain], vertex[plain]
        if not len(group):
            return None
        ring, off = _walked(ends, vertex)
    # The ring's least half-edge is no step away, the one after it as many as the ring has, less one.
    order = np.lexsort((np.where(off == 0, -len(off), -off), ring))
    ring, at = ring[order], vertex.ravel()[order]
    first = _starts(ring)
    size = np.diff(first, append=len(ring))
    start, n = np.repeat(first, size), np.repeat(size, size)
    spot = np.arange(len(ring)) - start
    least = spot[np.lexsort((at, ring))[first]]
    order = order[start + (np.repeat(least, size) + spot) % n]
    xy, group = ends.reshape(-1, 2)[order], group[order[first] >> 1]
    a = xy - xy[start]
    b = a[start + (spot + 1) % n]
    area = np.add.reduceat(a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1], first) / 2.0
    outer, shell = np.flatnonzero(area < 0), np.flatnonzero(area > 0)
    of = _held(outer, shell, group, first, size, area, xy)
    outer, of = outer[of >= 0], of[of >= 0]
    left = area + np.bincount(of, area[outer], len(area))
    out = shell[left[shell] > least_area]
    # Rings of one face have no corner in common, so their first corners tell their order.
    order = np.lexsort((*xy[first[outer]].T[::-1], of))
    outer, of = outer[order], of[order]
    outer = outer[np.isin(of, out)]
    holes = np.bincount(of, minlength=len(area))[out]
    return Faces(xy, group[out], first[out], size[out], left[out], holes, first[outer], size[outer])

"""Faces of line work, components of runs, and the quad fit, against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.config import Settings
from gablework.operators import fitting, graphs, planar

LINES = "grp long, x1 double, y1 double, x2 double, y2 double"


def square(grp, x, y, side):
    p = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
    return [(grp, *map(float, a), *map(float, b)) for a, b in zip(p, p[1:] + p[:1], strict=True)]


def found(df):
    return sorted((r.grp, [tuple(c) for c in r.corners], [[tuple(c) for c in h] for h in r.holes], round(r.area, 6)) for r in df.collect())


def test_faces_with_holes_bridges_and_loose_ends(spark):
    rows = square(1, 0, 0, 10) + square(1, 2, 2, 4) + square(1, 3, 3, 1) + square(1, 13, 12, 2)
    rows += [(1, 10.0, 10.0, 12.0, 12.0), (1, 12.0, 12.0, 13.0, 12.0), (1, 0.0, 0.0, 2.0, 2.0), (1, 15.0, 12.0, 17.0, 11.0), (1, 17.0, 11.0, 18.0, 18.0)]
    rows += [(1, None, 0.0, 1.0, 1.0), (1, 5.0, 5.0, 5.0, 5.0), (1, float("nan"), 0.0, 1.0, 1.0), rows[0], (1, 10.0, 0.0, -0.0, 0.0)]
    # Two triangles that touch at a corner; a path alone; tiny faces.
    rows += [(2, 0.0, 0.0, 1.0, 0.0), (2, 1.0, 0.0, 0.0, 1.0), (2, 0.0, 1.0, 0.0, 0.0), (2, 1.0, 0.0, 2.0, 0.0), (2, 2.0, 0.0, 1.0, 1.0), (2, 1.0, 1.0, 1.0, 0.0)]
    rows += [(3, 0.0, 0.0, 1.0, 1.0)] + square(4, 0, 0, 0.2)
    want = [
        (1, [(0, 0), (10, 0), (10, 10), (0, 10)], [[(2, 2), (2, 6), (6, 6), (6, 2)]], 84), (1, [(2, 2), (6, 2), (6, 6), (2, 6)], [[(3, 3), (3, 4), (4, 4), (4, 3)]], 15),
        (1, [(3, 3), (4, 3), (4, 4), (3, 4)], [], 1), (1, [(13, 12), (15, 12), (15, 14), (13, 14)], [], 4), (2, [(0, 0), (1, 0), (0, 1)], [], 0.5), (2, [(1, 0), (2, 0), (1, 1)], [], 0.5),
    ]
    df = spark.createDataFrame(rows, LINES)
    assert found(planar.faces(df)) == want
    assert found(planar.faces(df.limit(0))) == []


def test_faces_far_from_the_origin_and_a_long_ring(spark):
    n = 300
    ring = [(700_000 + 50 * math.cos(2 * math.pi * k / n), 5_645_000 + 50 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    rows = [(9, *a, *b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)] + square(9, 700_000, 5_645_000, 1) + square(9, 700_010, 5_645_000, 2)
    got = planar.faces(spark.createDataFrame(rows, LINES)).collect()
    whole = n / 2 * 50**2 * math.sin(2 * math.pi / n)
    assert sorted(round(r.area, 3) for r in got) == [1, 4, round(whole - 5, 3)]
    assert sorted(len(r.corners) for r in got) == [4, 4, n] and max(len(r.holes) for r in got) == 2


def test_random_grids_of_edges(spark):
    """Faces of random sub-grids by Euler's rule and by flooding cells."""
    rng, rows, want = random.Random(4), [], {}
    for grp in range(12):
        n, walls = 7, set()
        for x, y in itertools.product(range(n + 1), repeat=2):
            if x < n and rng.random() < 0.7:
                walls.add(((x, y), (x + 1, y)))
            if y < n and rng.random() < 0.7:
                walls.add(((x, y), (x, y + 1)))
        rows += [(grp, *map(float, a), *map(float, b)) if rng.random() < 0.5 else (grp, *map(float, b), *map(float, a)) for a, b in walls]
        seen, sizes = set(), []
        for start in itertools.product(range(-1, n + 1), repeat=2):
            if start in seen:
                continue
            todo, own = [start], {start}
            while todo:
                x, y = todo.pop()
                for nx, ny, wall in ((x + 1, y, ((x + 1, y), (x + 1, y + 1))), (x - 1, y, ((x, y), (x, y + 1))), (x, y + 1, ((x, y + 1), (x + 1, y + 1))), (x, y - 1, ((x, y), (x + 1, y)))):
                    if -1 <= nx <= n and -1 <= ny <= n and wall not in walls and (nx, ny) not in own:
                        own.add((nx, ny))
                        todo.append((nx, ny))
            seen |= own
            if (-1, -1) not in own:
                sizes.append(float(len(own)))
        want[grp] = sorted(sizes)
    got = {grp: [] for grp in want}
    for r in planar.faces(spark.createDataFrame(rows, LINES)).collect():
        got[r.grp].append(round(r.area, 6))
    assert {g: sorted(v) for g, v in got.items()} == want


def _flood(place, start, steps, allowed):
    todo, own = [start], {start}
    while todo:
        x, y = todo.pop()
        for dx, dy in steps:
            p = (x + dx, y + dy)
            if p not in own and allowed(p, place):
                own.add(p)
                todo.append(p)
    return own


@pytest.mark.parametrize("least_heavy", [10_000, 5])
def test_components_and_holes_of_masks(spark, monkeypatch, least_heavy):
    monkeypatch.setattr(graphs, "LEAST_HEAVY", least_heavy)
    monkeypatch.setattr(graphs, "HEAVY", 20)
    monkeypatch.setattr(graphs, "CELL", 4)
    rng, w, h = random.Random(7), 40, 25
    masks = {i: {(x, y) for x in range(w) for y in range(h) if rng.random() < d} for i, d in enumerate((0.3, 0.45, 0.6, 0.9, 1.0))}
    masks[2] -= {(0, 0)}
    # A spiral, so that labels have far to go.
    masks[5] = {(x, y) for y in range(0, h, 2) for x in range(w)} | {(w - 1 if (y // 2) % 2 else 0, y) for y in range(1, h, 2)}
    rows = [(i, x, y) for i, m in masks.items() for x, y in m]
    df = spark.createDataFrame(rows + rows[:50] + [(0, -5, 3)], "img long, x int, y int")
    want, eight = set(), [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    for i, m in masks.items():
        left = set(m)
        while left:
            own = _flood(m, min(left, key=lambda p: (p[1], p[0])), eight, lambda p, place: p in place)
            x, y = min(own, key=lambda p: (p[1], p[0]))
            want |= {(i, *p, (y << 20) + x) for p in own}
            left -= own
    assert {tuple(r) for r in graphs.pixel_components(df.where("x >= 0")).select("img", "x", "y", "label").collect()} == want
    filled = set()
    for i, m in masks.items():
        outer = set() if (0, 0) in m else _flood(m, (0, 0), [(1, 0), (-1, 0), (0, 1), (0, -1)], lambda p, place: 0 <= p[0] < w and 0 <= p[1] < h and p not in place)
        filled |= {(i, x, y) for x in range(w) for y in range(h) if (x, y) not in outer}
    got = [tuple(r) for r in graphs.filled_holes(df, w, h).select("img", "x", "y").collect()]
    assert set(got) == filled and len(got) == len(filled)


def test_graph_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(graphs, "LEAST_HEAVY", 3)
    monkeypatch.setattr(graphs, "HEAVY", 4)
    edges = [(1000, k) for k in range(60)] + [(200 + k, 201 + k) for k in range(40)] + [(5, 220)]
    got = {r.node: r.label for r in graphs.graph_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == {1000, *range(60), *range(200, 241)} and set(got.values()) == {0}


def _plain_fit(seg, wall, steps):
    """The loop over all placements, each by bisection."""
    seg, wall = np.array(seg, float), np.array(wall, float)
    center, size = wall.mean(axis=0), np.maximum(np.ptp(wall, axis=0), 1)
    turned = seg - seg.mean(axis=0)
    area = lambda q: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(q, np.roll(q, -1, axis=0), strict=True))) / 2

    def away(q):
        out = []
        for a, b in zip(wall, np.roll(wall, -1, axis=0), strict=True):
            n = np.array([-(b - a)[1], (b - a)[0]])
            out.append((q - a) @ (n * np.sign(n @ (center - a)) / np.linalg.norm(n)))
        return np.min(out)

    best = None
    for dx in np.linspace(-0.2 * size[0], 0.2 * size[0], steps):
        for dy in np.linspace(-0.2 * size[1], 0.2 * size[1], steps):
            c, lo, hi, grown = center + (dx, dy), 0.0, max(0.05, math.sqrt(area(wall) / area(seg))), 0
            while away(turned * hi + c) >= 0.25 and hi < 6 and grown < 20:
                lo, hi, grown = hi, hi * 1.35, grown + 1
            for _ in range(45):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if away(turned * mid + c) >= 0.25 else (lo, mid)
            new = (lo, math.hypot(dx, dy) / max(math.hypot(*size), 1), away(turned * lo + c), c)
            if best is None or new[0] > best[0] + 1e-9 or (abs(new[0] - best[0]) <= 1e-9 and (new[1] < best[1] - 1e-9 or (abs(new[1] - best[1]) <= 1e-9 and new[2] < best[2] - 1e-9))):
                best = new
    return best


@pytest.mark.parametrize("steps", [21, 31, 41])
def test_quad_fit_equals_the_plain_loop(spark, steps):
    wall = [(0, 0), (40, 4), (44, 30), (-2, 28)]
    cases = {1: ([(1, 1), (5, 2), (6, 6), (0, 5)], wall), 2: ([(0, 0), (0.06, 0), (0.05, 0.03), (0, 0.03)], wall), 3: ([(0, 0), (0.01, 0), (0.01, 0.01), (0, 0.01)], [(0, 0), (90, 0), (90, 50), (0, 50)]), 4: ([(0, 0), (900, 0), (900, 80), (0, 500)], wall)}
    kind = "id long, seg array<struct<x:double,y:double>>, wall array<struct<x:double,y:double>>"
    points = lambda q: [tuple(map(float, p)) for p in q]
    rows = [(i, points(a), points(b)) for i, (a, b) in cases.items()]
    odd = [(10, None, points(wall)), (11, points(wall), None), (12, points(wall), points([(0, 0), (0, 0), (5, 5), (0, 5)])), (13, [(0.0, 0.0)] * 3 + [(None, 1.0)], points(wall)), (14, [(0.0, float("nan"))] * 4, points(wall))]
    got = {r.id: r for r in fitting.fit_quads(spark.createDataFrame(rows + odd, kind), Settings(fit_shift_steps=steps)).collect()}
    assert all(v is None for i in (10, 11, 12, 13, 14) for v in got[i][1:])
    for i, (seg, w) in cases.items():
        scale, away, near, c = _plain_fit(seg, w, steps)
        r = got[i]
        assert r.scale == pytest.approx(scale, rel=1e-7) and r.center_dist == pytest.approx(away, abs=1e-7) and r.min_dist == pytest.approx(near, abs=1e-5)
        assert (r.center_x, r.center_y) == pytest.approx(tuple(c), abs=1e-7) and r.touching == (r.min_dist <= 0.75)
        assert r.tx == pytest.approx(c[0] - scale * np.mean([p[0] for p in seg]), abs=1e-4)


def test_a_quad_without_room_is_a_point(spark):
    """A wall thinner than twice the inset holds nothing."""
    kind = "id long, seg array<struct<x:double,y:double>>, wall array<struct<x:double,y:double>>"
    thin = [(0.0, 0.0), (10.0, 0.0), (10.0, 0.3), (0.0, 0.3)]
    r = fitting.fit_quads(spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], thin)], kind)).first()
    assert r.scale == 0 and r.min_dist < 0.25 and r.center_dist == 0
    assert spark.range(1).select(F.lit(r.touching)).first()[0]

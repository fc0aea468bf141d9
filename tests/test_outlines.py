"""Outlines of masks and segments of edges against brute force and planted shapes."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.operators import outlines, pixels, votes
from tests.test_planar import _flood

EIGHT = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]


def _cross(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def test_hull_and_rectangle_by_brute_force():
    rng = random.Random(2)
    for _ in range(40):
        points = {(float(rng.randrange(9)), float(rng.randrange(9))) for _ in range(rng.randint(1, 14))}
        got = outlines.hull(np.array(sorted(points)))
        # A corner is a point that no triangle or segment of others holds.
        sides = [(a, b) for a, b in itertools.permutations(points, 2) if all(_cross(a, b, c) > 0 or (_cross(a, b, c) == 0 and min(a, b) <= c <= max(a, b)) for c in points)]
        want = {p for s in sides for p in s} or points
        assert {tuple(p) for p in got} == want
        box = outlines.least_rectangle(got)
        sides = np.hypot(*(np.roll(box, -1, axis=0) - box).T)
        if len(want) < 3:
            assert sides[0] * sides[1] == pytest.approx(0, abs=1e-9)
            continue
        p, best = np.array(sorted(points)), math.inf
        for a, b in zip(got, np.roll(got, -1, axis=0), strict=True):
            t = math.atan2(*(b - a)[::-1])
            x, y = p @ [math.cos(t), math.sin(t)], p @ [-math.sin(t), math.cos(t)]
            best = min(best, np.ptp(x) * np.ptp(y))
        assert sides[0] * sides[1] == pytest.approx(best)
        sweep = min(np.ptp(p @ [math.cos(t), math.sin(t)]) * np.ptp(p @ [-math.sin(t), math.cos(t)]) for t in np.linspace(0, math.pi / 2, 500))
        assert best <= sweep + 1e-9
        for a, b in zip(box, np.roll(box, -1, axis=0), strict=True):
            turned = [_cross(a, b, c) for c in p]
            assert min(turned) >= -1e-7 or max(turned) <= 1e-7


def _filled(corners, w, h):
    return {(x, y) for x in range(w) for y in range(h) if all(_cross(a, b, (x, y)) >= 0 for a, b in zip(corners, corners[1:] + corners[:1], strict=True))}


def test_quads_of_masks(spark):
    shape = [(10, 12), (70, 8), (75, 60), (5, 50)]
    masks = {1: _filled(shape, 90, 70), 2: _filled([(5, 5), (25, 5), (25, 20), (5, 20)], 90, 70) | _filled([(60, 40), (80, 40), (80, 65), (60, 65)], 90, 70), 3: {(3, 3), (4, 4)}, 4: {(x, 7) for x in range(20)}}
    masks[5] = {(x, y) for x in range(60) for y in range(60) if (x - 30) ** 2 + (y - 30) ** 2 <= 625}
    rows = [(i, x, y) for i, m in masks.items() for x, y in m]
    df = spark.createDataFrame(rows + rows[:99], "img long, x int, y int")
    got = {r.img: r for r in outlines.mask_quads(df, 10).collect()}
    assert set(got) == {1, 2, 5} and {i: got[i].chunks for i in got} == {1: 1, 2: 2, 5: 1}
    near = lambda q, want: max(min(math.dist(p, c) for p in q) for c in want)
    assert near(got[1].quad, shape) < 1.5 and got[1].quad[0] == min(got[1].quad, key=lambda p: p.x + p.y)
    assert [tuple(p) for p in outlines.chunk_quads(df.where("img = 2"), 10).orderBy("label").selectExpr("struct(x0, y0) as p").toPandas()["p"]] == [(5, 5), (60, 40)]
    assert near(got[2].quad, [(5, 5), (80, 65)]) < 1e-9
    for p in got[5].quad:
        assert 24 < math.dist(p, (30, 30)) < 37
    assert outlines.mask_quads(df.limit(0)).count() == outlines.hulls(df.limit(0)).count() == 0


def test_quads_of_random_masks(spark):
    """The plan, from ends of rows, against all pixels of components found by flooding."""
    rng, masks = random.Random(6), {}
    for i in range(25):
        masks[i] = {(x, y) for x in range(14) for y in range(12) if rng.random() < 0.35}
    df = spark.createDataFrame([(i, x, y) for i, m in masks.items() for x, y in m], "img long, x long, y long")
    want = {}
    for i, m in masks.items():
        left, quads = set(m), []
        while left:
            own = _flood(m, next(iter(left)), EIGHT, lambda p, place: p in place)
            left -= own
            rows = {}
            for x, y in own:
                rows.setdefault(y, set()).add(x)
            if len(own) >= 4 and sum(min(2, len(v)) for v in rows.values()) >= 4:
                quads.append(outlines.quad(np.array(sorted(own), float)))
        if quads:
            want[i] = (len(quads), quads[0] if len(quads) == 1 else outlines.quad(np.concatenate(quads)))
    got = {r.img: r for r in outlines.mask_quads(df, 4).collect()}
    assert set(got) == set(want)
    for i, (n, q) in want.items():
        assert got[i].chunks == n and np.allclose(sorted(map(tuple, got[i].quad)), sorted(map(tuple, q)))


def test_planted_lines_are_found(spark):
    rng, pixels = random.Random(1), set()
    ends = [((10, 15), (180, 15)), ((30, 10), (30, 190)), ((20, 20), (190, 150)), ((60, 180), (180, 60))]
    for a, b in ends:
        n = int(max(abs(b[0] - a[0]), abs(b[1] - a[1])))
        pixels |= {(round(a[0] + (b[0] - a[0]) * k / n), round(a[1] + (b[1] - a[1]) * k / n)) for k in range(n + 1)}
    # One line has a gap that is bridged, another one that isn't.
    pixels -= {(x, 15) for x in range(80, 90)} | {(30, y) for y in range(50, 80)}
    pixels |= {(rng.randrange(200), rng.randrange(200)) for _ in range(300)}
    df = spark.createDataFrame([(1, x, y) for x, y in pixels] * 2, "img long, x int, y int")
    got = votes.segments(df, least_votes=60, least_length=100.0, most_gap=20.0).collect()
    whole = [((10, 15), (180, 15)), ((20, 20), (190, 150)), ((60, 180), (180, 60)), ((30, 80), (30, 190))]
    for a, b in whole:
        assert any(max(math.dist((r.x0, r.y0), p) + math.dist((r.x1, r.y1), q) for p, q in [(a, b)]) < 25 or math.dist((r.x0, r.y0), b) + math.dist((r.x1, r.y1), a) < 25 for r in got), (a, b)
    assert not any(r.x0 == r.x1 == 30 and min(r.y0, r.y1) < 60 for r in got)
    many = {(r.angle, r.rho): r.votes for r in votes.line_votes(df).collect()}
    for k, (c, s) in list(enumerate(votes.directions()))[::30]:
        assert many[k, round(50 * c + 15 * s)] == sum(round(x * c + y * s) == round(50 * c + 15 * s) for x, y in pixels)
    assert votes.segments(df.limit(0)).count() == 0
    assert votes.segments(df.withColumn("img", F.lit(None).cast("long"))).count() == 0


@pytest.mark.parametrize(("radius", "shape"), [(1, "square"), (3, "ellipse"), (9, "ellipse")])
def test_morphology_by_brute_force(spark, radius, shape):
    w, h, rng = 17, 13, random.Random(radius)
    masks = {i: {(x, y) for x in range(w) for y in range(h) if rng.random() < d} for i, d in enumerate((0.05, 0.6, 0.97, 1.0))}
    element = [(dx, dy) for dy, half in pixels._rows(radius, shape).items() for dx in range(-half, half + 1)]
    df = spark.createDataFrame([(i, x, y) for i, m in masks.items() for x, y in m], "img long, x int, y int")
    inside = lambda x, y: 0 <= x < w and 0 <= y < h
    grown = {(i, x + a, y + b) for i, m in masks.items() for x, y in m for a, b in element if inside(x + a, y + b)}
    left = {(i, x, y) for i, m in masks.items() for x, y in m if all((x + a, y + b) in m for a, b in element if inside(x + a, y + b))}
    for df_of, want in ((pixels.dilate, grown), (pixels.erode, left)):
        got = [tuple(r) for r in df_of(df, radius, w, h, shape).collect()]
        assert set(got) == want and len(got) == len(want)
    assert pixels.dilate(df, radius, w, h, shape).dtypes == df.dtypes

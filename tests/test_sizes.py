"""Steps whose work must not grow faster than their input, against plain ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.functions import facets, intervals
from gablework.operators import documents, fitting, graphs, outlines, panoramas, planar, polygons, rings
from gablework.plans import areas
from gablework.plans import tables as t


def plain_nearest(v, lows, highs):
    far = lambda a, b: max(a - v if a != -math.inf else 0.0, v - b if b != math.inf else 0.0, 0.0)
    return min((far(a, b), k) for k, (a, b) in enumerate(zip(lows, highs, strict=True)))


@pytest.mark.parametrize("seed", range(20))
def test_nearest_interval(seed):
    rnd = random.Random(seed)
    n, spread = rnd.randrange(1, 40), rnd.choice((3.0, 30.0))
    low = [rnd.choice((round(rnd.uniform(-spread, spread)), rnd.uniform(-spread, spread), -math.inf)) for _ in range(n)]
    high = [rnd.choice((a, a + rnd.randrange(5), math.inf, rnd.uniform(-spread, spread))) for a in low]
    v = np.array([rnd.choice((float(round(rnd.uniform(-40, 40))), rnd.uniform(-40, 40))) for _ in range(200)])
    k, d = intervals.nearest(v, np.array(low), np.array(high))
    assert list(zip(d.tolist(), k.tolist(), strict=True)) == [plain_nearest(x, low, high) for x in v]


def test_ends_that_round_to_one_distance():
    low = np.array([2e-8, 1e-8])
    assert intervals.nearest(np.array([-1e9]), low, low + 1)[0].tolist() == [0]


def test_areas_in_blocks(spark, monkeypatch):
    """No row for a pair of a point and an area, and the same whatever the blocks."""
    rnd = random.Random(1)
    areas = [(k, k % 3 if k % 10 else None, rnd.uniform(0, 100), None if k % 17 == 0 else rnd.uniform(0, 100)) for k in range(60)]
    points = [(k, k % 4, None if k % 31 == 0 else rnd.uniform(-10, 110)) for k in range(200)]
    open_ = lambda x, far: far if x is None else x
    want = {}
    for i, zone, v in points:
        own = [(k, open_(a, -math.inf), open_(b, math.inf)) for k, z, a, b in areas if z == zone]
        if own:
            d, k = plain_nearest(v, [a for _, a, _ in own], [b for _, _, b in own]) if v is not None else (0.0, 0)
            want[i] = own[k][0], d
    for size in (1 << 17, 7):
        monkeypatch.setattr(panoramas, "BLOCK", size)
        got = panoramas.nearest_or_containing(spark.createDataFrame(points, "id long, zone long, v double"), spark.createDataFrame(areas, "area long, zone long, low double, high double"))
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString().split("FlatMapCoGroupsInArrow")[0]
        assert {r.id: (r.area, r.distance) for r in got.collect()} == want


def test_placements_are_no_rows(spark):
    """A pair's placements are compared where the pair is."""
    kind = "id long, seg array<struct<x double, y double>>, wall array<struct<x double, y double>>"
    square = lambda n: [(0.0, 0.0), (n, 0.0), (n, n), (0.0, n)]
    got = fitting.fit_quads(spark.createDataFrame([(1, square(1.0), square(10.0)), (1, square(1.0), square(10.0)), (2, square(2.0), square(10.0))], kind))
    assert "explode" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.id, r.touching) for r in got.collect()) == [(1, True), (2, True)]


def test_search_makes_no_rows_of_grid_points(spark):
    """The same as the grid points' own nearest panoramas, of those near a line; plans hold no grid, and boxes meet once a building."""
    rnd = random.Random(3)
    bases = [(b, 100.0 * b + x, y, 100.0 * b + x + rnd.uniform(0, 9), y + rnd.uniform(0, 9)) for b in range(12) for x, y in ((0.0, 0.0), (9.0, 2.0), (4.0, 30.0))]
    panos = [(k, rnd.uniform(-60, 1260), rnd.uniform(-60, 90)) for k in range(400)] + [(900 + k, 5.0, 5.0) for k in range(3)]
    bases, panos = spark.createDataFrame(bases, "building long, x1 double, y1 double, x2 double, y2 double"), spark.createDataFrame(panos, "pano_id long, x double, y double")
    got = panoramas.discovered(bases, panos)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 10" not in plan
    zone = {(r.building, r.pano_id) for r in panoramas.in_zone(bases, panos).collect()}
    near = panoramas.nearest_to_grid(panoramas.search_grid(bases), panos).collect()
    assert {(r.building, r.pano_id) for r in got.collect()} == {(r.building, r.pano_id) for r in near} & zone
    p, lines = {r.pano_id: r for r in panos.collect()}, bases.collect()

    def away(o, r):
        dx, dy = r.x2 - r.x1, r.y2 - r.y1
        t = min(max(((o.x - r.x1) * dx + (o.y - r.y1) * dy) / (dx * dx + dy * dy), 0.0), 1.0)
        return math.hypot(o.x - r.x1 - t * dx, o.y - r.y1 - t * dy)

    assert zone == {(r.building, k) for r in lines for k, o in p.items() if away(o, r) < 20}


EDGES = "building long, component int, loop int, ring_order long, seq int, type string, source long, target long, p struct<x:double,y:double,z:double>, q struct<x:double,y:double,z:double>"


def rings_of(rnd, count):
    """Edges of buildings of up to two rings, some of one edge only, some ends missing."""
    rows = []
    for b in range(count):
        for component, loop in rnd.choice(([(0, 0)], [(0, 0), (0, 1)], [(0, None), (None, 1)], [(None, None)])):
            for k in range(rnd.choice((1, 3, 5))):
                x, y, z = 60.0 * b + rnd.uniform(-20, 20), rnd.uniform(-20, 20), rnd.choice((0.0, 4.0))
                p, q = (None if rnd.random() < 0.03 else (x, y, v) for v in (z, 3.0))
                rows.append((b if b else None, component, loop, rnd.choice((1, 2, None)), k, "base", k, k + 1, p, q))
    return rows


def test_states_without_views(spark):
    """Neither a view nor a table between steps is made for a state; walls are sorted by rings once."""
    plan = areas.wall_status(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "cam_x" not in plan and "tile_headings" not in plan and "ExistingRDD" not in plan
    faces = rings.wall_faces(t.edges(spark, "/root/testdata/sf0.001"))
    assert faces._jdf.queryExecution().executedPlan().toString().count("Sort [") == 2
    edges = spark.createDataFrame(rings_of(random.Random(4), 40), EDGES)
    panos = spark.createDataFrame([(k, random.Random(k).uniform(0, 1500), random.Random(-k).uniform(-60, 60)) for k in range(1, 90)], "pano_id long, x double, y double")
    pick = lambda df: sorted(map(tuple, df.where("building is not null").select("building", "wall_index", "status").collect()))
    got = pick(documents.wall_states(edges, panos))
    assert got == pick(documents.building_states(edges, panos)) and len({v for _, _, v in got}) == 3
    walls = rings.wall_faces(edges)
    assert len(got) == walls.where("building is not null").count()
    assert {r.status for r in documents.wall_states(edges, panos).where("building is null").collect()} == {"no_panorama_near_building"}


def test_boxes_of_rings(spark):
    """A building's box is known without the order of its edges."""
    edges = spark.createDataFrame(rings_of(random.Random(5), 60), EDGES)
    bases = t.bases(rings.wall_faces(edges))
    made = [{tuple(r) for r in panoramas._boxes(df, panoramas.Settings()).collect()} for df in (bases, rings.ring_boxes(edges))]
    assert made[0] == made[1] and len(made[0]) > 40
    assert "Window" not in rings.ring_boxes(edges)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rows, pairs", [(2048, 1024), (3, 8), (1, 1)])
def test_search_around_many_panoramas(spark, monkeypatch, rows, pairs):
    """Crowds, ties and boxes over many cells: the same as the grid points' own nearest panoramas, with their first points, whatever the blocks."""
    rnd = random.Random(6)
    bases = [(b, 300.0 * b, -90.0, 300.0 * b + w, -90.0 + w) for b, w in enumerate((5.0, 700.0, 40.0, 5.0))]
    panos = [(k, rnd.uniform(-60, 1300), rnd.uniform(-200, 700)) for k in range(300)] + [(1000 + k, 2.0, -88.0) for k in range(50)] + [(2000 + k, 610.0 + k % 7, -80.0) for k in range(40)]
    bases, panos = spark.createDataFrame(bases, "building long, x1 double, y1 double, x2 double, y2 double"), spark.createDataFrame(panos, "pano_id long, x double, y double")
    monkeypatch.setattr(panoramas, "ROWS", rows)
    monkeypatch.setattr(panoramas, "PAIRS", pairs)
    s = panoramas.Settings()
    boxes = panoramas._boxes(bases, s)
    assert panoramas._met(boxes, panos, {c: (F.col(f"{c}0"), F.col(f"{c}n")) for c in "xy"})._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
    want = {}
    for r in panoramas.nearest_to_grid(panoramas.search_grid(bases), panos).collect():
        key = r.building, r.pano_id
        want[key] = min(want.get(key, (99, 99)), (r.i, r.j))
    got = panoramas._found(boxes, panos, s).collect()
    assert {(r.building, r.pano_id): (r.i, r.j) for r in got} == want and len(got) == len(want) > 30


def test_raster_of_many_polygons(spark, monkeypatch):
    """Pixels are tested in blocks, not as rows, and are the same whatever the blocks."""
    ring = "array<struct<x double, y double>>"
    rows = [
        (1, [(-5.0, -5.0), (30.0, 2.0), (25.0, 40.0), (3.0, 17.0)], [[(8.0, 8.0), (15.0, 9.0), (11.0, 15.0)]]),
        (2, [(2.0, 2.0), (9.0, 2.0), (9.0, 9.0)], None),
        (3, [(2.0, 2.0), (9.0, 2.0)], []),
        (4, [(50.0, 50.0), (60.0, 50.0), (60.0, 70.0)], []),
        (5, [(0.0, 0.0), (19.0, 0.0), (19.0, 11.0), (0.0, 11.0)], [[(1.0, 1.0), (2.0, 2.0)], [(5.0, 5.0), (5.0, 9.0), (9.0, 9.0), (9.0, 5.0)]]),
    ]

    def within(c, x, y):
        inside = on = False
        for (x1, y1), (x2, y2) in zip(c, c[1:] + c[:1], strict=True):
            turn = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            inside ^= (y1 > y) != (y2 > y) and (turn > 0) == (y2 > y1)
            on |= turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
        return inside or on

    want = sorted((i, x, y) for i, o, h in rows if len(o) > 2 for x in range(20) for y in range(12) if within(o, x, y) and not any(within(c, x, y) for c in h or [] if len(c) > 2))
    for size in (1 << 18, 30):
        monkeypatch.setattr(polygons, "PIXELS", size)
        got = polygons.rasterized(spark.createDataFrame(rows, f"img long, outer {ring}, holes array<{ring}>"), 20, 12)
        assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("seed", range(30))
def test_all_tolerances_at_once(seed, monkeypatch):
    """A hull is cut once for all tolerances, and each leaves the same corners as a chain that is cut for it alone."""
    rnd = np.random.default_rng(seed)
    corners = outlines.hull(rnd.integers(0, 40, (int(rnd.integers(5, 200)), 2)).astype(float))

    def alone(tolerance):
        chain = np.roll(corners, -int(np.argmax(np.hypot(*(corners - corners[0]).T))), axis=0)
        second = int(np.argmax(np.hypot(*(chain - chain[0]).T)))
        closed, stays, todo = np.concatenate((chain, chain[:1])), {0, second}, [(0, second), (second, len(chain))]
        while todo:
            lo, hi = todo.pop()
            if hi - lo > 1:
                inner, side = closed[lo + 1 : hi] - closed[lo], closed[hi] - closed[lo]
                length = np.hypot(*side)
                away = np.abs(inner[:, 0] * side[1] - inner[:, 1] * side[0]) / length if length else np.hypot(*inner.T)
                k = int(np.argmax(away))
                if away[k] > tolerance:
                    stays.add(lo + 1 + k)
                    todo += [(lo, lo + 1 + k), (lo + 1 + k, hi)]
        return chain[sorted(stays)]

    for t in np.linspace(0.0, 20.0, 41):
        assert outlines.simplified(corners, t).tolist() == alone(t).tolist()
    calls, cut = [], outlines._tolerances
    monkeypatch.setattr(outlines, "_tolerances", lambda c: calls.append(1) or cut(c))
    outlines.quad(corners)
    assert len(calls) <= 1


def test_faces_where_lines_meet(spark, monkeypatch):
    """Groups of few lines are sent once and written nowhere, and have the faces that rounds over half-edges find, whatever the blocks."""
    rnd, rows = random.Random(5), []
    for grp in (None, *range(9)):
        for x in range(8):
            for y in range(8):
                rows += [(grp, float(x), float(y), float(x + a), float(y + 1 - a)) for a in (0, 1) if rnd.random() < 0.75]
        rows += [(grp, x, y, x + 0.1 * a, y + 0.1 * b) for x, y in ((2.3, 2.3), (2.6, 2.6), (0.5, 3.5)) for a, b in ((1, 0), (0, 1))] + [(grp, x + 0.1, y, x, y + 0.1) for x, y in ((2.3, 2.3), (2.6, 2.6), (0.5, 3.5))]
        rows += [(grp, -1.0, -1.0, 9.0, -1.0), (grp, 9.0, -1.0, 9.0, 9.0), (grp, 9.0, 9.0, -1.0, 9.0), (grp, -1.0, 9.0, -1.0, -1.0), rows[-1], (grp, -1.0, -1.0, -0.5, -0.5)]
    rows += [(77, float(k), 0.0, float(k + 1), 0.0) for k in range(5)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "grp long, x1 double, y1 double, x2 double, y2 double").repartition(3)
    told = lambda got: sorted((r.grp if r.grp is not None else -1, [tuple(c) for c in r.corners], [[tuple(c) for c in h] for h in r.holes], round(r.area, 6)) for r in got.collect())
    corners = lambda got: [(g, set(c), [set(h) for h in hs], a) for g, c, hs, a in got]
    monkeypatch.setattr(planar, "GROUP", 0)
    far = told(planar.faces(df, 0.001))
    assert sum(len(h) for _, _, h, _ in far) > 20 and {g for g, *_ in far} == {-1, *range(9)}
    monkeypatch.setattr(planar, "GROUP", 150)
    assert corners(told(planar.faces(df, 0.001))) == corners(far)
    monkeypatch.setattr(planar, "GROUP", 20_000)
    monkeypatch.setattr(planar, "kept", None)
    for rows_, pairs in ((200_000, 1 << 18), (150, 10)):
        monkeypatch.setattr(planar, "ROWS", rows_)
        monkeypatch.setattr(facets, "PAIRS", pairs)
        got = planar.faces(df, 0.001)
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 2
        assert corners(told(got)) == corners(far)


def test_edges_meet_in_tasks_of_few_rows(spark, monkeypatch):
    """A larger graph has more tasks, not larger ones, whatever the session's number of partitions; with hubs and without."""
    rnd = random.Random(6)
    edges = [(rnd.randrange(400), 1000 + rnd.randrange(400)) for _ in range(500)] + [(5000 + k, 5001 + k) for k in range(60)] + [(k, 9000) for k in range(0, 400, 3)]
    of = {v: v for e in edges for v in e}
    for _ in range(100):
        for a, b in edges:
            of[a] = of[b] = min(of[a], of[b])
    df = spark.createDataFrame(edges + edges[:50], "a long, b long")
    for heavy in (10_000, 20):
        monkeypatch.setattr(graphs, "LEAST_HEAVY", heavy)
        monkeypatch.setattr(graphs, "HEAVY", 20)
        monkeypatch.setattr(graphs, "ROWS", 100)
        seen, keep = [], graphs.kept
        monkeypatch.setattr(graphs, "kept", lambda df, seen=seen, keep=keep: seen.append(keep(df)) or seen[-1])
        assert {r.node: r.label for r in graphs.graph_components(df).collect()} == of
        assert max(len(part) for part in seen[0].rdd.glom().collect()) < 250
        monkeypatch.setattr(graphs, "kept", keep)


@pytest.mark.parametrize("seed", range(5))
def test_polygons_in_batches(spark, seed, monkeypatch):
    """Roofs and points are tested many at once, as the column expressions test them one by one, whatever the blocks."""
    rnd = random.Random(seed)
    spot = lambda: (rnd.choice((float(rnd.randrange(6)), rnd.uniform(0, 6))), rnd.choice((float(rnd.randrange(6)), rnd.uniform(0, 6))))
    edges = [(b, 0, b % 2 or None, k, k, (*spot(), 0.0)) for b in range(60) for k in range(rnd.randrange(2, 8))]
    df = spark.createDataFrame(edges, "building long, component int, loop int, ring_order int, seq int, p struct<x double, y double, z double>")
    monkeypatch.setattr(polygons, "SIDES", rnd.choice((5, 1 << 18)))
    roofs = polygons.roof_polygons(df)
    assert "exists(" not in roofs._jdf.queryExecution().optimizedPlan().toString().lower()
    every = df.groupBy("building").agg(F.array_sort(F.collect_list(F.struct("ring_order", "p.x", "p.y"))).alias("c")).where("size(c) >= 3").select("building", polygons.sides(F.col("c")).alias("s"))
    want = every.where((polygons.area(F.col("s")) > 0.1) & polygons.is_simple(F.col("s"))).select("building", "s").collect()
    assert {r.building: r.sides for r in roofs.collect()} == {r.building: r.s for r in want} and 0 < len(want) < 60
    points = spark.createDataFrame([(k, k % 3, *(spot() if k else (None, 1.0))) for k in range(100)], "id long, grp long, x double, y double")
    held = roofs.select((F.col("building") % 4).alias("grp"), F.col("building").alias("polygon"), "sides")
    got = polygons.polygon_of_points(points, held)
    assert "exists(" not in (plan := got._jdf.queryExecution().optimizedPlan().toString().lower()) and "array_min" not in plan
    inside = polygons.contains(F.col("sides"), F.col("x"), F.col("y"))
    away = F.when(inside, 0.0).otherwise(polygons.distance(F.col("sides"), F.col("x"), F.col("y")))
    plain = points.join(held, "grp").groupBy("id").agg(F.min(F.struct((~inside).alias("outside"), away.alias("d"), "polygon")).alias("b")).select("id", "b.polygon", ~F.col("b.outside"), "b.d")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(map(tuple, plain.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("ref", [0, 3, 9])
def test_chains_are_running_products(spark, ref):
    """Each image's homography is one product more than its neighbour's, and the same as the product of all links between."""
    rnd = np.random.default_rng(ref)
    links, groups = [], {grp: [np.eye(3) + rnd.uniform(-0.4, 0.4, (3, 3)) for _ in range(int(rnd.integers(1, 8)))] for grp in range(20)}
    groups[3][0], groups[4] = None, [np.eye(3), np.zeros((3, 3)), np.eye(3)]
    for grp, hs in groups.items():
        links += [(grp, k, None if h is None else h.ravel().tolist()) for k, h in enumerate(hs)]
    links += [(50, 0, [1.0] * 8), (51, 0, [1.0, None] + [1.0] * 7)]
    got = fitting.chains(spark.createDataFrame(links[::-1], "grp long, k long, h array<double>"), ref)
    assert "aggregate(" not in (plan := got._jdf.queryExecution().optimizedPlan().toString()) and "slice(" not in plan
    rows = {(r.grp, r.image): r.h for r in got.collect()}
    assert len(rows) == len(links) + len(groups) + 2 and (ref > 0 or rows[50, 1] is rows[51, 1] is None)
    for grp, hs in groups.items():
        for image in range(len(hs) + 1):
            between, m = hs[min(image, ref) : max(image, ref)], np.eye(3)
            for h in between:
                m = None if m is None or h is None else h @ m if image > ref else m @ h
            if m is not None and image > ref:
                m = None if abs(np.linalg.det(m)) < 1e-12 else np.linalg.inv(m)
            assert (rows[grp, image] is None) == (m is None)
            assert m is None or np.allclose(rows[grp, image], m.ravel(), rtol=1e-6, atol=1e-9)

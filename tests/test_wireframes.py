"""A small wireframe end to end, and the rules for ties and gaps."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.config import Settings
from gablework.functions import geometry as g
from gablework.operators import cameras, fitting, graphs, panoramas, pixels, rasters, rings
from gablework.sources import geojson, sinks

#: A house of 10 m by 6 m, counter-clockwise, its eaves 3 m above a base at 100 m.
CORNERS = [(0, 0), (10, 0), (10, 6), (0, 6)]


def house(grouped=True):
    features = []
    for k, (x, y) in enumerate(CORNERS):
        group = {"component_id": 0, "loop_id": 0, "ring_order": k} if grouped else {}
        features.append({"geometry": {"type": "LineString", "coordinates": [[x, y, 100.0], [x, y, 103.0]]}, "properties": {"type": "wall", "source": k, "target": 10 + k, **group}})
    for k in range(4):
        a, b = CORNERS[k], CORNERS[(k + 1) % 4]
        features.append({"geometry": {"type": "LineString", "coordinates": [[*a, 100.0], [*b, 100.0]]}, "properties": {"type": "base", "source": k, "target": (k + 1) % 4}})
    features.append({"geometry": {"type": "Point", "coordinates": [5, 0, 101.5]}, "properties": {"type": "wall_center", "wall_index": 0}})
    features.append({"geometry": {"type": "Point", "coordinates": [5, 0, 101.5]}, "properties": {"type": "other"}})
    return json.dumps({"type": "FeatureCollection", "features": features})


@pytest.fixture(scope="module", params=[True, False])
def features(spark, tmp_path_factory, request):
    folder = tmp_path_factory.mktemp("wire")
    (folder / "building_1_3d.geojson").write_text(house(request.param))
    (folder / "note.txt").write_text("{}")
    return geojson.read_features(spark, str(folder)).cache()


def walls_of(features):
    nodes = rings.last_nodes(geojson.edge_ends(features))
    return rings.wall_geometry(rings.wall_faces(geojson.located(features, nodes, "wall")))


def test_features(features):
    assert features.count() == 9
    assert {r.building for r in features.collect()} == {"building_1"}
    nodes = rings.last_nodes(geojson.edge_ends(features)).orderBy("idx").collect()
    assert [(r.node, r.idx) for r in nodes] == [(n, i) for i, n in enumerate([0, 1, 2, 3, 10, 11, 12, 13])]


def test_walls_face_outward(features):
    rows = walls_of(features).orderBy("wall_index").collect()
    assert [(r.nx, r.ny, r.nz) for r in rows] == [(0, -1, 0), (1, 0, 0), (0, 1, 0), (-1, 0, 0)]
    assert [(r.cx, r.cy, r.cz, r.base_m) for r in rows] == [(5, 0, 101.5, 10), (10, 3, 101.5, 6), (5, 6, 101.5, 10), (0, 3, 101.5, 6)]
    sizes = rings.wall_metrics(walls_of(features)).orderBy("wall_index").collect()
    assert [(r.width_m, r.height_left_m, r.height_right_m) for r in sizes] == [(10, 3, 3), (6, 3, 3), (10, 3, 3), (6, 3, 3)]


def test_base_height_and_edges(features):
    nodes = rings.last_nodes(geojson.edge_ends(features))
    assert rings.base_height(geojson.located(features, nodes, "base")).first().base_z == 100
    edges = geojson.located(features, nodes, "base")
    assert {(r.source_idx, r.target_idx) for r in rings.indexed_edges(edges, nodes).collect()} == {(0, 1), (1, 2), (2, 3), (3, 0)}
    assert rings.indexed_edges(edges, nodes.where("node > 0")).count() == 2


def test_best_panorama_and_camera(spark, features):
    walls = walls_of(features)
    bases = walls.select("building", F.col("b1.x").alias("x1"), F.col("b1.y").alias("y1"), F.col("b2.x").alias("x2"), F.col("b2.y").alias("y2"))
    # Two in front of the first wall (a tie in lateral distance), one inside, one too far away, one on the zone's rim.
    panos = spark.createDataFrame([(1, 4.0, -9.0), (2, 6.0, -8.0), (3, 5.0, 3.0), (4, 5.0, -25.0), (5, 30.0, 3.0)], "pano_id long, x double, y double")
    zone = panoramas.in_zone(bases, panos)
    assert {r.pano_id for r in zone.collect()} == {1, 2, 3}
    best = panoramas.best_for_walls(walls, zone).orderBy("wall_index")
    assert [r.pano_id for r in best.collect()] == [2, None, None, None]
    view = cameras.views(cameras.aim(best.where("pano_id is not null").withColumn("base_z", F.lit(100.0)))).first()
    assert view.heading == pytest.approx(np.degrees(np.arctan2(-1, 8)) % 360) and view.tier in ("as_is", "re_aimed")
    grid = panoramas.search_grid(bases)
    assert grid.count() == 121 and grid.agg(F.max("x") - F.min("x")).first()[0] == pytest.approx(50)
    assert panoramas.nearest_to_grid(grid, panos).select("pano_id").distinct().count() >= 3


def test_wall_index_advances_over_walls_without_nodes(features):
    nodes = rings.last_nodes(geojson.edge_ends(features)).where("node <> 11")
    rows = rings.wall_geometry(rings.wall_faces(geojson.located(features, nodes, "wall"))).orderBy("wall_index").collect()
    assert [r.wall_index for r in rows] == [0, 1, 2, 3] and rows[1].cx is None and rows[2].cx == 5


def test_last_write_wins_and_rings(spark):
    ends = spark.createDataFrame([("b", 5, 0, 0, 1.0, 1.0, 1.0), ("b", 5, 3, 1, 2.0, 2.0, 2.0), ("b", 2, 1, 0, 0.0, 0.0, 0.0)], "building string, node long, seq int, endpoint int, x double, y double, z double")
    assert [(r.node, r.x, r.idx) for r in rings.last_nodes(ends).orderBy("idx").collect()] == [(2, 0.0, 0), (5, 2.0, 1)]
    edges = spark.createDataFrame([("b", None, None, 1, 1, 1, 2), ("b", None, None, 1, 0, 2, 3), ("b", 0, 0, 0, 2, 9, 9)], "building string, component int, loop int, ring_order int, seq int, source long, target long")
    got = rings.rings(edges).collect()
    assert len(got) == 1 and got[0].component is None and [(e.source, e.target) for e in got[0].edges] == [(2, 3), (1, 2)]


def test_angles(spark):
    one = spark.range(1)
    values = one.select(
        g.wrap_delta(F.lit(-170.0), F.lit(10.0)).alias("a"), g.bearing(F.lit(-1.0), F.lit(0.0)).alias("b"),
        g.circular_span(F.array(F.lit(350.0), F.lit(10.0))).alias("c"), F.size(g.tile_centers(F.lit(0.0), F.lit(200.0), F.lit(200.0))).alias("t"),
    ).first()
    assert (values.a, values.b, values.t) == (-180.0, 270.0, 3) and (values.c.center, values.c.span, values.c.start, values.c.end) == (0.0, 20.0, 350.0, 10.0)


def test_utm_round_trip(spark):
    rows = spark.createDataFrame([(51.0, 6.5), (48.1, 11.6), (54.9, 9.0)], "lat double, lon double")
    e, n = g.to_utm(F.col("lat"), F.col("lon"))
    at = rows.select("lat", "lon", e.alias("e"), n.alias("n"))
    back = g.from_utm(F.col("e"), F.col("n"))
    got = at.select("*", back[0].alias("lat2"), back[1].alias("lon2")).collect()
    assert all(abs(r.lat - r.lat2) < 1e-8 and abs(r.lon - r.lon2) < 1e-8 for r in got)
    assert [r.e for r in got if r.lon == 9.0] == [pytest.approx(500000, abs=1e-6)]


def test_homography(spark):
    src, dst = [(0, 0), (4, 1), (5, 6), (-1, 5)], [(10, 10), (90, 12), (100, 80), (8, 95)]
    columns = lambda q: [(F.lit(float(x)), F.lit(float(y))) for x, y in q]
    h = spark.range(1).select(*(x.alias(f"h{k}") for k, x in enumerate(g.homography(columns(src), columns(dst))))).first()
    for (x, y), (u, v) in zip(src, dst, strict=True):
        p = np.array(h).reshape(3, 3) @ [x, y, 1]
        assert np.allclose(p[:2] / p[2], (u, v))


def test_masks(spark):
    mask = spark.createDataFrame([(1, x, y) for x in range(5) for y in range(5) if (x, y) != (2, 2)] + [(1, 7, 7)], "img long, x int, y int")
    assert pixels.erode(mask, 1, 8, 8).count() == 7 and pixels.closed(mask, 1, 8, 8).where("x = 2 and y = 2").count() == 1
    labels = graphs.pixel_components(mask)
    assert sorted(r.area for r in graphs.component_areas(labels).collect()) == [1, 24] and graphs.without_small(labels, 2).count() == 24
    assert graphs.filled_holes(mask, 8, 8).count() == 64
    shifted = mask.select("img", (F.col("x") + 1).alias("x"), (F.col("y") + 1).alias("y")).where("x < 8 and y < 8")
    assert graphs.filled_holes(shifted, 8, 8).count() == 25
    empty = mask.limit(0)
    assert pixels.dilate(empty, 1, 8, 8).count() == pixels.mask_stats(empty).count() == graphs.pixel_components(empty).count() == 0


def test_equal_scores_keep_the_first(spark):
    scored = spark.createDataFrame([(1, 0, 2.0), (1, 1, 2.0), (1, 2, 1.0)], "img long, instance int, score double")
    assert pixels.best_instance(scored).first().instance == 0


def test_quad_fit_equals_bisection(spark):
    seg, wall = [(1, 1), (5, 2), (6, 6), (0, 5)], [(0, 0), (40, 4), (44, 30), (-2, 28)]
    kind = "id long, seg array<struct<x:double,y:double>>, wall array<struct<x:double,y:double>>"
    row = [(1, [tuple(map(float, p)) for p in seg], [tuple(map(float, p)) for p in wall])]
    got = fitting.fit_quads(spark.createDataFrame(row, kind)).first()
    s, w = np.array(seg, float), np.array(wall, float)
    center = w.mean(axis=0)

    def inside(q):
        for a, b in zip(w, np.roll(w, -1, axis=0), strict=True):
            n = np.array([-(b - a)[1], (b - a)[0]])
            n = n * np.sign(n @ (center - a)) / np.linalg.norm(n)
            if ((q - a) @ n).min() < 0.25:
                return False
        return True

    size, best = w.max(axis=0) - w.min(axis=0), 0.0
    for i in range(21):
        for j in range(21):
            c = center + 0.2 * size * (2 * np.array([i, j]) / 20 - 1)
            lo, hi = 0.0, 12.0
            for _ in range(60):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if inside((s - s.mean(axis=0)) * mid + c) else (lo, mid)
            best = max(best, lo)
    assert got.scale == pytest.approx(best, abs=1e-6)


def test_rasters(spark):
    image = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    df = spark.createDataFrame([(1, 4, 4, 3, bytearray(image.tobytes()), [1.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0], 4, 4)], rasters.IMAGE + ", h array<double>, to_width int, to_height int")
    out = rasters.pixels(rasters.warp(df).first())
    assert (out[:, 1:] == image[:, :-1]).all() and (out[:, 0] == 0).all()
    assert rasters.instances(df, rasters.bright_segments).count() == 16
    rgba = np.zeros((2, 2, 4), np.uint8)
    rgba[0] = [10, 20, 30, 255]
    filled = rasters.modelled(spark.createDataFrame([(1, 2, 2, 4, bytearray(rgba.tobytes()))], rasters.IMAGE), rasters.flat_inpainter).first()
    assert (rasters.pixels(filled) == [10, 20, 30, 255]).all()


def test_glb(features):
    blob = sinks.wall_meshes(walls_of(features)).first().glb
    magic, version, size = struct.unpack_from("<4sII", blob)
    assert (bytes(magic), version, size) == (b"glTF", 2, len(blob)) and sinks.glb([]) == b""


def test_settings():
    s = Settings().overridden({"GRID_N": 4, "grid_n": 5, "UNKNOWN": 1})
    assert s.grid_n == 4 and s.tile_fov_deg == 90.0


def test_stream_over_folder(spark, tmp_path):
    from gablework.streaming.folder import watch

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a_3d.geojson").write_text(house())
    seen = []
    watch(spark, str(tmp_path / "in"), lambda df, _: seen.append(df.count()), str(tmp_path / "state")).awaitTermination()
    assert sum(seen) == 10

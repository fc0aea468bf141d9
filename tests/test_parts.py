"""Readers, writers and small geometry against plain versions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.functions import geometry as g
from gablework.operators import fitting, pixels
from gablework.sources import geojson, sinks


def lits(*values):
    return [F.lit(float(v)) for v in values]


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(columns))).first())


def test_overlap_ratio(spark):
    line = spark.createDataFrame([(1, x, 0) for x in range(4)] + [(1, 0, 0), (2, 5, 5)], "img long, x long, y long")
    edges = spark.createDataFrame([(1, 0, 0), (1, 3, 0), (1, 3, 0), (2, 5, 6)], "img long, x long, y long")
    assert {r.img: r.ratio for r in pixels.overlap_ratio(line, edges).collect()} == {1: 0.5, 2: 0.0}
    assert pixels.overlap_ratio(line.limit(0), edges).count() == 0


def test_corners_in_order(spark):
    corners = [(1.0, 2.0), (9.0, 1.0), (11.0, 8.0), (0.0, 7.0)]
    rng = np.random.default_rng(3)
    rows = [(k, [corners[i] for i in rng.permutation(4)]) for k in range(12)]
    df = spark.createDataFrame(rows, "id int, points array<struct<x:double,y:double>>")
    for r in df.select(fitting.clockwise(F.col("points")).alias("p")).collect():
        assert [tuple(p) for p in r.p] == corners


def test_piecewise_maps_and_their_inverses(spark):
    top, to = lits(0, 30, 100, 40), lits(0, 50, 100, 50)
    # At x = 50 the line stands at 35: above it 35 pixels become 50, below it 64 become 49.
    mapped = one(spark, *(g.vertical_map(F.lit(y), F.lit(50.0), top, to, 100) for y in (0.0, 17.5, 35.0, 67.0, 99.0)))
    assert mapped == pytest.approx((0, 25, 50, 74.5, 99))
    sides = (lits(40, 0, 45, 50), lits(70, 0, 60, 50)), (lits(30, 0, 30, 50), lits(80, 0, 80, 50))
    for x in (3.0, 41.0, 55.5, 66.0, 110.0):
        there = g.horizontal_map(F.lit(x), F.lit(20.0), *sides[0], *sides[1], 120)
        assert one(spark, g.horizontal_map(there, F.lit(20.0), *sides[1], *sides[0], 120)) == pytest.approx((x,))
    # An upright line has one x; a level one, its middle.
    assert one(spark, g.x_at_y(lits(5, 0, 5, 9), F.lit(4.0)), g.x_at_y(lits(2, 3, 8, 3), F.lit(3.0)), g.y_at_x(lits(0, 1, 10, 21), F.lit(5.0))) == (5.0, 5.0, 11.0)


def test_raster_transform_round_trip(spark):
    m = (0.5, 0.1, 1000.0, -0.2, -0.6, 5000.0)
    x, y = g.affine(m, F.lit(37.0), F.lit(81.0))
    assert one(spark, x, y) == pytest.approx((0.5 * 37 + 0.1 * 81 + 1000, -0.2 * 37 - 0.6 * 81 + 5000))
    assert one(spark, *g.world_to_pixel(lits(*m), x, y)) == pytest.approx((37, 81))


def test_distance_to_a_line(spark):
    at = lambda *p: tuple(lits(*p))
    assert one(spark, g.point_line_distance(at(3, 4), at(0, 0), at(10, 0)), g.point_line_distance(at(0, 5), at(-5, 0), at(0, -5))) == pytest.approx((4, 50**0.5))


def test_rasters_by_building(spark, tmp_path):
    for name in ("a.tif", "a.tiff", "b.TIFF", "c.png"):
        (tmp_path / name).write_bytes(name.encode())
    found = geojson.read_rasters(spark, str(tmp_path))
    assert sorted((r.building, r.ext, bytes(r.content)) for r in found.collect()) == [("a", "tif", b"a.tif"), ("a", "tiff", b"a.tiff"), ("b", "tiff", b"b.TIFF")]
    buildings = spark.createDataFrame([("a",), ("b",), ("c",)], "building string")
    best = {r.building: r.raster and r.raster.rsplit("/", 1)[1] for r in geojson.with_rasters(buildings, found).collect()}
    assert best == {"a": "a.tif", "b": "b.TIFF", "c": None}


def test_panorama_bodies(spark, tmp_path):
    body = lambda status, name: json.dumps({"status": status, "pano_id": name, "location": {"lat": 52.5, "lng": 13.25}})
    (tmp_path / "panos.json").write_text("\n".join([body("OK", "p"), body("ZERO_RESULTS", "q"), "{broken", "", body("OK", "r")]))
    got = geojson.read_panoramas(spark, str(tmp_path / "panos.json"))
    assert sorted(tuple(r) for r in got.collect()) == [("p", 52.5, 13.25), ("r", 52.5, 13.25)]


def test_written_tables_and_documents(spark, tmp_path):
    table = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    sinks.write_viewer_tables({"walls": table, "empty": table.limit(0)}, str(tmp_path / "viewer"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "viewer/walls")).collect()) == [(1, "x"), (2, None)]
    assert spark.read.parquet(str(tmp_path / "viewer/empty")).columns == ["id", "name"]
    documents = spark.createDataFrame([("a", '{"n": 1}'), ("b", '{"n": 2}')], "building string, document string")
    sinks.write_documents(documents, str(tmp_path / "docs"))
    assert {(r.building, json.loads(r.value)["n"]) for r in spark.read.text(str(tmp_path / "docs")).collect()} == {("a", 1), ("b", 2)}

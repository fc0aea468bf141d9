"""Polygons, masks and documents against plain versions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.config import Settings
from gablework.operators import cameras, documents, pixels, polygons
from gablework.plans import registry

DATA = "/root/testdata/sf0.001"


def masks(spark, count, size, seed=1):
    made = np.random.default_rng(seed).random((count, size, size)) < 0.6
    return made, spark.createDataFrame([(i, int(x), int(y)) for i in range(count) for y, x in zip(*np.nonzero(made[i]))], "img long, x long, y long")


def around(mask, radius, grow):
    out = np.zeros_like(mask)
    for y in range(len(mask)):
        for x in range(len(mask)):
            half = lambda dy: round((radius * radius - dy * dy) ** 0.5)
            near = [mask[y + dy, x + dx] for dy in range(-radius, radius + 1) for dx in range(-half(dy), half(dy) + 1) if 0 <= y + dy < len(mask) and 0 <= x + dx < len(mask)]
            out[y, x] = any(near) if grow else all(near)
    return out


def filled(mask):
    outer, queue = set(), [] if mask[0, 0] else [(0, 0)]
    while queue:
        y, x = queue.pop()
        if (y, x) in outer or not (0 <= y < len(mask) and 0 <= x < len(mask)) or mask[y, x]:
            continue
        outer.add((y, x))
        queue += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return {(x, y) for y in range(len(mask)) for x in range(len(mask)) if (y, x) not in outer}


def test_cleaned(spark):
    made, df = masks(spark, 4, 14)
    s = Settings(mask_close_px=1, mask_open_px=2, min_component_px=1)
    got = {}
    for r in pixels.cleaned(df, 14, 14, s).collect():
        got.setdefault(r.img, set()).add((r.x, r.y))
    for i, m in enumerate(made):
        m = around(around(m, 1, True), 1, False)
        m = around(around(m, 2, False), 2, True)
        assert not m.any() and i not in got or got.get(i) == filled(m)


def test_cleaned_empty(spark):
    assert pixels.cleaned(spark.createDataFrame([], "img long, x long, y long"), 8, 8).count() == 0


@pytest.mark.parametrize("point, inside", [((1.0, 1.0), True), ((3.0, 3.0), False), ((1.0, 3.0), True), ((5.0, 1.0), False), ((-1.0, 3.0), False)])
def test_contains_concave(spark, point, inside):
    corners = "array(" + ",".join(f"struct({x}D as x, {y}D as y)" for x, y in ((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4))) + ")"
    row = spark.range(1).select(polygons.sides(F.expr(corners)).alias("s")).select(polygons.contains(F.col("s"), *map(F.lit, point)).alias("c"), polygons.area(F.col("s")).alias("a"), polygons.is_simple(F.col("s")).alias("k")).first()
    assert (row.c, row.a, row.k) == (inside, 12.0, True)


def test_crossed_ring_is_not_simple(spark):
    corners = "array(" + ",".join(f"struct({x}D as x, {y}D as y)" for x, y in ((0, 0), (4, 4), (4, 0), (0, 4))) + ")"
    assert not spark.range(1).select(polygons.is_simple(polygons.sides(F.expr(corners)))).first()[0]


def test_full_masks_weigh_one(spark):
    full = spark.createDataFrame([(1, x, y) for x in range(4) for y in range(4)], "img long, x long, y long")
    assert {r.w for r in pixels.distance_weights(full, 4, 4).collect()} == {1.0}


def test_documents(spark):
    seen = cameras.views(registry._aimed(spark, DATA))
    docs = [json.loads(r.document) for r in documents.wall_documents(seen).limit(200).collect()]
    assert docs
    for doc in docs:
        chain = doc["rectification"]["homography_chain"]
        h = np.array(chain["H_pix_to_ortho_px"], dtype=float)
        ppm, box = doc["rectification"]["pixels_per_meter"], doc["rectification"]["bounds_m"]
        if np.isnan(h).any():
            continue
        for (u, v), (x, y) in zip(doc["cropped_image"]["uv_quad_px_raw"], doc["wall_geometry"]["metric_target"]["dst_wall_m"], strict=True):
            at = h @ np.array([u, v, 1.0])
            want = (x - box["xmin"]) * ppm, ((box["ymax"] - y) if doc["rectification"]["flip_vertical"] else (y - box["ymin"])) * ppm
            assert np.allclose(at[:2] / at[2], want, atol=1e-3)
        assert doc["post_rectification_quad_fit"]["fit_info"] is None and doc["wall_identity"]["global_index"] >= 0


def test_fits_and_switches(spark):
    seen = cameras.views(registry._aimed(spark, DATA)).limit(20).checkpoint()
    fits = seen.select("building", "wall_index", F.struct(F.lit(1.5).alias("scale")).alias("fit"))
    on = [json.loads(r.document) for r in documents.wall_documents(seen, fits).collect()]
    off = [json.loads(r.document) for r in documents.wall_documents(seen, fits, s=Settings(enable_quad_fit=False)).collect()]
    assert {d["post_rectification_quad_fit"]["fit_info"]["scale"] for d in on} == {1.5}
    assert {d["post_rectification_quad_fit"]["fit_info"] for d in off} == {None} and not off[0]["post_rectification_quad_fit"]["enabled"]


def test_viewer_indexes(spark):
    rows = documents.viewer_rows(cameras.views(registry._aimed(spark, DATA)))
    index = documents.viewer_indexes(rows)
    listed = [json.loads(r.viewer_index) for r in index.collect()]
    assert sum(map(len, listed)) == rows.count()
    assert all([w["global_index"] for w in one] == sorted(w["global_index"] for w in one) for one in listed)

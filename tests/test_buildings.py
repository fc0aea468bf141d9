"""From a building's edges to its walls' documents, degenerate walls among them."""

import json

from pyspark.sql import functions as F

from gablework.functions import geometry as g
from gablework.functions import naming
from gablework.operators import documents

EDGES = """building long, component int, loop int, ring_order long, seq int, type string, source long, target long,
p struct<x:double,y:double,z:double>, q struct<x:double,y:double,z:double>"""
PLACES = [(0, 0), (10, 0), (10, 0), (10, 8), (0, 8)]


def test_a_building_with_degenerate_walls(spark):
    """A repeated corner, a wall that is a triangle, and panoramas on a corner: every wall has a state, and those with a view a document."""
    rows = [(1, 0, 0, k, k, "wall" if k else "base", k, 10 + k, (float(x), float(y), 0.0), (float(x), float(y), 0.0 if k == 4 else 3.0)) for k, (x, y) in enumerate(PLACES)]
    panos = spark.createDataFrame([(1, 5.0, -6.0), (2, 16.0, 4.0), (3, 0.0, 0.0), (4, 10.0, 0.0)], "pano_id long, x double, y double")
    states = documents.building_states(spark.createDataFrame(rows, EDGES), panos)
    got = {r.wall_index: (r.status, r.pano_id) for r in states.select("wall_index", "status", "pano_id").collect()}
    assert set(got) == set(range(5)) and got[1] == ("no_panorama_for_wall", None)
    assert got[0][0] == got[2][0] == "ready"
    made = documents.wall_documents(states)
    found = {r.wall_index: json.loads(r.document) for r in made.collect()}
    assert set(found) == {k for k, (s, _) in got.items() if s == "ready"}
    for d in found.values():
        chain = d["rectification"]["homography_chain"]
        flat = [v for row in chain["H_pix_to_wall_m"] for v in row]
        assert all(v is None for v in flat) or all(isinstance(v, float) for v in flat)
        assert d["wall_geometry"]["metric_target"]["width_m"] >= 0
    # A value stands once in the plan, so that it stays small however many steps use it.
    assert len(made._jdf.queryExecution().optimizedPlan().toString()) < 500_000


def test_degenerate_values_are_null(spark):
    lit = lambda *p: [(F.lit(float(x)), F.lit(float(y))) for x, y in p]
    flat, square = lit((0, 0), (1, 1), (2, 2), (3, 3)), lit((0, 0), (4, 0), (5, 6), (-1, 5))
    for src, dst in ((flat, square), (square, flat)):
        assert set(spark.range(1).select(*(x.alias(f"h{k}") for k, x in enumerate(g.homography(src, dst)))).first()) <= {None, 1.0, 0.0}
    u, v = g.apply_homography([1, 0, 0, 0, 1, 0, 1, 0, 0], F.lit(0.0), F.lit(5.0))
    c, r = g.world_to_pixel([F.lit(0.0)] * 6, F.lit(1.0), F.lit(1.0))
    assert tuple(spark.range(1).select(u, v, c, r).first()) == (None,) * 4


def test_the_band_beside_a_quad(spark):
    """The left and right side of a square, moved outward, over the image's height; a level side has no place in a row."""
    point = lambda x, y: (F.lit(float(x)), F.lit(float(y)))
    band = g.side_band(point(100, 200), point(300, 200), point(300, 50), point(100, 50), 640, 480, 20)
    flat = [c.alias(f"v{k}") for k, c in enumerate(x for p in band for x in p)]
    assert [round(v, 6) for v in spark.range(1).select(*flat).first()] == [80, 0, 320, 0, 320, 480, 80, 480]
    slanted = g.side_band(point(100, 300), point(300, 300), point(300, 100), point(150, 100), 640, 480, 20)
    x0, x3 = spark.range(1).select(slanted[0][0].alias("a"), slanted[3][0].alias("b")).first()
    # The side x = 100 + (300 - y) / 4 moves by 20 square to itself.
    shift = 20 * (1 + 1 / 16) ** 0.5
    assert abs(x0 - (175 - shift)) < 1e-6 and abs(x3 - (55 - shift)) < 1e-6


def test_keys_are_masked(spark):
    urls = spark.createDataFrame([("https://x/y?a=1&key=abc123&b=2",), ("https://x/y?key=abc",), ("https://x/y",), (None,)], "url string")
    got = [r[0] for r in urls.select(naming.mask_key(F.col("url"))).collect()]
    assert "abc" not in "".join(x or "" for x in got) and got[2] == "https://x/y" and got[3] is None and got[0].endswith("&b=2")

"""The registered queries: an operator each, over whole test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gablework.functions import geometry as g
from gablework.functions import naming
from gablework.operators import cameras, documents, fitting, graphs, panoramas, pixels, rings
from gablework.plans import tables as t

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _round(df: DataFrame, *names: str, digits: int = 5) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) + F.lit(0.0) for n in names})


def _walls(s: SparkSession, d: str) -> DataFrame:
    return rings.wall_geometry(rings.wall_faces(t.edges(s, d)))


def _ends(s: SparkSession, d: str) -> DataFrame:
    e = t.edges(s, d)
    return e.select("building", F.col("source").alias("node"), "seq", F.lit(0).alias("endpoint"), "p.*").union(e.select("building", "target", "seq", F.lit(1), "q.*"))


# Rings, nodes, walls


@query("WITH" + t.EDGES_SQL + """,
ends AS (SELECT building, source AS node, seq, 0 AS endpoint, x, y, zlo AS z FROM edges UNION ALL SELECT building, target, seq, 1, x, y, zhi FROM edges),
last AS (SELECT building, node, arg_max((x, y, z), (seq, endpoint)) AS p FROM ends GROUP BY ALL)
SELECT building, node, round(p[1], 9) + 0e0 AS x, round(p[2], 9) + 0e0 AS y, round(p[3], 9) + 0e0 AS z, (row_number() OVER (PARTITION BY building ORDER BY node) - 1)::INTEGER AS idx FROM last""")
def ring_nodes_last_wins(s, d):
    return _round(rings.last_nodes(_ends(s, d)), "x", "y", "z", digits=9)


@query("WITH" + t.EDGES_SQL + " SELECT building, component, loop, count(*) AS n_edges FROM edges GROUP BY ALL HAVING count(*) >= 2")
def ring_groups(s, d):
    return rings.ring_sizes(t.edges(s, d))


@query("WITH" + t.EDGES_SQL + """
SELECT building, string_agg(source || '-' || target, ' ' ORDER BY ring_order, seq) AS path FROM edges GROUP BY building HAVING count(*) >= 2""")
def ring_edge_order(s, d):
    path = F.array_join(F.transform("edges", lambda e: F.concat_ws("-", e["source"], e["target"])), " ")
    return rings.rings(t.edges(s, d)).select("building", path.alias("path"))


@query("WITH" + t.WALLS_SQL + """
SELECT building, wall_index::INTEGER AS wall_index, round(base_m, 9) + 0e0 AS base_m, round(nx, 9) + 0e0 AS nx, round(ny, 9) + 0e0 AS ny, round(cx, 9) + 0e0 AS cx, round(cy, 9) + 0e0 AS cy, round(cz, 9) + 0e0 AS cz FROM faced""")
def wall_faces(s, d):
    return _round(_walls(s, d).select("building", "wall_index", "base_m", "nx", "ny", "cx", "cy", "cz"), "base_m", "nx", "ny", "cx", "cy", "cz", digits=9)


@query("WITH" + t.EDGES_SQL + """
SELECT building, seq::INTEGER AS seq, (row_number() OVER (PARTITION BY building ORDER BY component NULLS LAST, loop NULLS LAST, ring_order NULLS LAST, seq) - 1)::INTEGER AS wall_index,
       (row_number() OVER (PARTITION BY building, loop ORDER BY ring_order NULLS LAST, seq) - 1)::INTEGER AS loop_index
FROM (SELECT *, count(*) OVER (PARTITION BY building, loop) AS n FROM edges) WHERE n >= 2""")
def wall_global_index(s, d):
    return rings.wall_faces(t.edges(s, d)).select("building", "seq", "wall_index", "loop_index")


@query("WITH" + t.WALLS_SQL + """,
dirs AS (
  SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) + (zhi2 - zhi1) * (zhi2 - zhi1)) AS roof_m,
         ((zhi1 - zlo1) + (zhi2 - zlo2)) * 0.5e0 AS rise FROM walls),
axes AS (
  SELECT *, (x2 - x1) / roof_m AS ux, (y2 - y1) / roof_m AS uy, (zhi2 - zhi1) / roof_m AS uz FROM dirs WHERE roof_m > 1e-9),
up AS (
  SELECT *, -rise * uz * ux AS vx0, -rise * uz * uy AS vy0, rise - rise * uz * uz AS vz0 FROM axes),
unit AS (
  SELECT *, vx0 / sqrt(vx0 * vx0 + vy0 * vy0 + vz0 * vz0) AS vx, vy0 / sqrt(vx0 * vx0 + vy0 * vy0 + vz0 * vz0) AS vy, vz0 / sqrt(vx0 * vx0 + vy0 * vy0 + vz0 * vz0) AS vz
  FROM up WHERE sqrt(vx0 * vx0 + vy0 * vy0 + vz0 * vz0) > 1e-9)
SELECT building, wall_index::INTEGER AS wall_index, round(roof_m, 5) + 0e0 AS width_m, round((zhi1 - zlo1) * vz, 5) + 0e0 AS height_left_m, round((zhi2 - zlo2) * vz, 5) + 0e0 AS height_right_m FROM unit""")
def wall_metrics(s, d):
    w = rings.wall_faces(t.edges(s, d))
    flat = g.norm(g.minus(rings.point("t2"), rings.point("t1"))) > 1e-9
    return _round(rings.wall_metrics(w.where(flat)).select("building", "wall_index", "width_m", "height_left_m", "height_right_m"), "width_m", "height_left_m", "height_right_m")


@query("WITH" + t.EDGES_SQL + """
SELECT building, round(coalesce(avg(z) FILTER (WHERE type = 'base'), 0e0), 5) + 0e0 AS base_z
FROM (SELECT building, type, zlo AS z FROM edges UNION ALL SELECT building, type, zhi FROM edges) GROUP BY building""")
def base_height(s, d):
    return _round(rings.base_height(t.edges(s, d)), "base_z")


@query("WITH" + t.WALLS_SQL + """
SELECT building, round(abs(sum((x1 - building % 1000 * 100e0) * (y2 - floor(building / 1000e0) * 100e0) - (x2 - building % 1000 * 100e0) * (y1 - floor(building / 1000e0) * 100e0))) / 2e0, 5) + 0e0 AS area
FROM (SELECT building, x AS x1, y AS y1, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM edges WINDOW w AS (PARTITION BY building ORDER BY seq)) GROUP BY building""")
def polygon_area_shoelace(s, d):
    local = t.edges(s, d).select("building", "seq", (F.col("p.x") - (F.col("building") % 1000) * F.lit(100.0)).alias("x"), (F.col("p.y") - F.floor(F.col("building") / 1000) * F.lit(100.0)).alias("y"))
    return _round(rings.shoelace(local), "area")


@query("WITH" + t.EDGES_SQL + """,
nodes AS (SELECT building, source AS node, dense_rank() OVER (PARTITION BY building ORDER BY source) - 1 AS idx FROM (SELECT DISTINCT building, source FROM edges))
SELECT e.building, e.seq::INTEGER AS seq, a.idx::INTEGER AS source_idx, b.idx::INTEGER AS target_idx FROM edges e JOIN nodes a ON a.building = e.building AND a.node = e.source JOIN nodes b ON b.building = e.building AND b.node = e.target""")
def edges_to_idx(s, d):
    """Nodes are known where an edge begins; edges to other nodes go."""
    e = t.edges(s, d)
    return rings.indexed_edges(e, rings.last_nodes(_ends(s, d).where("endpoint = 0")))


# Panoramas and cameras


@query("WITH" + t.WALLS_SQL + """,
box AS (SELECT building, min(least(x1, x2)) - 20 AS x0, max(greatest(x1, x2)) + 20 AS xn, min(least(y1, y2)) - 20 AS y0, max(greatest(y1, y2)) + 20 AS yn FROM walls GROUP BY building),
square AS (SELECT *, greatest(xn - x0, yn - y0) AS side FROM box)
SELECT building, i::INTEGER AS i, j::INTEGER AS j, round((x0 + xn) * 0.5e0 - side * 0.5e0 + i * (side / 10e0), 9) + 0e0 AS x, round((y0 + yn) * 0.5e0 - side * 0.5e0 + j * (side / 10e0), 9) + 0e0 AS y,
       floor(greatest(30e0, 1.2e0 * (side / 10e0)))::INTEGER AS radius
FROM square, range(0, 11) a(i), range(0, 11) b(j)""")
def search_grid(s, d):
    return _round(panoramas.search_grid(t.bases(_walls(s, d))), "x", "y", digits=9)


@query("WITH" + t.WALLS_SQL + "," + t.ZONE_SQL + " SELECT building, pano_id FROM zone")
def pano_zone(s, d):
    return panoramas.in_zone(t.bases(_walls(s, d)), t.panos(s, d)).select("building", "pano_id")


@query("WITH" + t.WALLS_SQL + "," + t.ZONE_SQL + """,
box AS (SELECT building, min(least(x1, x2)) - 20 AS x0, max(greatest(x1, x2)) + 20 AS xn, min(least(y1, y2)) - 20 AS y0, max(greatest(y1, y2)) + 20 AS yn FROM walls GROUP BY building),
square AS (SELECT *, greatest(xn - x0, yn - y0) AS side FROM box),
grid AS (
  SELECT building, i, j, (x0 + xn) * 0.5e0 - side * 0.5e0 + i * (side / 10e0) AS gx, (y0 + yn) * 0.5e0 - side * 0.5e0 + j * (side / 10e0) AS gy, floor(greatest(30e0, 1.2e0 * (side / 10e0))) AS radius
  FROM square, range(0, 11) a(i), range(0, 11) b(j)),
spots AS (SELECT pano_id, x AS sx, y AS sy, floor(x / 100e0) + a.k AS cx, floor(y / 100e0) + b.k AS cy FROM panos, range(-1, 2) a(k), range(-1, 2) b(k)),
found AS (
  SELECT building, i, j, arg_min(pano_id, (sqrt((sx - gx) * (sx - gx) + (sy - gy) * (sy - gy)), pano_id)) AS pano_id FROM grid JOIN spots ON cx = floor(gx / 100e0) AND cy = floor(gy / 100e0)
  WHERE sqrt((sx - gx) * (sx - gx) + (sy - gy) * (sy - gy)) <= radius GROUP BY building, i, j)
SELECT DISTINCT f.building, f.pano_id FROM found f JOIN zone z ON z.building = f.building AND z.pano_id = f.pano_id""")
def pano_discovery(s, d):
    """What a grid search around each building finds, as one path from base lines to panoramas."""
    return panoramas.discovered(t.bases(_walls(s, d)), t.panos(s, d)).select("building", "pano_id")


@query("""
SELECT building, i, j, pano_id, place FROM (
  SELECT *, row_number() OVER (PARTITION BY building, lat, lng ORDER BY i, j, pano_id) AS k FROM (
    SELECT user_id AS building, minute(ts) AS i, second(ts) AS j, event_id AS pano_id, round(floor(value) / 10e0, 6) AS lat, round(length(event_type) / 7e0, 6) AS lng, event_type AS place FROM events)) WHERE k = 1""")
def pano_first_by_place(s, d):
    e = t.read(s, d, "events").select(F.col("user_id").alias("building"), F.minute("ts").cast("long").alias("i"), F.second("ts").cast("long").alias("j"), F.col("event_id").alias("pano_id"), (F.floor("value") / F.lit(10.0)).alias("lat"), (F.length("event_type") / F.lit(7.0)).alias("lng"), F.col("event_type").alias("place"))
    # Ties of one grid point go to the lesser id.
    e = e.withColumn("j", F.col("j") * F.lit(1 << 40) + F.col("pano_id"))
    return panoramas.first_by_place(e).select("building", "i", (F.floor(F.col("j") / F.lit(1 << 40))).alias("j"), "pano_id", "place")


_BEST_SQL = "WITH" + t.WALLS_SQL + "," + t.ZONE_SQL + """,
fronts AS (
  SELECT f.*, CASE WHEN base_m >= 1e-9 THEN (x2 - x1) / base_m END AS dx, CASE WHEN base_m >= 1e-9 THEN (y2 - y1) / base_m END AS dy,
         CASE WHEN sqrt(nx * nx + ny * ny) > 1e-9::DOUBLE THEN nx / sqrt(nx * nx + ny * ny) ELSE 0 END AS fx, CASE WHEN sqrt(nx * nx + ny * ny) > 1e-9::DOUBLE THEN ny / sqrt(nx * nx + ny * ny) ELSE 0 END AS fy FROM faced f),
met AS (
  SELECT w.building, w.wall_index, z.pano_id, z.px, z.py, w.base_m, (z.px - (x1 + x2) * 0.5e0) * w.dx + (z.py - (y1 + y2) * 0.5e0) * w.dy AS along, (z.px - (x1 + x2) * 0.5e0) * fx + (z.py - (y1 + y2) * 0.5e0) * fy AS forward,
         sqrt((z.px - (x1 + x2) * 0.5e0) * (z.px - (x1 + x2) * 0.5e0) + (z.py - (y1 + y2) * 0.5e0) * (z.py - (y1 + y2) * 0.5e0)) AS dist
  FROM fronts w JOIN zone z ON w.building = z.building WHERE base_m >= 1e-9),
best AS (
  SELECT building, wall_index, arg_min((pano_id, abs(along), forward, dist, px, py), (abs(along), forward, dist, pano_id)) AS b
  FROM met WHERE abs(along) <= base_m / 2e0 AND forward BETWEEN 0 AND 1000 GROUP BY ALL)"""


@query(_BEST_SQL + """
SELECT w.building, w.wall_index::INTEGER AS wall_index, b[1] AS pano_id, round(b[2], 5) + 0e0 AS lateral, round(b[3], 5) + 0e0 AS forward, round(b[4], 5) + 0e0 AS dist
FROM faced w LEFT JOIN best ON w.building = best.building AND w.wall_index = best.wall_index""")
def wall_best_pano(s, d):
    return _round(_best(s, d).select("building", "wall_index", "pano_id", "lateral", "forward", "dist"), "lateral", "forward", "dist")


def _best(s, d):
    w = _walls(s, d)
    return panoramas.best_for_walls(w, panoramas.in_zone(t.bases(w), t.panos(s, d)))


_AIM_SQL = _BEST_SQL + """,
base AS (SELECT building, coalesce(avg(z) FILTER (WHERE type = 'base'), 0e0) AS base_z FROM (SELECT building, type, zlo AS z FROM edges UNION ALL SELECT building, type, zhi FROM edges) GROUP BY building),
cams AS (
  SELECT w.*, b[5] AS px, b[6] AS py, base_z + 2.5e0 AS pz FROM faced w JOIN best ON w.building = best.building AND w.wall_index = best.wall_index JOIN base ON base.building = w.building),
aims AS (
  SELECT *, degrees(atan2(cx - px, cy - py)) + 360e0 - 360e0 * floor((degrees(atan2(cx - px, cy - py)) + 360e0) / 360e0) AS heading,
         degrees(atan2(cz - pz, sqrt((cx - px) * (cx - px) + (cy - py) * (cy - py)))) AS pitch,
         degrees(atan2(x1 - px, y1 - py)) + 360e0 - 360e0 * floor((degrees(atan2(x1 - px, y1 - py)) + 360e0) / 360e0) AS az1,
         degrees(atan2(x2 - px, y2 - py)) + 360e0 - 360e0 * floor((degrees(atan2(x2 - px, y2 - py)) + 360e0) / 360e0) AS az2,
         greatest(abs(((x1 + x2) * 0.5e0 - px) * nx + ((y1 + y2) * 0.5e0 - py) * ny), 0.5e0) AS ahead FROM cams),
fovs AS (
  SELECT *, least(greatest(2e0 * (greatest(abs(az1 - heading + 180e0 - 360e0 * floor((az1 - heading + 180e0) / 360e0) - 180e0), abs(az2 - heading + 180e0 - 360e0 * floor((az2 - heading + 180e0) / 360e0) - 180e0)) + degrees(atan2(3e0, ahead)) + 2e0), 15e0), 120e0) AS fov FROM aims)"""


def _aimed(s, d):
    e = t.edges(s, d)
    return cameras.aim(_best(s, d).where("pano_id is not null").join(rings.base_height(e), "building"))


@query(_AIM_SQL + " SELECT building, wall_index::INTEGER AS wall_index, round(heading, 5) + 0e0 AS heading, round(pitch, 5) + 0e0 AS pitch, round(fov, 5) + 0e0 AS fov FROM fovs")
def camera_pose(s, d):
    return _round(_aimed(s, d).select("building", "wall_index", "heading", "pitch", "fov"), "heading", "pitch", "fov")


_corner = lambda n, x, y, z: f"""(SELECT building, wall_index, '{n}' AS corner, {x} AS x, {y} AS y, {z} AS z, heading, pitch, fov, px, py, pz FROM fovs)"""
_VIEW_SQL = _AIM_SQL + ",\nposed AS (" + " UNION ALL ".join(_corner(*c) for c in (("b1", "x1", "y1", "zlo1"), ("b2", "x2", "y2", "zlo2"), ("t2", "x2", "y2", "zhi2"), ("t1", "x1", "y1", "zhi1"))) + """),
axes AS (SELECT *, sin(radians(heading)) * cos(radians(pitch)) AS f1, cos(radians(heading)) * cos(radians(pitch)) AS f2, sin(radians(pitch)) AS f3 FROM posed),
right_ AS (SELECT *, f2 / sqrt(f1 * f1 + f2 * f2) AS r1, -f1 / sqrt(f1 * f1 + f2 * f2) AS r2 FROM axes),
up_ AS (SELECT *, r2 * f3 AS u1, -r1 * f3 AS u2, r1 * f2 - r2 * f1 AS u3 FROM right_),
seen AS (
  SELECT *, (x - px) * r1 + (y - py) * r2 AS sx, (x - px) * u1 + (y - py) * u2 + (z - pz) * u3 AS sy, (x - px) * f1 + (y - py) * f2 + (z - pz) * f3 AS sz,
         degrees(atan2(x - px, y - py)) + 360e0 - 360e0 * floor((degrees(atan2(x - px, y - py)) + 360e0) / 360e0) AS yaw, degrees(atan2(z - pz, greatest(sqrt((x - px) * (x - px) + (y - py) * (y - py)), 1e-9::DOUBLE))) AS tilt FROM up_),
uv AS (SELECT *, 320e0 / tan(radians(fov) / 2e0) * (sx / sz) + 320e0 AS u, 320e0 / tan(radians(fov) / 2e0) * (-sy / sz) + 320e0 AS v FROM seen)"""


@query(_VIEW_SQL + """,
gaps AS (SELECT building, wall_index, yaw, coalesce(lead(yaw) OVER w, first_value(yaw) OVER w + 360e0) - yaw AS gap FROM uv WINDOW w AS (PARTITION BY building, wall_index ORDER BY yaw)),
spans AS (SELECT building, wall_index, 360e0 - max(gap) AS span FROM gaps GROUP BY ALL),
walls_ AS (SELECT building, wall_index, bool_and(u BETWEEN 20 AND 620 AND v BETWEEN 20 AND 620) AS fits, max(tilt) - min(tilt) AS tilt FROM uv GROUP BY ALL)
SELECT building, wall_index::INTEGER AS wall_index, CASE WHEN fits THEN 'as_is' WHEN greatest(span, tilt) + 6e0 <= 120e0 + 1e-6::DOUBLE THEN 're_aimed' ELSE 'tiled' END AS tier FROM walls_ JOIN spans USING (building, wall_index)""")
def coverage_tier(s, d):
    return cameras.views(_aimed(s, d)).select("building", "wall_index", "tier")


@query(_VIEW_SQL + """
SELECT building, wall_index::INTEGER AS wall_index, corner, round(u, 3) + 0e0 AS u, round(v, 3) + 0e0 AS v FROM uv WHERE sz > 0.5""")
def project_quad(s, d):
    at, axes = cameras.posed(_aimed(s, d))
    cam = tuple(F.col(f"cam_{c}") for c in "xyz")
    rows = []
    for n in ("b1", "b2", "t2", "t1"):
        u, v, z = g.project(rings.point(n), cam, axes, F.col("fov"))
        rows.append(F.struct(F.lit(n).alias("corner"), u.alias("u"), v.alias("v"), z.alias("z")))
    return _round(at.select("building", "wall_index", F.inline(F.array(*rows))).where("z > 0.5").drop("z"), "u", "v", digits=3)


@query("""
WITH a AS (SELECT DISTINCT user_id, (value * 3e0) - 360e0 * floor(value * 3e0 / 360e0) AS deg FROM events),
gaps AS (SELECT user_id, deg, coalesce(lead(deg) OVER w, first_value(deg) OVER w + 360e0) AS nxt FROM a WINDOW w AS (PARTITION BY user_id ORDER BY deg)),
best AS (SELECT user_id, arg_max((deg, nxt), (nxt - deg, -deg)) AS g FROM gaps GROUP BY user_id)
SELECT user_id, round(g[1] + 360e0 - g[2], 5) + 0e0 AS span, round(g[2] - 360e0 * floor(g[2] / 360e0), 5) + 0e0 AS start FROM best""")
def circular_span(s, d):
    e = t.read(s, d, "events").select(F.col("user_id").alias("grp"), (F.col("value") * 3.0).alias("angle"))
    return _round(cameras.circular_spans(e).withColumnRenamed("grp", "user_id"), "span", "start")


@query("""
WITH a AS (SELECT event_id, value AS start, value / 2e0 AS span, greatest(1, ceil(value / 2e0 / 70e0))::INTEGER AS n FROM events)
SELECT event_id, i::INTEGER AS tile, round(CASE WHEN n = 1 THEN (start + start + span) * 0.5e0 ELSE start + (i + 0.5e0) * (span / n) END
       - 360e0 * floor(CASE WHEN n = 1 THEN (start + start + span) * 0.5e0 ELSE start + (i + 0.5e0) * (span / n) END / 360e0), 5) + 0e0 AS center FROM a, range(0, 10) r(i) WHERE i < n""")
def tile_centers(s, d):
    e = t.read(s, d, "events")
    c = g.tile_centers(F.col("value"), F.col("value") + F.col("value") / 2.0, F.col("value") / 2.0)
    return _round(e.select("event_id", F.posexplode(c).alias("tile", "center")), "center")


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 1000e0 + 0.5e0 AS w, l_quantity * 10e0 + 0.5e0 AS h FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(ceil(w * ppm), 1)::BIGINT AS width_px, greatest(ceil(h * ppm), 1)::BIGINT AS height_px, round(ppm, 4) + 0e0 AS ppm
FROM (SELECT *, CASE WHEN ceil(w * 100e0) * ceil(h * 100e0) > 30000000 THEN 100e0 * sqrt(30000000e0 / (ceil(w * 100e0) * ceil(h * 100e0))) ELSE 100e0 END AS ppm FROM c)""")
def ortho_canvas(s, d):
    c = t.read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), (F.col("l_extendedprice") / 1000.0).alias("xmax"), (F.col("l_quantity") * 10.0).alias("ymax"))
    return _round(cameras.ortho_canvas(c).drop("xmin", "ymin", "xmax", "ymax"), "ppm", digits=4)


# Files, names


@query(r"""
WITH f AS (SELECT page_id, regexp_replace(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\.[^.]*$', '\1'), '_3d$', '') AS stem FROM pages),
r AS (SELECT 'page' || p_partkey AS stem, p_partkey, CASE WHEN p_size % 2 = 0 THEN 'tif' ELSE 'tiff' END AS ext FROM part)
SELECT page_id, stem, arg_min(ext, (ext, p_partkey)) AS ext, arg_min(p_partkey, (ext, p_partkey)) AS raster FROM f LEFT JOIN r USING (stem) GROUP BY ALL""")
def raster_join_fallback(s, d):
    f = t.read(s, d, "pages").select("page_id", naming.building_stem(F.col("url")).alias("stem"))
    r = t.read(s, d, "part").select(F.concat(F.lit("page"), F.col("p_partkey").cast("string")).alias("stem"), "p_partkey", F.when(F.col("p_size") % 2 == 0, "tif").otherwise("tiff").alias("ext"))
    best = r.groupBy("stem").agg(F.min(F.struct("ext", "p_partkey")).alias("b")).select("stem", "b.ext", F.col("b.p_partkey").alias("raster"))
    return f.join(best, "stem", "left").select("page_id", "stem", "ext", "raster")


@query(r"""SELECT page_id, regexp_replace(url || '&key=' || page_id || 'secret&size=1', '(key=)[^&]+', '\1****', 'g') AS url FROM pages""")
def mask_key(s, d):
    return t.read(s, d, "pages").select("page_id", naming.mask_key(F.concat("url", F.lit("&key="), F.col("page_id").cast("string"), F.lit("secret&size=1"))).alias("url"))


@query(r"SELECT page_id, regexp_replace(url, '[^\p{L}\p{N}_-]', '_', 'g') AS name FROM pages")
def sanitize_name(s, d):
    return t.read(s, d, "pages").select("page_id", naming.sanitize(F.col("url")).alias("name"))


@query(r"""
WITH p AS (SELECT *, 'wall_' || lpad(p_size::VARCHAR, 2, '0') || '__pano_' || regexp_replace(p_name, '[^\p{L}\p{N}_-]', '_', 'g') || '__hdg_' || round_even(p_retailprice / 7e0, 0)::INTEGER
  || '__pit_' || round_even(p_size / 2e0 - 10, 0)::INTEGER || '__fov_' || round_even(p_size + 40e0, 0)::INTEGER AS view FROM part)
SELECT p_partkey, p_brand || '_wall' || lpad(p_size::VARCHAR, 2, '0') || '_ortho.png' AS texture, view || '__ortho_final_meta.json' AS meta, p_brand || '__textured.glb' AS model FROM p""")
def artifact_names(s, d):
    p = t.read(s, d, "part")
    view = naming.wall_base(F.col("p_size"), F.col("p_name"), F.col("p_retailprice") / 7.0, F.col("p_size") / 2.0 - 10.0, F.col("p_size") + 40.0)
    names = {"texture": ("ortho_png", None), "meta": ("ortho_meta", view), "model": ("glb", None)}
    return p.select("p_partkey", *(naming.artifact(stage, F.col("p_brand"), F.col("p_size"), v).alias(k) for k, (stage, v) in names.items()))


@query("""
WITH a AS (SELECT s_suppkey AS area, s_nationkey AS zone, s_acctbal AS low, s_acctbal + 800e0 AS high FROM supplier),
m AS (SELECT c_custkey AS id, area, greatest(low - c_acctbal, c_acctbal - high, 0e0) AS d FROM customer JOIN a ON c_nationkey = zone)
SELECT id, arg_min(area, (d, area)) AS area, round(min(d), 4) + 0e0 AS distance FROM m GROUP BY id""")
def nearest_or_containing(s, d):
    a = t.read(s, d, "supplier").select(F.col("s_suppkey").alias("area"), F.col("s_nationkey").alias("zone"), F.col("s_acctbal").alias("low"), (F.col("s_acctbal") + 800.0).alias("high"))
    p = t.read(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("zone"), F.col("c_acctbal").alias("v"))
    return _round(panoramas.nearest_or_containing(p, a), "distance", digits=4)


# Pixels


def _mask(s, d, over: float = 0.0):
    return t.pixels(s, d).where(F.col("v") > over)


@query("WITH" + t.PIXELS_SQL + """
SELECT img, count(*) AS area, round(avg(x), 5) + 0e0 AS cx, round(avg(y), 5) + 0e0 AS cy, min(x)::INTEGER AS x_min, min(y)::INTEGER AS y_min, max(x)::INTEGER AS x_max, max(y)::INTEGER AS y_max FROM px WHERE v > 0 GROUP BY img""")
def mask_stats(s, d):
    return _round(pixels.mask_stats(_mask(s, d)), "cx", "cy")


for _name, _f, _op in (("mask_difference", pixels.difference, "EXCEPT"), ("mask_intersection", pixels.intersection, "INTERSECT"), ("mask_union", pixels.union, "UNION")):

    def _set(s, d, f=_f):
        return f(_mask(s, d), t.pixels(s, d).where("v < 0.05"))

    _set.__name__ = _name
    query("WITH" + t.PIXELS_SQL + f" SELECT img, x::INTEGER AS x, y::INTEGER AS y FROM (SELECT img, x, y FROM px WHERE v > 0 {_op} SELECT img, x, y FROM px WHERE v < 0.05e0)")(_set)


@query("WITH" + t.PIXELS_SQL + """
SELECT DISTINCT img, (x + a)::INTEGER AS x, (y + b)::INTEGER AS y FROM px, range(-1, 2) r(a), range(-1, 2) q(b) WHERE v > 0.1e0 AND x + a BETWEEN 0 AND 7 AND y + b BETWEEN 0 AND 7""")
def mask_dilate(s, d):
    return pixels.dilate(_mask(s, d, 0.1), 1, 8, 8)


@query("WITH" + t.PIXELS_SQL + """
SELECT img, x::INTEGER AS x, y::INTEGER AS y FROM px a WHERE v > -0.1e0 AND NOT EXISTS (
  SELECT 1 FROM px b WHERE b.img = a.img AND abs(b.x - a.x) <= 1 AND abs(b.y - a.y) <= 1 AND NOT b.v > -0.1e0)""")
def mask_erode(s, d):
    return pixels.erode(_mask(s, d, -0.1), 1, 8, 8)


def _scored(s, d):
    p = t.pixels(s, d)
    inst = p.where("v > 0").withColumn("instance", F.col("x") % 4)
    return pixels.score_instances(inst, p.where("v > 0.2"), p.where("x between 1 and 6 and y between 2 and 6"), 8, 8)


_SCORE_SQL = "WITH" + t.PIXELS_SQL + """,
cand AS (SELECT img, x % 4 AS instance, x, y FROM px WHERE v > 0 AND NOT v > 0.2e0),
sums AS (SELECT img, instance, count(*) AS area, count(*) FILTER (WHERE x BETWEEN 1 AND 6 AND y BETWEEN 2 AND 6) AS inside, avg(x) AS cx, avg(y) AS cy FROM cand GROUP BY ALL),
scored AS (
  SELECT *, 4e0 * (inside / area::DOUBLE) + 3e0 * (inside / 30::DOUBLE) - 2e0 * ((area - inside) / area::DOUBLE)
         - sqrt((cx - 3.5e0) * (cx - 3.5e0) + (cy - 4e0) * (cy - 4e0)) / sqrt(128e0) + 0.15e0 * ln(1e0 + area) AS score FROM sums)"""


@query(_SCORE_SQL + " SELECT img, instance::INTEGER AS instance, area, inside, round(score, 5) + 0e0 AS score FROM scored")
def facade_scores(s, d):
    return _round(_scored(s, d).select("img", "instance", "area", "inside", "score"), "score")


@query(_SCORE_SQL + " SELECT img, arg_max(instance, (round(score, 9), -instance))::INTEGER AS instance FROM scored GROUP BY img")
def facade_score_best(s, d):
    return pixels.best_instance(_scored(s, d).withColumn("score", F.round("score", 9))).select("img", "instance")


@query("WITH" + t.PIXELS_SQL + """
SELECT img, coalesce(floor(median(floor((v + 1e0) * 100e0)) FILTER (WHERE v > 0.3e0)), 180)::BIGINT AS fill FROM px GROUP BY img""")
def median_fill(s, d):
    return pixels.median_fill(t.pixels(s, d).select("img", F.floor((F.col("v") + 1.0) * 100.0).alias("v"), (F.col("v") > 0.3).alias("valid")))


@query("WITH" + t.PIXELS_SQL + """,
l AS (SELECT img // 4 AS img, x, y, floor((v + 1e0) * 100e0) AS v, ((img % 4) + x)::DOUBLE AS w FROM px)
SELECT img, x::INTEGER AS x, y::INTEGER AS y, floor(least(greatest(CASE WHEN sum(w) > 0 THEN sum(v * w) / sum(w) ELSE 0 END, 0), 255))::BIGINT AS v FROM l GROUP BY ALL""")
def weighted_blend(s, d):
    p = t.pixels(s, d)
    return pixels.weighted_blend(p.select(F.floor(F.col("img") / 4).alias("img"), "x", "y", F.floor((F.col("v") + 1.0) * 100.0).alias("v"), (F.col("img") % 4 + F.col("x")).cast("double").alias("w")))


@query("WITH" + t.PIXELS_SQL + """,
b AS (SELECT label AS img, img // 2 AS k, x, y, v FROM px WHERE img % 2 = 0 AND v > -0.1e0), a AS (SELECT label AS img, img // 2 AS k, x, y, v + 0.3e0 AS v FROM px WHERE img % 2 = 1 AND v > -0.2e0),
m AS (SELECT b.k AS img, count(*) AS overlap, avg(floor((b.v + 1e0) * 100e0)) AS a, avg(floor((a.v + 1e0) * 100e0)) AS b FROM b JOIN a ON a.k = b.k AND a.x = b.x AND a.y = b.y GROUP BY b.k)
SELECT img, overlap, round(CASE WHEN overlap < 20 OR b < 1e-6::DOUBLE THEN 1e0 ELSE least(greatest(a / b, 0.6e0), 1.6e0) END, 5) + 0e0 AS gain FROM m""")
def exposure_gain(s, d):
    p = t.pixels(s, d).withColumn("k", F.floor(F.col("img") / 2))
    layer = lambda odd, low, add: p.where((F.col("img") % 2 == odd) & (F.col("v") > low)).select(F.col("k").alias("img"), "x", "y", F.floor((F.col("v") + add + 1.0) * 100.0).alias("v"))
    return _round(pixels.exposure_gain(layer(0, -0.1, 0.0), layer(1, -0.2, 0.3), least=20), "gain")


@query("WITH RECURSIVE" + t.PIXELS_SQL + """,
m AS (SELECT img, x, y, y * 1048576 + x AS id FROM px WHERE v > 0.1e0),
walk(img, id, x, y, root) AS (
  SELECT img, id, x, y, id FROM m UNION
  SELECT m.img, m.id, m.x, m.y, w.root FROM walk w JOIN m ON m.img = w.img AND abs(m.x - w.x) <= 1 AND abs(m.y - w.y) <= 1 WHERE m.id > w.root),
labels AS (SELECT img, id, min(root) AS label FROM walk GROUP BY ALL)
SELECT img, label, count(*) AS area FROM labels GROUP BY ALL""")
def pixel_components_area(s, d):
    return graphs.component_areas(graphs.pixel_components(_mask(s, d, 0.1)))


# Matching and fitting


@query("""
WITH q AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), 
m AS (SELECT a.label AS grp, a.vec_id AS query_id, b.vec_id AS target_id, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
  FROM q a JOIN q b ON a.label = b.label AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
r AS (SELECT *, lead(d) OVER w AS d2, row_number() OVER w AS k FROM m WINDOW w AS (PARTITION BY query_id ORDER BY d, target_id))
SELECT grp, query_id, target_id, round(d, 5) + 0e0 AS distance FROM r WHERE k = 1 AND d < 0.95e0 * d2""")
def knn_ratio_match(s, d):
    """Images of even number against those of odd number, by label."""
    e = t.read(s, d, "embeddings").select(F.col("label").alias("grp"), F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return _round(fitting.ratio_matches(e.where("id % 2 = 0"), e.where("id % 2 = 1"), 0.95), "distance")


@query("""
WITH p AS (SELECT l_suppkey AS grp, l_quantity AS x, l_extendedprice / 2000e0 AS y FROM lineitem),
m AS (SELECT grp, count(*) AS n, avg(x) AS cx, avg(y) AS cy, 0.5e0 * atan2(2e0 * covar_pop(x, y), var_pop(x) - var_pop(y)) AS a FROM p GROUP BY grp),
e AS (SELECT grp, min((x - cx) * cos(a) + (y - cy) * sin(a)) - 20e0 AS lo, max((x - cx) * cos(a) + (y - cy) * sin(a)) + 20e0 AS hi FROM p JOIN m USING (grp) GROUP BY grp)
SELECT grp, n, round(degrees(a), 4) + 0e0 AS angle_deg, round(cx + cos(a) * lo, 4) + 0e0 AS x0, round(cy + sin(a) * lo, 4) + 0e0 AS y0, round(cx + cos(a) * hi, 4) + 0e0 AS x1, round(cy + sin(a) * hi, 4) + 0e0 AS y1 FROM m JOIN e USING (grp)""")
def line_fit_tls(s, d):
    p = t.read(s, d, "lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 2000.0).alias("y"))
    return _round(fitting.fit_line(p).drop("cx", "cy"), "angle_deg", "x0", "y0", "x1", "y1", digits=4)


_SEGMENTS_SQL = """
s AS (SELECT c_custkey AS seg, c_nationkey AS grp, c_acctbal / 10e0 AS x0, length(c_name) * 10e0 AS y0, c_acctbal / 10e0 + (c_custkey % 97) * 4e0 - 150e0 AS x1, length(c_name) * 10e0 + (c_custkey % 53) * 9e0 - 200e0 AS y1 FROM customer),
t AS (SELECT n_nationkey AS grp, n_nationkey * 20e0 AS tx0, 0e0 AS ty0, n_nationkey * 20e0 + 30e0 AS tx1, 600e0 AS ty1 FROM nation)"""


@query("WITH" + _SEGMENTS_SQL + """,
j AS (SELECT *, degrees(atan2(y1 - y0, x1 - x0)) AS a, degrees(atan2(ty1 - ty0, tx1 - tx0)) AS b FROM s JOIN t USING (grp)),
turned AS (SELECT *, abs((a - 180e0 * floor(a / 180e0)) - (b - 180e0 * floor(b / 180e0))) AS turn FROM j),
pts AS (SELECT *, round_even(x0 + (x1 - x0) * k, 0) AS sx, round_even(y0 + (y1 - y0) * k, 0) AS sy FROM turned, (VALUES (0e0), (1e0), (0.5e0), (0.75e0), (0.25e0)) v(k)),
near AS (SELECT *, least(greatest(((sx - tx0) * (tx1 - tx0) + (sy - ty0) * (ty1 - ty0)) / ((tx1 - tx0) * (tx1 - tx0) + (ty1 - ty0) * (ty1 - ty0)), 0e0), 1e0) AS u FROM pts)
SELECT DISTINCT grp, seg FROM near WHERE sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) >= 120 AND least(turn, 180e0 - turn) <= 12
  AND sqrt((sx - (tx0 + (tx1 - tx0) * u)) * (sx - (tx0 + (tx1 - tx0) * u)) + (sy - (ty0 + (ty1 - ty0) * u)) * (sy - (ty0 + (ty1 - ty0) * u))) <= 80""")
def hough_candidate_filter(s, d):
    return fitting.segment_candidates(*_segments(s, d)).select("grp", "seg")


def _segments(s, d):
    c = t.read(s, d, "customer")
    x, y, k = F.col("c_acctbal") / 10.0, F.length("c_name") * F.lit(10.0), F.col("c_custkey")
    seg = c.select(k.alias("seg"), F.col("c_nationkey").alias("grp"), x.alias("x0"), y.alias("y0"), (x + (k % 97) * F.lit(4.0) - 150.0).alias("x1"), (y + (k % 53) * F.lit(9.0) - 200.0).alias("y1"))
    n = t.read(s, d, "nation").select(F.col("n_nationkey").alias("grp"), (F.col("n_nationkey") * F.lit(20.0)).alias("tx0"), F.lit(0.0).alias("ty0"), (F.col("n_nationkey") * F.lit(20.0) + 30.0).alias("tx1"), F.lit(600.0).alias("ty1"))
    return seg, n


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 1000e0 AS x, l_quantity AS y, 40e0 + l_quantity / 10e0 AS a, 70e0 - l_quantity / 5e0 AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN x <= a THEN x * (30e0 / greatest(a, 1e-6::DOUBLE)) WHEN x <= b THEN 30e0 + (x - a) / greatest(b - a, 1e-6::DOUBLE) * 50e0 ELSE 80e0 + (x - b) / greatest(119e0 - b, 1e-6::DOUBLE) * 39e0 END, 8) + 0e0 AS x FROM p""")
def piecewise_remap(s, d):
    p = t.read(s, d, "lineitem")
    y = F.col("l_quantity")
    line = lambda a, b: tuple(F.lit(float(v)) for v in (a, 0.0, b, 50.0))
    x = g.horizontal_map(F.col("l_extendedprice") / 1000.0, y, line(40, 45), line(70, 60), line(30, 30), line(80, 80), 120)
    return _round(p.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x.alias("x")), "x", digits=8)


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 1000e0 AS x, l_quantity AS y FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((1.1e0 * x + 0.2e0 * y + 3e0) / (0.001e0 * x + 0.002e0 * y + 1e0), 5) + 0e0 AS u, round((-0.1e0 * x + 0.9e0 * y + 5e0) / (0.001e0 * x + 0.002e0 * y + 1e0), 5) + 0e0 AS v FROM p""")
def homography_apply(s, d):
    u, v = g.apply_homography([1.1, 0.2, 3, -0.1, 0.9, 5, 0.001, 0.002, 1], F.col("l_extendedprice") / 1000.0, F.col("l_quantity"))
    return _round(t.read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", u.alias("u"), v.alias("v")), "u", "v")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_extendedprice / 1000e0 - 1e0) * 100e0, 4) + 0e0 AS u,
       round(CASE WHEN l_returnflag = 'N' THEN (60e0 - l_quantity) * 100e0 ELSE (l_quantity - 2e0) * 100e0 END, 4) + 0e0 AS v FROM lineitem""")
def meter_to_pixel(s, d):
    u, v = g.meter_to_pixel(F.col("l_extendedprice") / 1000.0, F.col("l_quantity"), F.lit(1.0), F.lit(2.0), F.lit(110.0), F.lit(60.0), 100.0, F.col("l_returnflag") == "N")
    return _round(t.read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", u.alias("u"), v.alias("v")), "u", "v", digits=4)


@query("SELECT s_suppkey, 0e0 AS error FROM supplier")
def homography_from_points(s, d):
    """A homography through four points, applied to them again: the largest error for each supplier (about 0)."""
    p = t.read(s, d, "supplier")
    k = F.col("s_suppkey") % 7
    src = [(F.lit(0.0), F.lit(0.0)), (F.lit(4.0) + k, F.lit(1.0)), (F.lit(5.0), F.lit(6.0) + k), (F.lit(-1.0), F.lit(5.0))]
    dst = [(F.lit(10.0), F.lit(10.0)), (F.lit(90.0), F.lit(12.0) + k), (F.lit(100.0) + k, F.lit(80.0)), (F.lit(8.0), F.lit(95.0))]
    h = g.homography(src, dst)
    errors = [F.abs(a - b) for (x, y), q in zip(src, dst, strict=True) for a, b in zip(g.apply_homography(h, x, y), q, strict=True)]
    return p.select("s_suppkey", F.round(F.greatest(*errors), 6).alias("error"))


_QUADS_SQL = """
c AS (SELECT c_custkey AS id, c_nationkey AS a, c_custkey % 40 AS b, c_custkey % 13 AS c, c_custkey % 7 AS d FROM customer),
wall AS (
  SELECT id, 0 AS k, c::DOUBLE AS x, d::DOUBLE AS y FROM c UNION ALL SELECT id, 1, 100e0 + a, d / 2e0 FROM c
  UNION ALL SELECT id, 2, 110e0 + a - c, 80e0 + b FROM c UNION ALL SELECT id, 3, c / 2e0, 70e0 + b FROM c),
seg AS (
  SELECT id, k, x / (1e0 + (id % 11) * (id % 11)) AS x, y / (1e0 + (id % 11) * (id % 11)) AS y FROM (
    SELECT id, 0 AS k, 0e0 AS x, 0e0 AS y FROM c UNION ALL SELECT id, 1, 10e0 + c, 1e0 + d / 4e0 FROM c UNION ALL SELECT id, 2, 9e0 + c, 8e0 + d FROM c UNION ALL SELECT id, 3, 1e0, 7e0 + d / 2e0 FROM c))"""


@query("WITH" + _QUADS_SQL + """,
turn AS (SELECT p.id, p.k, p.x AS x0, p.y AS y0, q.x AS x1, q.y AS y1 FROM wall p JOIN wall q ON p.id = q.id AND q.k = (p.k + 1) % 4),
mid AS (SELECT id, avg(x) AS mx, avg(y) AS my, greatest(max(x) - min(x), 1e0) AS w, greatest(max(y) - min(y), 1e0) AS h FROM wall GROUP BY id),
area AS (SELECT id, abs(sum(x0 * y1 - x1 * y0)) / 2e0 AS big FROM turn GROUP BY id),
small AS (SELECT p.id, abs(sum(p.x * q.y - q.x * p.y)) / 2e0 AS little FROM seg p JOIN seg q ON p.id = q.id AND q.k = (p.k + 1) % 4 GROUP BY p.id),
guess AS (SELECT id, greatest(0.05e0, sqrt(greatest(big, 1e-6::DOUBLE) / greatest(little, 1e-6::DOUBLE))) AS guess FROM area JOIN small USING (id)),
most AS (SELECT id, guess * pow(1.35e0, least(20e0, greatest(0e0, ceil(ln(6e0 / guess) / ln(1.35e0))))) AS most FROM guess),
side AS (
  SELECT t.id, t.k, CASE WHEN -(y1 - y0) * (mx - x0) + (x1 - x0) * (my - y0) < 0 THEN -1e0 ELSE 1e0 END / sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS f, x0, y0, x1, y1 FROM turn t JOIN mid USING (id)),
line AS (SELECT id, k, -(y1 - y0) * f AS a, (x1 - x0) * f AS b, ((y1 - y0) * x0 - (x1 - x0) * y0) * f AS c FROM side),
shape AS (SELECT s.id, x - avg(x) OVER (PARTITION BY s.id) AS x, y - avg(y) OVER (PARTITION BY s.id) AS y FROM seg s),
reach AS (SELECT l.id, l.k, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, max(-(a * x + b * y)) AS m FROM line l JOIN shape s ON l.id = s.id GROUP BY l.id, l.k),
tried AS (
  SELECT id, i, j, mx + w * 0.2e0 * (i / 10e0 - 1e0) AS cx, my + h * 0.2e0 * (j / 10e0 - 1e0) AS cy FROM mid, range(21) r(i), range(21) q(j)),
fits AS (
  SELECT t.id, i, j, any_value(cx) AS cx, any_value(cy) AS cy, CASE WHEN min(a * cx + b * cy + c - 0.25e0) >= 0 THEN least(any_value(most), min(CASE WHEN m > 0 THEN (a * cx + b * cy + c - 0.25e0) / m ELSE most END)) ELSE 0e0 END AS scale
  FROM tried t JOIN reach r ON t.id = r.id JOIN most o ON o.id = t.id GROUP BY t.id, i, j),
placed AS (
  SELECT f.id, i, j, any_value(f.scale) AS scale, any_value(sqrt((cx - mx) * (cx - mx) + (cy - my) * (cy - my)) / greatest(sqrt(w * w + h * h), 1e0)) AS away,
         min(a * cx + b * cy + c - f.scale * m) AS near, any_value(cx) AS cx, any_value(cy) AS cy
  FROM fits f JOIN reach r ON f.id = r.id JOIN mid ON mid.id = f.id GROUP BY f.id, i, j),
best AS (
  SELECT id, arg_max({'scale': scale, 'away': away, 'near': near, 'cx': cx, 'cy': cy}, (round_even(scale * 1e9, 0), -round_even(away * 1e9, 0), -round_even(near * 1e9, 0), -(i * 21 + j))) AS b FROM placed GROUP BY id),
turned AS (SELECT id, avg(x) AS sx, avg(y) AS sy FROM seg GROUP BY id)
SELECT id, round(b.scale, 5) + 0e0 AS scale, round(b.cx - b.scale * sx, 4) + 0e0 AS tx, round(b.cy - b.scale * sy, 4) + 0e0 AS ty, round(b.cx, 4) + 0e0 AS center_x, round(b.cy, 4) + 0e0 AS center_y,
       round(b.near, 4) + 0e0 AS min_dist, round(b.away, 6) + 0e0 AS center_dist, b.near <= 0.75e0 AS touching FROM best JOIN turned USING (id)""")
def quad_scale_fit(s, d):
    """Off-center quads, down to a hundredth of the size, within walls with no right angle, over all placements."""
    k = {n: F.col("c_custkey") % v for n, v in (("b", 40), ("c", 13), ("d", 7))} | {"a": F.col("c_nationkey")}
    quad = lambda *ps: F.array(*(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ps))
    lit = lambda x: F.lit(float(x))
    wall = quad((k["c"], k["d"]), (lit(100) + k["a"], k["d"] / 2.0), (lit(110) + k["a"] - k["c"], lit(80) + k["b"]), (k["c"] / 2.0, lit(70) + k["b"]))
    seg = quad((lit(0), lit(0)), (lit(10) + k["c"], lit(1) + k["d"] / 4.0), (lit(9) + k["c"], lit(8) + k["d"]), (lit(1), lit(7) + k["d"] / 2.0))
    small = F.lit(1.0) + (F.col("c_custkey") % 11) * (F.col("c_custkey") % 11)
    seg = F.transform(seg, lambda p: F.struct((p["x"] / small).alias("x"), (p["y"] / small).alias("y")))
    fits = fitting.fit_quads(t.read(s, d, "customer").select(F.col("c_custkey").alias("id"), seg.alias("seg"), wall.alias("wall")))
    return _round(_round(_round(fits, "scale"), "center_dist", digits=6), "tx", "ty", "center_x", "center_y", "min_dist", digits=4)


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT l_partkey * 2 AS a, l_suppkey * 2 + 1 AS b FROM lineitem),
both_ AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e),
walk(node, root) AS (SELECT u, u FROM both_ UNION SELECT b.v, w.root FROM walk w JOIN both_ b ON b.u = w.node WHERE b.v > w.root)
SELECT node, min(root) AS label FROM walk GROUP BY node""")
def graph_components(s, d):
    """Parts and suppliers that line items bring together."""
    e = t.read(s, d, "lineitem").select((F.col("l_partkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b"))
    return graphs.graph_components(e)


# Documents


@query("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN value > 1 THEN 'OK' ELSE 'ZERO_RESULTS' END AS status FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL AND value > 1""")
def json_lookup(s, d):
    """Bodies that parse and whose status is OK."""
    e = t.read(s, d, "events")
    return e.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.when(F.col("value") > 1, "OK").otherwise("ZERO_RESULTS").alias("status")).where("k is not null and status = 'OK'")


@query()
def wall_document_json(s, d):
    """A wall's document: what the view, the wall and its canvas are, as JSON."""
    return documents.wall_documents(cameras.views(_aimed(s, d)))


@query("""
WITH RECURSIVE p AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS k, l_partkey % 11 = 0 AS lost,
         1e0 + l_discount AS a, l_tax AS b, l_quantity / 9.7e0 AS c, 1e0 - l_discount / 2.1e0 AS d, l_extendedprice / 49999.7e0 AS e FROM lineitem),
up(grp, image, a, b, c, d, e) AS (
  SELECT DISTINCT l_orderkey, 0::BIGINT, 1e0, 0e0, 0e0, 1e0, 0e0 FROM p
  UNION ALL
  SELECT grp, image + 1, p.a * u.a, p.a * u.b + p.b * u.d, p.a * u.c + p.b * u.e + p.c, p.d * u.d, p.d * u.e + p.e FROM up u JOIN p ON p.l_orderkey = grp AND p.k = image WHERE NOT p.lost)
SELECT i.l_orderkey AS grp, i.image::INTEGER AS image, round(1e0 / a, 6) + 0e0 AS m11, round(-b / (a * d), 6) + 0e0 AS m12, round((b * e - c * d) / (a * d), 6) + 0e0 AS m13, round(1e0 / d, 6) + 0e0 AS m22,
       round(-e / d, 6) + 0e0 AS m23
FROM (SELECT l_orderkey, unnest(range(count(*) + 1)) AS image FROM p GROUP BY l_orderkey) i LEFT JOIN up ON up.grp = i.l_orderkey AND up.image = i.image""")
def homography_chain(s, d):
    """Images of a building in order, each by a homography to the next (some are missing): all of them to the first."""
    e = t.read(s, d, "lineitem")
    e = e.repartition(max(s.sparkContext.defaultParallelism, e.count() // t.ROWS), "l_orderkey")
    own = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    h = F.array(F.lit(1.0) + F.col("l_discount"), "l_tax", F.col("l_quantity") / 9.7, F.lit(0.0), F.lit(1.0) - F.col("l_discount") / 2.1, F.col("l_extendedprice") / 49999.7, F.lit(0.0), F.lit(0.0), F.lit(1.0))
    links = e.select(F.col("l_orderkey").alias("grp"), (F.row_number().over(own) - 1).alias("k"), F.when(F.col("l_partkey") % 11 != 0, h).alias("h"))
    at = fitting.chains(links, 0)
    names = {"m11": 0, "m12": 1, "m13": 2, "m22": 4, "m23": 5}
    return _round(at.select("grp", "image", *(F.get("h", F.lit(k)).alias(n) for n, k in names.items())), *names, digits=6)


@query("WITH" + t.WALLS_SQL + """
SELECT building, wall_index::INTEGER AS wall_index, CASE WHEN plain AND NOT turned THEN false WHEN turned AND NOT plain THEN true ELSE NOT plain END AS flip
FROM (SELECT *, (zhi1 + zhi2) < (zlo1 + zlo2) AS plain, (zhi1 + zhi2) > (zlo1 + zlo2) AS turned FROM walls)""")
def wall_orientation(s, d):
    w = rings.wall_faces(t.edges(s, d))
    z = {n: F.col(f"{n}.z") for n in ("b1", "b2", "t2", "t1")}
    return w.select("building", "wall_index", g.flipped((z["t2"], z["t1"]), (z["b1"], z["b2"]), F.least(*z.values()), F.greatest(*z.values()), 100.0).alias("flip"))


@query("WITH" + t.PIXELS_SQL + """,
cand AS (SELECT img, x % 4 AS instance, x, y FROM px WHERE v > 0 AND NOT v > 0.2e0),
wall AS (SELECT img, x, y FROM px WHERE x BETWEEN 1 AND 6 AND y BETWEEN 2 AND 6 AND img % 3 > 0),
sums AS (SELECT c.img, instance, count(*) AS area, count(w.img) AS inside, avg(c.x) AS cx, avg(c.y) AS cy FROM cand c LEFT JOIN wall w ON c.img = w.img AND c.x = w.x AND c.y = w.y GROUP BY ALL),
scored AS (
  SELECT *, CASE WHEN img % 3 = 0 THEN area ELSE 4e0 * (inside / area::DOUBLE) + 3e0 * (inside / 30::DOUBLE) - 2e0 * ((area - inside) / area::DOUBLE)
         - sqrt((cx - 3.5e0) * (cx - 3.5e0) + (cy - 4e0) * (cy - 4e0)) / sqrt(128e0) + 0.15e0 * ln(1e0 + area) END AS score FROM sums)
SELECT img, arg_max(instance, (round(score, 9), -instance))::INTEGER AS instance FROM scored GROUP BY img""")
def facade_fallback(s, d):
    """Images of every third number have no wall: the largest instance is taken there."""
    p = t.pixels(s, d)
    inst = p.where("v > 0").withColumn("instance", F.col("x") % 4)
    wall = p.where("x between 1 and 6 and y between 2 and 6 and img % 3 > 0")
    return pixels.best_instance(pixels.score_instances(inst, p.where("v > 0.2"), wall, 8, 8).withColumn("score", F.round("score", 9))).select("img", "instance")

"""Polygons as arrays of corners (structs of x, y): roofs from rings, the polygon around a point, rasters, line bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.functions import facets
from gablework.functions import geometry as g
from gablework.operators import pixels
from gablework.operators.columns import once, spread
from gablework.operators.rings import RING

#: The least area of a roof, in square metres, and how far outside a raster a corner may lie, in pixels.
LEAST_ROOF, OVERSHOOT = 0.1, 2048


def sides(corners: Column) -> Column:
    """Array of structs x1, y1, x2, y2: each corner with the next, the last with the first."""
    follow = lambda i: F.get(corners, F.pmod(i + 1, F.size(corners)))
    return F.transform(corners, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), follow(i)["x"].alias("x2"), follow(i)["y"].alias("y2")))


def _turn(s: Column, x: Column, y: Column) -> Column:
    return (s["x2"] - s["x1"]) * (y - s["y1"]) - (x - s["x1"]) * (s["y2"] - s["y1"])


def contains(sides: Column, x: Column, y: Column) -> Column:
    """Even-odd test, without a division."""
    crossed = F.filter(sides, lambda s: ((s["y1"] > y) != (s["y2"] > y)) & ((_turn(s, x, y) > 0) == (s["y2"] > s["y1"])))
    return F.size(crossed) % 2 == 1


def on_side(sides: Column, x: Column, y: Column) -> Column:
    between = lambda v, a, b: (v >= F.least(a, b)) & (v <= F.greatest(a, b))
    return F.exists(sides, lambda s: (_turn(s, x, y) == 0) & between(x, s["x1"], s["x2"]) & between(y, s["y1"], s["y2"]))


def distance(sides: Column, x: Column, y: Column) -> Column:
    """Of a point from the nearest side."""
    return F.array_min(F.transform(sides, lambda s: g.point_segment_distance((x, y), (s["x1"], s["y1"]), (s["x2"], s["y2"]))))


def is_simple(sides: Column) -> Column:
    """Whether no two sides cross within both."""
    parts = lambda a, b: (_turn(a, b["x1"], b["y1"]) > 0) != (_turn(a, b["x2"], b["y2"]) > 0)
    flat = lambda a, b: (_turn(a, b["x1"], b["y1"]) == 0) | (_turn(a, b["x2"], b["y2"]) == 0)
    return ~F.exists(sides, lambda a: F.exists(sides, lambda b: parts(a, b) & parts(b, a) & ~flat(a, b) & ~flat(b, a)))


def area(sides: Column) -> Column:
    total = F.aggregate(sides, F.lit(0.0), lambda sum_, s: sum_ + s["x1"] * s["y2"] - s["x2"] * s["y1"])
    return F.abs(total) / 2.0


#: Pairs of sides, or sides, that are compared at once.
SIDES = 1 << 18


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sides (a row each: x1, y1, x2, y2) of arrays of sides, and how many each array has."""
    flat = lists.flatten()
    return np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2")], axis=1), pc.list_value_length(lists).fill_null(0).to_numpy()


def _simple(s: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether no two sides of each polygon cross within both: is_simple for many. Polygons with as many sides are tested together, each side
    against those that lie so many places further."""
    out, first = np.ones(len(size), bool), np.cumsum(size) - size
    turn = lambda a, x, y: (a[..., 2] - a[..., 0]) * (y - a[..., 1]) - (x - a[..., 0]) * (a[..., 3] - a[..., 1])
    for n in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == n)
        for k in range(0, len(rows), max(1, SIDES // n)):
            few = rows[k : k + max(1, SIDES // n)]
            a = s[first[few][:, None] + np.arange(n)]
            for step in range(1, n // 2 + 1):
                b = np.roll(a, -step, axis=1)
                ab1, ab2, ba1, ba2 = turn(a, b[..., 0], b[..., 1]), turn(a, b[..., 2], b[..., 3]), turn(b, a[..., 0], a[..., 1]), turn(b, a[..., 2], a[..., 3])
                crossed = ((ab1 > 0) != (ab2 > 0)) & ((ba1 > 0) != (ba2 > 0)) & (ab1 != 0) & (ab2 != 0) & (ba1 != 0) & (ba2 != 0)
                out[few[crossed.any(axis=1)]] = False
    return out


def _only_simple(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(_simple(*_flat(batch.column("sides")))))


def roof_polygons(edges: DataFrame) -> DataFrame:
    """Closed roofs (building, component, loop, sides, area) of base edges with a corner p each, in ring order: of three corners or more,
    more than LEAST_ROOF large, and simple. A ring is one building's, so its corners are an array."""
    item = F.struct(F.col("ring_order").isNull().alias("last"), "ring_order", "seq", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    ring = edges.where("p is not null").groupBy(*RING).agg(F.array_sort(F.collect_list(item)).alias("corners")).where(F.size("corners") >= 3)
    at = once(ring.select(*RING, "corners"), {"sides": sides(F.col("corners"))}).drop("corners")
    at = once(at, {"area": area(F.col("sides"))}).where(F.col("area") > LEAST_ROOF)
    return at.mapInArrow(_only_simple, at.schema)


def polygon_of_points(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """For points (id, grp, x, y) the polygon of their group (polygon, grp, sides): the first in order that contains the point, or else the nearest,
    of equals the first. Points of a group without polygons are left out. Polygons meet points by group, and only one is kept for each point
    on the way to the shuffle."""
    met = points.join(polygons, "grp").select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "polygon", "sides")
    schema = T.StructType([*met.select("id", "polygon").schema, T.StructField("outside", T.BooleanType()), T.StructField("distance", T.DoubleType())])

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in "xy")
            outside, away = _placed(x, y, *_flat(batch.column("sides")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("polygon"), pa.array(outside), pa.array(away, from_pandas=True)], schema.names)

    best = met.mapInArrow(tested, schema).groupBy("id").agg(F.min(F.struct("outside", "distance", "polygon")).alias("b"))
    return best.select("id", "b.polygon", (~F.col("b.outside")).alias("inside"), "b.distance")


def _placed(x: np.ndarray, y: np.ndarray, s: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each point is outside its polygon, and how far from it: contains and distance for many."""
    outside, away, first = np.ones(len(size), bool), np.full(len(size), np.nan), np.cumsum(size) - size
    held = np.flatnonzero(size > 0)
    for part in facets.parts(size[held], SIDES):
        rows = held[part]
        (x1, y1, x2, y2), start = s[first[rows[0]] : first[rows[-1]] + size[rows[-1]]].T, first[rows] - first[rows[0]]
        px, py = np.repeat(x[rows], size[rows]), np.repeat(y[rows], size[rows])
        dx, dy = x2 - x1, y2 - y1
        turn = dx * (py - y1) - (px - x1) * dy
        # A point without a place is in nothing.
        crossed = ((y1 > py) != (y2 > py)) & ((turn > 0) == (y2 > y1)) & ~np.isnan(turn)
        inside = np.add.reduceat(crossed.astype(np.int64), start) % 2 == 1
        length = dx * dx + dy * dy
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(length > 0, np.clip(((px - x1) * dx + (py - y1) * dy) / length, 0.0, 1.0), 0.0)
        ex, ey = px - (x1 + dx * t), py - (y1 + dy * t)
        outside[rows], away[rows] = ~inside, np.where(inside, 0.0, np.fmin.reduceat(np.sqrt(ex * ex + ey * ey), start))
    return outside, away


def to_raster(corners: Column, inverse: tuple[Column, ...] | None, width: int, height: int) -> Column:
    """Corners as whole pixels (halves to even) by a raster's affine transform; those far outside go."""

    def pixel(p: Column) -> Column:
        at = (p["x"], p["y"]) if inverse is None else g.world_to_pixel(inverse, p["x"], p["y"])
        return F.struct(*(F.rint(v).alias(n) for v, n in zip(at, "xy", strict=True)))

    kept = lambda p: p["x"].between(-OVERSHOOT, width + OVERSHOOT) & p["y"].between(-OVERSHOOT, height + OVERSHOOT)
    return F.filter(F.transform(corners, pixel), kept)


#: Pixels of polygons' boxes that are tested at once.
PIXELS = 1 << 18


def _within(c: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether pixels (x, y) are within or on their rings (c: ring, corner, coordinate), by the even-odd test without a division."""
    inside = np.zeros(np.broadcast_shapes((len(c), 1), x.shape), bool)
    on = inside.copy()
    for p, q in zip(np.moveaxis(c, 1, 0), np.moveaxis(np.roll(c, -1, axis=1), 1, 0), strict=True):
        (x1, y1), (x2, y2) = ((v[:, :1], v[:, 1:]) for v in (p, q))
        turn = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        inside ^= ((y1 > y) != (y2 > y)) & ((turn > 0) == (y2 > y1))
        on |= (turn == 0) & (x >= np.minimum(x1, x2)) & (x <= np.maximum(x1, x2)) & (y >= np.minimum(y1, y2)) & (y <= np.maximum(y1, y2))
    return inside | on


def rasterized(polygons: DataFrame, width: int, height: int) -> DataFrame:
    """Pixels (img, x, y) of polygons (img, outer, holes: arrays of whole-pixel corners and of such arrays): within or on the outer ring
    and neither within nor on a hole. Rings of fewer than three corners don't count. Polygons are dealt out, and those whose rings have as many
    corners are tested together, in blocks of about PIXELS pixels; of a larger box so many rows at a time."""
    held = F.filter(F.coalesce("holes", F.array()), lambda h: F.size(h) >= 3)
    at = spread(polygons.where(F.size("outer") >= 3).select("img", F.concat(F.array("outer"), held).alias("rings")), "img")
    schema = T.StructType([polygons.schema["img"], T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            img, lists = batch.column("img"), batch.column("rings")
            of, sizes = pc.list_value_length(lists).to_numpy(), pc.list_value_length(lists.flatten()).to_numpy()
            flat = lists.flatten().flatten()
            corners = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in "xy"], axis=1)
            ring, start = np.cumsum(of) - of, np.cumsum(sizes) - sizes
            alike: dict[tuple[int, ...], list[int]] = {}
            for k in range(len(of)):
                alike.setdefault(tuple(sizes[ring[k] : ring[k] + of[k]].tolist()), []).append(k)
            for shape, rows in alike.items():
                rows = np.array(rows)
                rings = [corners[start[ring[rows] + n][:, None] + np.arange(size)] for n, size in enumerate(shape)]
                yield from _pixels(img, rows, rings)

    def _pixels(img: pa.Array, rows: np.ndarray, rings: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        few = max(1, PIXELS // (width * height))
        for k in range(0, len(rows), few):
            own = [c[k : k + few] for c in rings]
            (x0, y0), (x1, y1) = (np.clip(np.nan_to_num(f.reduce(own[0], axis=(0, 1)), nan=-1.0), -1, [width, height]) for f in (np.fmin, np.fmax))
            x = np.arange(max(0, int(x0)), min(width - 1, int(x1)) + 1)
            lines = max(1, PIXELS // max(1, len(x) * len(own[0])))
            for low in range(max(0, int(y0)), min(height - 1, int(y1)) + 1, lines):
                y = np.arange(low, min(low + lines - 1, height - 1, int(y1)) + 1)
                px, py = np.tile(x, len(y)), np.repeat(y, len(x))
                held = _within(own[0], px.astype(float)[None], py.astype(float)[None])
                for hole in own[1:]:
                    held &= ~_within(hole, px.astype(float)[None], py.astype(float)[None])
                of, spot = np.nonzero(held)
                yield pa.RecordBatch.from_arrays([img.take(pa.array(rows[k + of])), pa.array(px[spot].astype(np.int32)), pa.array(py[spot].astype(np.int32))], schema.names)

    return at.mapInArrow(filled, schema)


def line_band(lines: DataFrame, wall: DataFrame, band: float, width: int, height: int) -> DataFrame:
    """Pixels (img, x, y) within the band around a line (img, x0, y0, x1, y1; its ends whole pixels) and near the wall (img, x, y)."""
    reach = max(3, int(2 * band)) / 2.0
    near = pixels.dilate(wall, max(3, int(2 * band + 1)) // 2, width, height, "ellipse")
    ends = lines.select("img", *(F.rint(c).alias(c) for c in ("x0", "y0", "x1", "y1")))
    d = g.point_segment_distance((F.col("x"), F.col("y")), (F.col("x0"), F.col("y0")), (F.col("x1"), F.col("y1")))
    return near.join(ends, "img").where(d <= reach).select("img", "x", "y").distinct()


def crop_box(xs: Column, ys: Column, width: int, height: int, pad: int = 16) -> Column:
    """Struct x0, y0, x1, y1 around points (arrays), padded and within the image; the whole image if nothing is left."""
    x0, y0 = (F.greatest(F.lit(0), F.floor(F.array_min(v) - pad)).cast("int") for v in (xs, ys))
    x1, y1 = (F.least(F.lit(n), F.ceil(F.array_max(v) + pad)).cast("int") for v, n in ((xs, width), (ys, height)))
    box = lambda *vs: F.struct(*(v.alias(n) for v, n in zip(vs, ("x0", "y0", "x1", "y1"), strict=True)))
    return F.when((x1 > x0) & (y1 > y0), box(x0, y0, x1, y1)).otherwise(box(*(F.lit(v) for v in (0, 0, width, height))))

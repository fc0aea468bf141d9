"""Matching of descriptors and fitting of lines and quads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.config import Settings
from gablework.functions import geometry as g
from gablework.operators.columns import spread


#: Descriptors of a block.
BLOCK = 2048


def _packed(rows: DataFrame, name: str) -> DataFrame:
    """Blocks of descriptors (grp, id, v): grp, block, and the ids and values of about BLOCK of them."""
    sizes = rows.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    at = rows.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int"))
    one = F.array_sort(F.collect_list(F.struct("id", F.col("v").cast("array<double>").alias("v"))))
    return at.groupBy("grp", "block").agg(F.max("blocks").alias("blocks"), one.alias("rows")).select("grp", "block", "blocks", F.col("rows.id").alias(f"{name}_id"), F.flatten("rows.v").alias(f"{name}_v"))


def ratio_matches(queries: DataFrame, targets: DataFrame, ratio: float = 0.75) -> DataFrame:
    """For descriptors (grp, id, v) of equal lengths, each query's nearest target of its group, where it is nearer than ratio times the
    second nearest (ties to the lesser id): grp, query_id, target_id, distance. Rows are packed in blocks, each block of queries is
    sent to its group's blocks of targets, and a pair of blocks gives two targets for each query."""
    t = _packed(targets, "t")
    counts = t.groupBy("grp").agg(F.max("blocks").alias("to"))
    q = _packed(queries, "q").drop("block", "blocks").join(counts, "grp").select("grp", "q_id", "q_v", F.explode(F.sequence(F.lit(0), F.col("to") - 1)).alias("block"))
    schema = T.StructType([targets.select("grp").schema[0], T.StructField("query_id", T.LongType()), T.StructField("target_id", T.LongType()), T.StructField("d", T.DoubleType())])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                own = {n: np.asarray(batch.column(n)[r].values) for n in ("q_id", "q_v", "t_id", "t_v")}
                q, t = (own[f"{n}_v"].reshape(len(own[f"{n}_id"]), -1) for n in "qt")
                k = min(2, len(t))
                rough = (t**2).sum(axis=1) - 2 * (q @ t.T)
                # The products narrow the choice; distances are taken from the differences.
                wide = min(len(t), 8)
                at = np.argpartition(rough, wide - 1, axis=1)[:, :wide] if wide < len(t) else np.tile(np.arange(len(t)), (len(q), 1))
                d = np.sqrt(((q[:, None, :] - t[at]) ** 2).sum(axis=2))
                order = np.lexsort((own["t_id"][at], d), axis=1)[:, :k]
                at, d = np.take_along_axis(at, order, 1), np.take_along_axis(d, order, 1)
                columns = [pa.array([batch.column("grp")[r].as_py()] * at.size, batch.schema.field("grp").type), pa.array(np.repeat(own["q_id"], k)), pa.array(own["t_id"][at].ravel()), pa.array(d.ravel())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    met = q.join(t.drop("blocks"), ["grp", "block"]).drop("block").mapInArrow(nearest, schema)
    two = met.groupBy("grp", "query_id").agg(F.array_sort(F.collect_list(F.struct("d", "target_id"))).alias("near"))
    near = two.select("grp", "query_id", F.col("near")[0].alias("first"), F.get("near", F.lit(1)).alias("second"))
    return near.where(F.col("first.d") < ratio * F.col("second.d")).select("grp", "query_id", F.col("first.target_id").alias("target_id"), F.col("first.d").alias("distance"))


def fit_line(points: DataFrame, margin: float = 20.0) -> DataFrame:
    """Total least squares line of each group's points (grp, x, y): angle, center, and the ends, margin beyond the outermost
    points' projections. The angle follows from the second moments, so points are read once for it and once for the ends."""
    m = points.groupBy("grp").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.covar_pop("x", "y").alias("cov"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.count("*").alias("n"))
    m = m.withColumn("angle", 0.5 * F.atan2(2.0 * F.col("cov"), F.col("vx") - F.col("vy")))
    along = (F.col("x") - F.col("cx")) * F.cos("angle") + (F.col("y") - F.col("cy")) * F.sin("angle")
    ends = points.join(m, "grp").groupBy("grp").agg(F.min(along).alias("lo"), F.max(along).alias("hi"))
    at = m.join(ends, "grp")
    end = lambda c, trig, t: F.col(c) + trig("angle") * t
    lo, hi = F.col("lo") - margin, F.col("hi") + margin
    return at.select("grp", "n", F.degrees("angle").alias("angle_deg"), "cx", "cy", end("cx", F.cos, lo).alias("x0"), end("cy", F.sin, lo).alias("y0"), end("cx", F.cos, hi).alias("x1"), end("cy", F.sin, hi).alias("y1"))


def segment_candidates(segments: DataFrame, targets: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Segments (grp, seg, x0, y0, x1, y1) near a target side (grp, side, tx0, ty0, tx1, ty1): long enough, at a similar angle, and with
    one of five points within the band around the side."""
    at = segments.join(targets, "grp")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    turn = g.angle_difference(g.segment_angle(dx, dy), g.segment_angle(F.col("tx1") - F.col("tx0"), F.col("ty1") - F.col("ty0")))
    side = ((F.col("tx0"), F.col("ty0")), (F.col("tx1"), F.col("ty1")))

    def near(t: Column) -> Column:
        p = (F.rint(F.col("x0") + dx * t), F.rint(F.col("y0") + dy * t))
        return g.point_segment_distance(p, *side) <= s.hough_band_px

    long_enough = g.norm((dx, dy)) >= s.hough_min_length_px
    return at.where(long_enough & (turn <= s.hough_angle_deg) & F.exists(F.array(*(F.lit(k) for k in (0.0, 1.0, 0.5, 0.75, 0.25))), near))


def side_lines(segments: DataFrame, targets: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """The line through the ends of all candidates of each target side (see segment_candidates; one side a grp): n_segments, x0, y0, x1, y1 in the
    side's direction, its length, its turn from the side and its middle's distance from the side's line. A side without candidates
    has no row."""
    kept = segment_candidates(segments, targets, s).select("grp", F.explode(F.array(*(F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (0, 1)))).alias("p"))
    at = fit_line(kept.select("grp", "p.x", "p.y")).drop("cx", "cy", "angle_deg").join(targets, "grp")
    back = (F.col("x1") - F.col("x0")) * (F.col("tx1") - F.col("tx0")) + (F.col("y1") - F.col("y0")) * (F.col("ty1") - F.col("ty0")) < 0
    turned = {f"{c}{k}": F.when(back, F.col(f"{c}{1 - k}")).otherwise(F.col(f"{c}{k}")) for c in "xy" for k in (0, 1)}
    at = at.withColumns(turned)
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    turn = g.angle_difference(g.segment_angle(dx, dy), g.segment_angle(F.col("tx1") - F.col("tx0"), F.col("ty1") - F.col("ty0")))
    away = g.point_line_distance(((F.col("x0") + F.col("x1")) * 0.5, (F.col("y0") + F.col("y1")) * 0.5), (F.col("tx0"), F.col("ty0")), (F.col("tx1"), F.col("ty1")))
    return at.select("grp", (F.col("n") / 2).cast("long").alias("n_segments"), "x0", "y0", "x1", "y1", g.norm((dx, dy)).alias("length"), turn.alias("turn"), away.alias("distance"))


def inward_sides(wall: list[g.Point]) -> list[g.Point]:
    """(a, b, c) of each side of a convex wall (corners in order): ax + by + c is the distance to it, positive inside. Null for a side
    without a length."""
    middle = tuple(sum(x[1:], x[0]) / float(len(wall)) for x in zip(*wall, strict=True))
    out = []
    for p, q in zip(wall, [*wall[1:], wall[0]], strict=True):
        n = (-(q[1] - p[1]), q[0] - p[0])
        length = g.norm(n) * F.when(g.dot(n, g.minus(middle, p)) < 0, -1.0).otherwise(1.0)
        out.append(tuple(F.try_divide(v, length) for v in (*n, -(n[0] * p[0] + n[1] * p[1]))))
    return out


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """With columns that are computed once, not written into every expression that uses them."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


#: What a fit says.
FIT = ("scale", "tx", "ty", "center_x", "center_y", "min_dist", "center_dist", "touching")
#: Parts of scale, of distance from the center and of distance from the sides within which placements are equal, and how far above
#: the inset the least distance from a side still touches it.
EQUAL, TOUCHING = 1e9, 0.5


#: What is known of a pair's best placement, and pairs that are placed at once.
PLACED, PAIRS = ("scale", "away", "x", "y", "near"), 512


def _placed(given: list[str], s: Settings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Takes rows with the wall's size, the largest scale, and for each side its direction, how far the shape reaches towards it and the room
    there is; gives the others of their columns and PLACED of the best of all placements."""

    def best(own: dict[str, np.ndarray]) -> list[np.ndarray]:
        k = s.fit_shift_steps
        n = np.arange(k * k)
        x, y = (own[side] * s.fit_shift * (2.0 * m / float(k - 1) - 1.0) for side, m in (("w", n // k), ("h", n % k)))
        d = [own[f"_r{m}"] + own[f"_n{m}a"] * x + own[f"_n{m}b"] * y for m in range(4)]
        # The distance to each side is linear in the scale, so the largest scale is the least ratio over the sides.
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = [np.where(own[f"_m{m}"] > 0, d[m] / own[f"_m{m}"], own["most"]) for m in range(4)]
        scale = np.where(np.fmin.reduce(d) >= 0, np.fmin(own["most"], np.fmin.reduce(ratios)), 0.0)
        away = np.sqrt(x * x + y * y) / np.maximum(np.sqrt(own["w"] * own["w"] + own["h"] * own["h"]), 1.0)
        near = np.fmin.reduce([d[m] - scale * own[f"_m{m}"] for m in range(4)]) + s.fit_inset_px
        left = np.ones(scale.shape, bool)
        for v in (np.rint(scale * EQUAL), -np.rint(away * EQUAL), -np.rint(near * EQUAL)):
            v = np.where(left, v, -np.inf)
            left &= v == v.max(axis=1, keepdims=True)
        at = left.argmax(axis=1)[:, None]
        return [np.take_along_axis(v, at, 1).ravel() for v in (scale, away, x, y, near)]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, PAIRS) for b in batches for k in range(0, b.num_rows, PAIRS)):
            found = best({c: batch.column(c).to_numpy(zero_copy_only=False)[:, None] for c in given})
            kept = [c for c in batch.schema.names if c not in given]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, found)], [*kept, *PLACED])

    return placed


def fit_quads(pairs: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """For pairs of a mask's quad and its convex wall's quad (id, seg, wall: arrays of four structs x, y), the scale and shift that make the
    mask's quad as large as it can be within the wall's: id, scale, tx, ty, center_x and center_y (of the fitted quad), min_dist (from
    the wall's sides, negative outside), center_dist (of the centers, as a part of the wall's diagonal) and touching.

    All placements of the center on a grid are tried. Of equal scales the one nearest to the wall's center wins, then the one with
    the least min_dist, then the first. Where a corner is null or not finite, or a side of the wall has no length, all are null."""
    name = {q: [(f"_{q}x{k}", f"_{q}y{k}") for k in range(4)] for q in ("seg", "wall")}
    at = _once(pairs.select("id", "seg", "wall"), {n: F.get(q, F.lit(k))[c] for q in name for k in range(4) for n, c in zip(name[q][k], "xy", strict=True)})
    seg, wall = ([(F.col(x), F.col(y)) for x, y in name[q]] for q in ("seg", "wall"))
    odd = F.exists(F.array(*(c for q in (seg, wall) for p in q for c in p)), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    flat = [g.norm(g.minus(q, p)) == 0 for p, q in zip(wall, [*wall[1:], wall[0]], strict=True)]
    good = ~odd & ~(flat[0] | flat[1] | flat[2] | flat[3])
    unfit = at.where(~F.coalesce(good, F.lit(False))).select("id", *(F.lit(None).cast("boolean" if n == "touching" else "double").alias(n) for n in FIT))
    at = at.where(good)
    mean = lambda q: tuple(sum(x[1:], x[0]) / 4.0 for x in zip(*q, strict=True))
    area = lambda q: F.abs(sum((a[0] * b[1] - b[0] * a[1] for a, b in zip(q, [*q[1:], q[0]], strict=True)), F.lit(0.0))) / 2.0
    sides = {f"_n{k}{c}": x for k, line in enumerate(inward_sides(wall)) for c, x in zip("abc", line, strict=True)}
    size = [F.greatest(F.greatest(*(p[k] for p in wall)) - F.least(*(p[k] for p in wall)), F.lit(1.0)) for k in (0, 1)]
    guess = F.greatest(F.lit(0.05), F.sqrt(F.greatest(area(wall), F.lit(1e-6)) / F.greatest(area(seg), F.lit(1e-6))))
    at = _once(at, dict(zip(("scx", "scy", "wcx", "wcy", "w", "h", "guess"), (*mean(seg), *mean(wall), *size, guess), strict=True)) | sides)
    # An upper bound grows from the guess until it is past the largest scale that is asked for, in at most 20 steps.
    grown = F.least(F.lit(20.0), F.greatest(F.lit(0.0), F.ceil(F.log(F.lit(s.fit_max_scale) / F.col("guess")) / F.log(F.lit(s.fit_growth)))))
    # How far the shape reaches towards each side, for a scale of one: the distance to a side falls by that much.
    shape = [(x - F.col("scx"), y - F.col("scy")) for x, y in seg]
    lines = [tuple(F.col(f"_n{n}{c}") for c in "abc") for n in range(4)]
    reach = {f"_m{n}": F.greatest(*(-g.dot(line[:2], p) for p in shape)) for n, line in enumerate(lines)}
    room = {f"_r{n}": line[0] * F.col("wcx") + line[1] * F.col("wcy") + line[2] - s.fit_inset_px for n, line in enumerate(lines)}
    at = _once(at, {"most": F.col("guess") * F.pow(F.lit(s.fit_growth), grown)} | reach | room)
    corners = [c for p in name["wall"] for c in p]
    given = ["w", "h", "most", *(f"_{c}{n}" for n in range(4) for c in "mr"), *(f"_n{n}{c}" for n in range(4) for c in "ab")]
    # A pair's placements are compared where the pair is, so none of them is a row. Repeated pairs count once.
    at = spread(at.select("id", "scx", "scy", "wcx", "wcy", *corners, *given).distinct(), "id")
    best = at.mapInArrow(_placed(given, s), T.StructType([*at.drop(*given).schema, *(T.StructField(n, T.DoubleType()) for n in PLACED)]))
    best = _once(best, {"center_x": F.col("wcx") + F.col("x"), "center_y": F.col("wcy") + F.col("y")})
    # A quad that doesn't fit anywhere is a point, which may lie outside: its distance is from the nearest side itself.
    outside = -F.least(*(g.point_segment_distance((F.col("center_x"), F.col("center_y")), p, q) for p, q in zip(wall, [*wall[1:], wall[0]], strict=True)))
    best = _once(best, {"min_dist": F.when(F.col("near") < 0, outside).otherwise(F.col("near"))})
    to = lambda c: F.col(f"center_{c}") - F.col("scale") * F.col(f"sc{c}")
    fits = best.select("id", "scale", to("x").alias("tx"), to("y").alias("ty"), "center_x", "center_y", "min_dist", F.col("away").alias("center_dist"), (F.col("min_dist") <= s.fit_inset_px + TOUCHING).alias("touching"))
    return fits.unionByName(unfit)


def chains(links: DataFrame, ref: int) -> DataFrame:
    """Homographies of a group's images to image ref: links (grp, k, h: nine values that take image k to image k + 1, null if
    there is none) become grp, image, h. Images before ref have the product of the links up to it, those after it the inverse of
    the product of the links from it (null if its determinant is below 1e-12); past a missing link there is none."""
    own = links.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("k", "h"))).alias("ls"))
    schema = T.StructType([own.schema["grp"], T.StructField("image", T.IntegerType()), T.StructField("h", T.ArrayType(T.DoubleType()))])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = batch.column("ls").flatten().field("h")
            n = pc.list_value_length(batch.column("ls")).to_numpy()
            whole = pc.fill_null(pc.greater_equal(pc.list_value_length(links), 9), False)
            cells = [pc.list_element(links.filter(whole), k) for k in range(9)]
            known = whole.to_numpy(zero_copy_only=False).copy()
            values = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in cells], axis=1)
            h, missing = np.zeros((len(links), 9)), np.logical_or.reduce([c.is_null().to_numpy(zero_copy_only=False) for c in cells])
            h[known] = values
            known[known] = ~missing
            found, there = _running(h.reshape(-1, 3, 3), known, n, ref)
            images = n + 1
            image = np.arange(len(found)) - np.repeat(np.cumsum(images) - images, images)
            m = list(found.reshape(-1, 9).T)
            det = m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])
            after = image > ref
            there &= ~(after & (np.abs(det) < 1e-12))
            with np.errstate(divide="ignore", invalid="ignore"):
                inverse = np.stack([x / det for x in g.adjugate(m)], axis=1)
            given = np.where(after[:, None], inverse, found.reshape(-1, 9))[there]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(there * 9)).astype(np.int32)), pa.array(given.ravel()), mask=pa.array(~there))
            yield pa.RecordBatch.from_arrays([batch.column("grp").take(pa.array(np.repeat(np.arange(len(n)), images))), pa.array(image.astype(np.int32)), lists], schema.names)

    return own.mapInArrow(chained, schema)


def _running(h: np.ndarray, known: np.ndarray, n: np.ndarray, ref: int) -> tuple[np.ndarray, np.ndarray]:
    """For groups of n links each (h) the products from image ref to each image after it and to it from each before, and whether all links between are
    known. Each is one product more than its neighbour's; groups are worked on side by side."""
    order = np.argsort(-n, kind="stable")
    link, falling = (np.cumsum(n) - n)[order], -n[order]
    first = link + order
    out, there = np.zeros((len(h) + len(n), 3, 3)), np.zeros(len(h) + len(n), bool)
    start = first + np.minimum(ref, -falling)
    out[start], there[start] = np.eye(3), True
    times = lambda a, b: a[:, :, :1] * b[:, :1] + a[:, :, 1:2] * b[:, 1:2] + a[:, :, 2:] * b[:, 2:]
    most = int(n.max(initial=0))
    for i in [*range(ref, most), *range(min(ref, most) - 1, -1, -1)]:
        few = int(np.searchsorted(falling, -i))
        at, of = first[:few] + i, link[:few] + i
        since, to = (at, at + 1) if i >= ref else (at + 1, at)
        out[to], there[to] = times(h[of], out[since]), there[since] & known[of]
    return out, there


def clockwise(points: Column) -> Column:
    """Corners (an array of structs x, y) in order of their angle around their mean, from the one with the least x + y."""
    n = F.size(points).cast("double")
    mean = lambda c: F.aggregate(points, F.lit(0.0), lambda s, p: s + p[c]) / n
    cx, cy = mean("x"), mean("y")
    turned = F.array_sort(F.transform(points, lambda p: F.struct(F.atan2(p["y"] - cy, p["x"] - cx).alias("a"), p["x"].alias("x"), p["y"].alias("y"))))
    first = F.array_min(F.transform(turned, lambda p, i: F.struct((p["x"] + p["y"]).alias("s"), i.alias("i"))))["i"]
    rotated = F.concat(F.slice(turned, first + 1, F.size(turned)), F.slice(turned, F.lit(1), first))
    return F.transform(rotated, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))

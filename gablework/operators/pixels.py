"""Masks and images as pixel relations (img, x, y, ...): set algebra, statistics, morphology, scoring, blending."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.config import Settings
from gablework.functions import geometry as g
from gablework.operators import graphs

PIXEL = ["img", "x", "y"]


def mask_stats(mask: DataFrame) -> DataFrame:
    """Area, centroid and bounding box of each image's mask."""
    agg = [F.count("*").alias("area"), F.avg("x").alias("cx"), F.avg("y").alias("cy")]
    agg += [f(c).alias(f"{c}_{n}") for n, f in (("min", F.min), ("max", F.max)) for c in ("x", "y")]
    return mask.groupBy("img").agg(*agg)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(PIXEL).distinct().join(b.select(PIXEL), PIXEL, "left_anti")


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(PIXEL).distinct().join(b.select(PIXEL), PIXEL, "left_semi")


def union(*masks: DataFrame) -> DataFrame:
    out = masks[0].select(PIXEL)
    for m in masks[1:]:
        out = out.union(m.select(PIXEL))
    return out.distinct()


def _rows(radius: int, shape: str) -> dict[int, int]:
    """Half width of each row of a structuring element."""
    return {dy: radius if shape == "square" else round((radius * radius - dy * dy) ** 0.5) for dy in range(-radius, radius + 1)}


def _grown(rows: DataFrame, radius: int, width: int, height: int, shape: str) -> DataFrame:
    """Runs (img, y, x0, x1) of what a structuring element around each pixel of runs covers within the image. A run gives a span for each of the
    element's rows; spans that overlap become one."""
    steps = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(half).alias("half")) for dy, half in _rows(radius, shape).items()))
    at = rows.select("img", "y", "x0", "x1", F.inline(steps))
    at = at.select("img", (F.col("y") + F.col("dy")).alias("y"), F.greatest(F.col("x0") - F.col("half"), F.lit(0)).alias("x0"), F.least(F.col("x1") + F.col("half"), F.lit(width - 1)).alias("x1"))
    row = Window.partitionBy("img", "y").orderBy("x0", "x1")
    at = at.where(F.col("y").between(0, height - 1) & (F.col("x0") <= F.col("x1"))).distinct()
    before = F.max("x1").over(row.rowsBetween(Window.unboundedPreceding, -1))
    at = at.withColumn("_new", F.when(F.col("x0") <= before + 1, 0).otherwise(1)).withColumn("_part", F.sum("_new").over(row))
    return at.groupBy("img", "y", "_part").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("_part")


def _as_in(mask: DataFrame, rows: DataFrame) -> DataFrame:
    """Pixels of runs, in a mask's types."""
    kinds = dict(mask.dtypes)
    at = rows.select("img", F.explode(F.sequence("x0", "x1")).alias("x"), "y")
    return at.select(*(F.col(c).cast(kinds[c]).alias(c) for c in PIXEL))


def dilate(mask: DataFrame, radius: int, width: int, height: int, shape: str = "square") -> DataFrame:
    """By a square of side 2 * radius + 1, or the ellipse within it, within the image."""
    return _as_in(mask, _grown(graphs.runs(mask.where(F.col("x").isNotNull() & F.col("y").isNotNull())), radius, width, height, shape))


def erode(mask: DataFrame, radius: int, width: int, height: int, shape: str = "square") -> DataFrame:
    """Pixels whose whole square (or ellipse), as far as it lies within the image, is in the mask: those that the dilated background
    doesn't reach."""
    inside = mask.where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1))
    gone = _grown(graphs.gaps(graphs.runs(inside), width, height), radius, width, height, shape)
    return difference(inside, _as_in(mask, gone))


def opened(mask: DataFrame, radius: int, width: int, height: int, shape: str = "square") -> DataFrame:
    return dilate(erode(mask, radius, width, height, shape), radius, width, height, shape)


def closed(mask: DataFrame, radius: int, width: int, height: int, shape: str = "square") -> DataFrame:
    return erode(dilate(mask, radius, width, height, shape), radius, width, height, shape)


def cleaned(mask: DataFrame, width: int, height: int, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """A selected mask closed, opened (both by ellipses), without small components and with its holes filled, in this order."""
    if s.mask_close_px > 0:
        mask = closed(mask, s.mask_close_px, width, height, "ellipse")
    if s.mask_open_px > 0:
        mask = opened(mask, s.mask_open_px, width, height, "ellipse")
    return graphs.filled_holes(graphs.without_small(graphs.pixel_components(mask), s.min_component_px), width, height)


#: Length of a step to the side and across, of distances in a mask.
STEP, ACROSS = 0.955, 1.3693


def distance_weights(mask: DataFrame, width: int, height: int) -> DataFrame:
    """Weights (img, x, y, w) of a mask's pixels: their distance from the background by steps of STEP and ACROSS over the image's greatest,
    at least 0.001. An image that is all mask has 1 everywhere. An image is measured by one task, in two sweeps over its rows."""

    def sweep(d: np.ndarray) -> np.ndarray:
        ramp = STEP * np.arange(d.shape[1])
        for y in range(len(d)):
            if y:
                up = np.pad(d[y - 1], 1, constant_values=np.inf)
                d[y] = np.minimum(d[y], np.minimum(up[1:-1] + STEP, np.minimum(up[:-2], up[2:]) + ACROSS))
            d[y] = np.minimum(d[y], np.minimum.accumulate(d[y] - ramp) + ramp)
            d[y] = np.minimum(d[y], (np.minimum.accumulate(d[y][::-1] - ramp) + ramp)[::-1])
        return d

    def weigh(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows["x"].to_numpy(), rows["y"].to_numpy()
        d = np.zeros((height, width))
        d[y, x] = np.inf
        d = sweep(sweep(d)[::-1])[::-1]
        near = d[y, x]
        w = np.ones(len(near)) if np.isinf(near).all() else np.clip(near / near.max(), 1e-3, 1.0)
        return rows.assign(w=w)

    at = mask.select("img", F.col("x").cast("long"), F.col("y").cast("long")).where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1)).distinct()
    return at.groupBy("img").applyInPandas(weigh, T.StructType([*at.schema, T.StructField("w", T.DoubleType())]))


def score_instances(instances: DataFrame, roof: DataFrame, wall: DataFrame, width: int, height: int) -> DataFrame:
    """Soft scores of facade instances (img, instance, x, y) without the roof's pixels against the wall's: img, instance, area, inside,
    outside, distance, score. Instances without a pixel left are not scored. In an image whose wall has no pixel an instance's score is
    its area, so that the largest is the best."""
    left = instances.select("img", "instance", "x", "y").distinct().join(roof.select(PIXEL), PIXEL, "left_anti")
    on_wall = wall.select(PIXEL).distinct()
    walls = on_wall.groupBy("img").agg(F.count("*").alias("wall_area"), F.avg("x").alias("wx"), F.avg("y").alias("wy"))
    marked = left.join(on_wall.withColumn("w", F.lit(1)), PIXEL, "left")
    sums = marked.groupBy("img", "instance").agg(F.count("*").alias("area"), F.count("w").alias("inside"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    diagonal = float((width * width + height * height) ** 0.5)
    at = sums.join(walls, "img", "left").withColumn("outside", F.when(F.col("wall_area").isNull(), 0).otherwise(F.col("area") - F.col("inside")))
    at = at.withColumn("distance", g.norm((F.col("cx") - F.col("wx"), F.col("cy") - F.col("wy"))) / diagonal)
    score = g.facade_score(F.col("area"), F.col("inside"), F.col("outside"), F.col("wall_area"), F.col("distance"))
    score = F.when(F.col("wall_area").isNull(), F.col("area").cast("double")).otherwise(score)
    return at.select("img", "instance", "area", "inside", "outside", F.coalesce("distance", F.lit(0.0)).alias("distance"), score.alias("score"))


def best_instance(scored: DataFrame) -> DataFrame:
    """The best one of each image; of equal ones, the first."""
    return scored.groupBy("img").agg(F.max(F.struct("score", (-F.col("instance")).alias("k"))).alias("b")).select("img", (-F.col("b.k")).alias("instance"), F.col("b.score").alias("score"))


def median_fill(pixels: DataFrame, default: int = 180) -> DataFrame:
    """Median value of each image's valid pixels (img, v, valid), cut to an integer; default without any."""
    return pixels.groupBy("img").agg(F.coalesce(F.floor(F.percentile(F.when(F.col("valid"), F.col("v")), F.lit(0.5))), F.lit(default)).cast("long").alias("fill"))


def exposure_gain(base: DataFrame, added: DataFrame, least: int = 500) -> DataFrame:
    """Gain that brings an image to the base's brightness where both have pixels (img, x, y, v): img, overlap, gain (1 if they
    overlap too little or the image is black)."""
    both = base.select(*PIXEL, F.col("v").alias("a")).join(added.select(*PIXEL, F.col("v").alias("b")), PIXEL)
    sums = both.groupBy("img").agg(F.count("*").alias("overlap"), F.avg("a").alias("a"), F.avg("b").alias("b"))
    gain = F.when((F.col("overlap") < least) | (F.col("b") < 1e-6), 1.0).otherwise(g.clip(F.col("a") / F.col("b"), 0.6, 1.6))
    return sums.select("img", "overlap", gain.alias("gain"))


def weighted_blend(layers: DataFrame) -> DataFrame:
    """Layers (img, x, y, v, w) blended by weight, 0 where the weights are, cut to 0..255."""
    sums = layers.groupBy(PIXEL).agg(F.sum(F.col("v") * F.col("w")).alias("s"), F.sum("w").alias("w"))
    value = F.when(F.col("w") > 0, F.col("s") / F.col("w")).otherwise(0.0)
    return sums.select(*PIXEL, F.floor(g.clip(value, 0.0, 255.0)).cast("long").alias("v"))


def hole_pixels(wall: DataFrame, opaque: DataFrame) -> DataFrame:
    """Pixels of the wall that have no color yet."""
    return difference(wall, opaque)


def overlap_ratio(line: DataFrame, edges: DataFrame) -> DataFrame:
    """Share of a line's pixels that lie on edges."""
    at = line.select(PIXEL).distinct().join(edges.select(PIXEL).distinct().withColumn("e", F.lit(1)), PIXEL, "left")
    return at.groupBy("img").agg((F.count("e") / F.greatest(F.count("*"), F.lit(1))).alias("ratio"))

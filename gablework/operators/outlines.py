"""Outlines of masks: hulls of their components, least rectangles, and the quad of an image's mask."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.operators import graphs

#: Pixels of the least component that counts.
LEAST_PIXELS = 500
#: Parts of a hull's length by which it may be simplified: the least, the most, and how many are tried.
TOLERANCES = (0.005, 0.08, 60)


def row_ends(runs: DataFrame, *keys: str) -> DataFrame:
    """The first and last pixel of each row of each group (keys): keys, x, y. No other pixel can be a corner of the hull, and the ends are
    least and greatest values, so they are summed up before anything is sent."""
    ends = runs.groupBy(*keys, "y").agg(F.min("x0").cast("double").alias("a"), F.max("x1").cast("double").alias("b"))
    return ends.select(*keys, F.explode(F.array_distinct(F.array("a", "b"))).alias("x"), F.col("y").cast("double").alias("y"))


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull in order of their angle, without those on a side."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points
    chains = []
    for way in (points, points[::-1]):
        chain: list[np.ndarray] = []
        for p in way:
            while len(chain) > 1 and _turn(chain[-2], chain[-1], p) <= 0:
                chain.pop()
            chain.append(p)
        chains += chain[:-1]
    return np.array(chains)


def _turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def least_rectangle(corners: np.ndarray) -> np.ndarray:
    """The corners of the smallest rectangle around a hull: one of its sides lies along one of the hull's. Of equal ones the first."""
    best = None
    for a, b in zip(corners, np.roll(corners, -1, axis=0), strict=True):
        length = np.hypot(*(b - a))
        if not length:
            continue
        along = (b - a) / length
        axes = np.array([along, [-along[1], along[0]]])
        placed = (corners - corners[0]) @ axes.T
        low, high = placed.min(axis=0), placed.max(axis=0)
        size = float(np.prod(high - low))
        if best is None or size < best[0] - 1e-9:
            box = np.array([low, [high[0], low[1]], high, [low[0], high[1]]])
            best = size, box @ axes + corners[0]
    return np.repeat(corners[:1], 4, axis=0) if best is None else best[1]


def _tolerances(corners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A closed chain, and for each corner the tolerance from which on it goes: halved at two corners far from each other, then each half at
    its farthest corner. Where a half is cut doesn't depend on the tolerance, and a corner stays no longer than the one that cut its half."""
    first = int(np.argmax(np.hypot(*(corners - corners[0]).T)))
    chain = np.roll(corners, -first, axis=0)
    second = int(np.argmax(np.hypot(*(chain - chain[0]).T)))
    closed, until = np.concatenate((chain, chain[:1])), np.zeros(len(chain))
    until[[0, second]] = np.inf
    todo = [(0, second, np.inf), (second, len(chain), np.inf)]
    while todo:
        lo, hi, most = todo.pop()
        if hi - lo < 2:
            continue
        a, b = closed[lo], closed[hi]
        inner, side = closed[lo + 1 : hi] - a, b - a
        length = np.hypot(*side)
        away = np.abs(inner[:, 0] * side[1] - inner[:, 1] * side[0]) / length if length else np.hypot(*inner.T)
        k = int(np.argmax(away))
        most = until[lo + 1 + k] = min(most, away[k])
        todo += [(lo, lo + 1 + k, most), (lo + 1 + k, hi, most)]
    return chain, until


def simplified(corners: np.ndarray, tolerance: float) -> np.ndarray:
    """A closed chain without the corners that are within tolerance of what is left."""
    chain, until = _tolerances(corners)
    return chain[until > tolerance]


def quad(points: np.ndarray) -> np.ndarray | None:
    """Four corners around points (at least four): the hull, simplified by the first of the tolerances that leaves four corners, or else
    the least rectangle; in order of the angle around their mean, from the one with the least x + y."""
    if len(points) < 4:
        return None
    corners, found = hull(points), None
    if len(corners) >= 4:
        around = np.hypot(*(np.roll(corners, -1, axis=0) - corners).T).sum()
        chain, until = _tolerances(corners)
        left = until > np.linspace(*TOLERANCES)[:, None] * around
        fit = np.flatnonzero(left.sum(axis=1) == 4)
        found = chain[left[fit[0]]] if len(fit) else None
    if found is None:
        found = least_rectangle(corners)
    turn = np.arctan2(*(found - found.mean(axis=0)).T[::-1])
    found = found[np.argsort(turn, kind="stable")]
    return np.roll(found, -int(np.argmin(found.sum(axis=1))), axis=0)


_SCHEMA = ", ".join(f"x{k} double, y{k} double" for k in range(4))
_NAMES = [f"{c}{k}" for k in range(4) for c in "xy"]


def _fitted(keys: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        found = quad(rows[["x", "y"]].to_numpy())
        if found is None:
            return rows[keys].head(0).assign(**dict.fromkeys(_NAMES, 0.0))
        return rows[keys].head(1).assign(**dict(zip(_NAMES, found.ravel(), strict=True)))

    return fit


def chunk_quads(mask: DataFrame, least: int = LEAST_PIXELS) -> DataFrame:
    """The quad of each component of at least so many pixels (and four row ends): img, label (y and x of its first pixel), area, x0 .. y3.
    A task sees the ends of a component's rows, not its pixels."""
    found = graphs.run_components(graphs.runs(mask)).select("img", "y", "x0", "x1", F.shiftleft("label.y", 20).alias("_y"), F.col("label.x0").alias("_x"))
    found = found.withColumn("label", F.col("_y") + F.col("_x")).drop("_x", "_y")
    big = found.groupBy("img", "label").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("area")).where(F.col("area") >= least)
    ends = row_ends(found, "img", "label").join(big.select("img", "label"), ["img", "label"], "left_semi")
    kind = dict(mask.dtypes)["img"]
    quads = ends.groupBy("img", "label").applyInPandas(_fitted(["img", "label"]), f"img {kind}, label long, {_SCHEMA}")
    return quads.join(big, ["img", "label"]).select("img", "label", "area", *_NAMES)


def mask_quads(mask: DataFrame, least: int = LEAST_PIXELS) -> DataFrame:
    """The quad of each image's mask (img, x, y): img, chunks (components that have one), quad (an array of four structs x, y, clockwise on an
    image). With one component it is its quad, with several the quad around all their corners. Images without a component of least pixels
    have no row; repeated pixels count once."""
    chunks = chunk_quads(mask, least)
    point = lambda k: F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    of = chunks.groupBy("img").agg(F.count("*").alias("chunks"), F.max(F.struct("label", F.array(*map(point, range(4))).alias("quad"))).alias("one"))
    several = chunks.join(of.where("chunks > 1").select("img"), "img", "left_semi").select("img", F.inline(F.array(*map(point, range(4)))))
    kind = dict(mask.dtypes)["img"]
    around = several.groupBy("img").applyInPandas(_fitted(["img"]), f"img {kind}, {_SCHEMA}").select("img", F.array(*map(point, range(4))).alias("around"))
    return of.join(around, "img", "left").select("img", "chunks", F.coalesce("around", "one.quad").alias("quad"))


def hulls(mask: DataFrame) -> DataFrame:
    """The convex hull of each image's mask: img, corners (number), area, least_rectangle (its area). A mask on one line has two corners
    and no area."""
    kind = dict(mask.dtypes)["img"]

    def measured(rows: pd.DataFrame) -> pd.DataFrame:
        c = hull(rows[["x", "y"]].to_numpy())
        box = least_rectangle(c)
        areas = [abs(np.sum(q[:, 0] * np.roll(q[:, 1], -1) - q[:, 1] * np.roll(q[:, 0], -1))) / 2 for q in (c, box)]
        return rows[["img"]].head(1).assign(corners=len(c), area=areas[0], least_rectangle=areas[1])

    return row_ends(graphs.runs(mask), "img").groupBy("img").applyInPandas(measured, f"img {kind}, corners long, area double, least_rectangle double")

"""Straight segments in edge pixels, by votes for lines."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Angles of a half turn, votes that a line needs at least, and the length and gaps of its segments, in pixels.
ANGLES, LEAST_VOTES, LEAST_LENGTH, MOST_GAP = 180, 50, 120.0, 20.0
#: How far from a line its pixels lie at most: lines between two angles leave the nearer one by about that at their ends.
REACH = 1.0


def directions(angles: int = ANGLES) -> list[tuple[float, float]]:
    """Cosine and sine of each angle, to nine digits, so that places of pixels fall on the same side of a bound everywhere."""
    return [(round(math.cos(math.pi * k / angles), 9), round(math.sin(math.pi * k / angles), 9)) for k in range(angles)]


def _table(angles: int) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("angle"), F.lit(c).alias("c"), F.lit(s).alias("s")) for k, (c, s) in enumerate(directions(angles))))


def line_votes(edges: DataFrame, angles: int = ANGLES) -> DataFrame:
    """How many edge pixels (img, x, y) each line goes through: img, angle (of its normal, in steps), rho (its distance from the origin, rounded,
    halves to even), votes. Votes are added up where the pixels are before they are sent."""
    at = edges.select("img", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).distinct().select("img", "x", "y", F.inline(_table(angles)))
    return at.groupBy("img", "angle", F.rint(F.col("x") * F.col("c") + F.col("y") * F.col("s")).cast("long").alias("rho")).agg(F.count("*").alias("votes"))


def peaks(votes: DataFrame, angles: int = ANGLES, least: int = LEAST_VOTES) -> DataFrame:
    """Lines with at least so many votes and more than all lines next to them (by one step of angle and one of rho; the last angle is next
    to the first one, with rho turned around). Of equal neighbours the one of the lesser angle, then rho stays."""
    strong = votes.where(F.col("votes") >= least)
    steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(r).alias("r")) for a in (-1, 0, 1) for r in (-1, 0, 1) if a or r))
    near = strong.select("*", F.inline(steps)).withColumn("to", F.col("angle") + F.col("a"))
    turned = (F.col("to") < 0) | (F.col("to") >= angles)
    near = near.select("img", F.pmod("to", F.lit(angles)).alias("angle"), (F.when(turned, -F.col("rho")).otherwise(F.col("rho")) + F.col("r")).alias("rho"), F.struct("votes", (-F.col("angle")).alias("a"), (-F.col("rho")).alias("r")).alias("of"))
    best = near.groupBy("img", "angle", "rho").agg(F.max("of").alias("best"))
    own = F.struct("votes", (-F.col("angle")).alias("a"), (-F.col("rho")).alias("r"))
    return strong.join(best, ["img", "angle", "rho"], "left").where(F.col("best").isNull() | (own > F.col("best"))).select("img", "angle", "rho", "votes")


def segments(edges: DataFrame, angles: int = ANGLES, least_votes: int = LEAST_VOTES, least_length: float = LEAST_LENGTH, most_gap: float = MOST_GAP) -> DataFrame:
    """Segments of edge pixels (img, x, y) on the lines that most go through: img, angle, rho, x0, y0, x1, y1, pixels. A line's pixels (those
    within REACH of it) are cut where the gap along it is wider than most_gap; parts shorter than least_length go. A pixel may lie on
    segments of several lines. The result depends on no order and no chance; repeated pixels count once."""
    lines = peaks(line_votes(edges, angles), angles, least_votes).withColumn("d", F.get(_table(angles), F.col("angle")))
    at = edges.select("img", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).distinct().join(lines, "img")
    at = at.where(F.abs(F.col("x") * F.col("d.c") + F.col("y") * F.col("d.s") - F.col("rho")) <= REACH).withColumn("t", F.col("y") * F.col("d.c") - F.col("x") * F.col("d.s"))
    along = Window.partitionBy("img", "angle", "rho").orderBy("t", "x", "y")
    at = at.withColumn("cut", F.coalesce((F.col("t") - F.lag("t").over(along) > most_gap).cast("int"), F.lit(0))).withColumn("part", F.sum("cut").over(along))
    end = F.struct("t", "x", "y")
    found = at.groupBy("img", "angle", "rho", "part").agg(F.min(end).alias("a"), F.max(end).alias("b"), F.count("*").alias("pixels"))
    return found.where(F.col("b.t") - F.col("a.t") >= least_length).select("img", "angle", "rho", F.col("a.x").alias("x0"), F.col("a.y").alias("y0"), F.col("b.x").alias("x1"), F.col("b.y").alias("y1"), "pixels")

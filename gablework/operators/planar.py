"""Planar line work: faces of a graph of straight edges, and their holes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.functions import facets
from gablework.operators import polygons
from gablework.operators.lineage import kept

#: A group of up to GROUP lines is worked on where its lines meet, in tasks of about ROWS lines.
GROUP, ROWS = 20_000, 200_000


def _twin(h: Column) -> Column:
    return h.bitwiseXOR(F.lit(1).cast("long"))


def _finite(lines: DataFrame) -> DataFrame:
    """Lines without those that have a null or non-finite end, or no length."""
    ends = {c: F.col(c).cast("double") + 0.0 for c in ("x1", "y1", "x2", "y2")}
    good = lines.select("grp", *(v.alias(c) for c, v in ends.items()))
    return good.where(" and ".join(f"abs({c}) < double('infinity')" for c in ends)).where("x1 <> x2 or y1 <> y2")


def half_edges(lines: DataFrame) -> DataFrame:
    """Each distinct edge (grp, x1, y1, x2, y2; in either direction) in both directions: h, grp, p, q (structs x, y). The two halves of an edge
    are the numbers 2 k and 2 k + 1. Edges with a null or non-finite end, or without a length, are left out."""
    p, q = (F.struct(*(F.col(f"{c}{k}").alias(c) for c in "xy")) for k in (1, 2))
    edges = _finite(lines).select("grp", F.least(p, q).alias("a"), F.greatest(p, q).alias("b")).distinct()
    edges = kept(edges.withColumn("k", F.monotonically_increasing_id() * 2))
    both = F.array(F.struct(F.col("k").alias("h"), F.col("a").alias("p"), F.col("b").alias("q")), F.struct((F.col("k") + 1).alias("h"), F.col("b").alias("p"), F.col("a").alias("q")))
    return edges.select("grp", F.inline(both)).select("h", "grp", "p", "q")


def successors(halves: DataFrame) -> DataFrame:
    """Half-edges with next, the one that follows along the face on their left: at its end, the next edge in clockwise order."""
    around = Window.partitionBy("grp", "p").orderBy(F.atan2(F.col("q.y") - F.col("p.y"), F.col("q.x") - F.col("p.x")), "h")
    before = F.coalesce(F.lag("h").over(around), F.last("h").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return halves.select("grp", "p", "q", "h", before.alias("next")).select(_twin(F.col("h")).alias("h"), "grp", F.col("q").alias("p"), F.col("p").alias("q"), "next")


def cycles(steps: DataFrame) -> DataFrame:
    """For a permutation (h, next): h, ring (the least h of its cycle) and off (how many steps lead to it), by pointer doubling. A round
    doubles the steps seen, so there are as many as the longest cycle's length has bits; each is a join on unique keys."""
    at, k = kept(steps.select("h", F.col("next").alias("to"), F.col("h").alias("ring"), F.lit(0).cast("long").alias("off"))), 0
    while True:
        far = at.select(F.col("h").alias("to"), F.col("to").alias("next"), F.col("ring").alias("r"), (F.col("off") + (1 << k)).alias("o"))
        near = F.col("ring") <= F.col("r")
        new = at.join(far, "to").select("h", F.col("next").alias("to"), F.when(near, F.col("ring")).otherwise(F.col("r")).alias("ring"), F.when(near, F.col("off")).otherwise(F.col("o")).alias("off"), (~near).alias("moved"))
        new = kept(new)
        if not new.where("moved").limit(1).count():
            return new.select("h", "ring", "off")
        at, k = new.drop("moved"), k + 1


def _rings(halves: DataFrame) -> DataFrame:
    """Half-edges with the ring they lie on."""
    steps = kept(successors(halves))
    return steps.drop("next").join(cycles(steps), "h")


def _from_least(corners: Column) -> Column:
    first = F.array_position(corners, F.array_min(corners)).cast("int")
    return F.concat(F.slice(corners, first, F.size(corners)), F.slice(corners, F.lit(1), first - 1))


def _signed_area(corners: Column) -> Column:
    """Positive if counterclockwise; from the first corner, so that large coordinates don't cancel."""
    x0, y0 = (F.get(corners, F.lit(0))[c] for c in "xy")
    follow = lambda i: F.get(corners, F.pmod(i + 1, F.size(corners)))
    parts = F.transform(corners, lambda p, i: (p["x"] - x0) * (follow(i)["y"] - y0) - (follow(i)["x"] - x0) * (p["y"] - y0))
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v) / 2.0


def _box() -> list[Column]:
    return [f(F.col(f"corners.{c}")).alias(f"{n}{c}") for c in "xy" for n, f in (("least_", F.array_min), ("most_", F.array_max))]


CORNERS = "array<struct<x:double,y:double>>"


def faces(lines: DataFrame, least_area: float = polygons.LEAST_ROOF) -> DataFrame:
    """The bounded faces of line work (grp, x1, y1, x2, y2) that meets only at its ends: grp, corners (counterclockwise, from the least), holes
    (arrays of corners, clockwise) and area, for those larger than least_area.

    Edges with the same face on both sides (dangling ones, and bridges between rings) bound nothing and go. Rings that touch at a corner
    stay one ring. The outer ring of whatever lies within a face is a hole of the smallest face around it. Repeated edges count once,
    an empty table gives none. A null group is one too. Groups of up to GROUP lines are sent once, to where their faces are found; those of more are dealt out
    by half-edges, in rounds."""
    good = _finite(lines)
    sizes = good.groupBy("grp").agg(F.count("*").alias("n"))
    total, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, total // ROWS)
    if most <= GROUP:
        return _near_faces(good, tasks, least_area)
    # There are fewer such groups than a GROUP-th of the lines. A null stands in a struct, and so meets its like.
    large = F.broadcast(kept(sizes.where(F.col("n") > GROUP).select(F.struct("grp").alias("_own"))))
    own = good.withColumn("_own", F.struct("grp"))
    near, far = (own.join(large, "_own", how) for how in ("left_anti", "left_semi"))
    far = _far_faces(far.select(F.col("_own").alias("grp"), "x1", "y1", "x2", "y2"), least_area)
    return _near_faces(near.drop("_own"), tasks, least_area).union(far.select("grp.grp", "corners", "holes", "area"))


def _near_faces(lines: DataFrame, tasks: int, least_area: float) -> DataFrame:
    """Faces of groups that are whole where their lines meet."""
    names = ("x1", "y1", "x2", "y2")
    schema = T.StructType([lines.schema["grp"], T.StructField("corners", T._parse_datatype_string(CORNERS)), T.StructField("holes", T._parse_datatype_string(f"array<{CORNERS}>")), T.StructField("area", T.DoubleType())])

    def lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), values)

    def found(rows: pa.Table, code: np.ndarray) -> Iterator[pa.RecordBatch]:
        got = facets.faces(code, np.stack([rows[c].to_numpy() for c in names], axis=1).reshape(-1, 2, 2), least_area)
        if got is not None and len(got.group):
            rings = lambda first, size: lists(size, pa.StructArray.from_arrays([pa.array(v) for v in got.xy[facets.ranges(first, size)].T], ["x", "y"]))
            grp = rows["grp"].combine_chunks().take(pa.array(np.searchsorted(code, got.group)))
            yield pa.RecordBatch.from_arrays([grp, rings(got.first, got.size), lists(got.holes, rings(got.hole_first, got.hole_size)), pa.array(got.area)], schema.names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        coded = lambda t: t["grp"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= ROWS:
                rows = pa.Table.from_batches(held)
                code = coded(rows)
                # The last group may go on in the next batch.
                cut = int(np.searchsorted(code, code[-1]))
                yield from found(rows.slice(0, cut), code[:cut])
                held = rows.slice(cut).to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            yield from found(rows, coded(rows))

    return lines.repartition(tasks, "grp").sortWithinPartitions("grp").select("grp", *names).mapInArrow(whole, schema)


def _far_faces(lines: DataFrame, least_area: float) -> DataFrame:
    """Faces of groups that are too large for one task: by pointer doubling over all half-edges."""
    halves = half_edges(lines)
    at = kept(_rings(halves))
    edge = F.shiftright("h", 1)
    bridges = at.groupBy(edge.alias("e")).agg(F.min("ring").alias("a"), F.max("ring").alias("b")).where("a = b").select("e")
    if bridges.limit(1).count():
        at = _rings(halves.join(bridges, F.shiftright("h", 1) == F.col("e"), "left_anti"))
    # The ring's least half-edge is no step away, the one after it as many as the ring has, less one.
    ring = at.groupBy("grp", "ring").agg(F.array_sort(F.collect_list(F.struct((-F.col("off")).alias("place"), F.col("p.x").alias("x"), F.col("p.y").alias("y")))).alias("c"))
    c = F.transform(F.concat(F.slice("c", F.size("c"), 1), F.slice("c", 1, F.size("c") - 1)), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    ring = ring.select("grp", "ring", _from_least(c).alias("corners"))
    ring = kept(ring.withColumn("area", _signed_area(F.col("corners"))))
    shells = ring.where("area > 0").select("grp", "ring", "corners", "area", *_box())
    outer = ring.where("area < 0").select("grp", F.col("corners").alias("hole"), F.col("area").alias("hole_area"), *_box())
    held = _inside(outer, shells).groupBy("grp", "ring").agg(F.array_sort(F.collect_list("hole")).alias("holes"), F.sum("hole_area").alias("gone"))
    out = shells.select("grp", "ring", "corners", "area").join(held, ["grp", "ring"], "left")
    none = F.array().cast(f"array<{CORNERS}>")
    out = out.select("grp", "corners", F.coalesce("holes", none).alias("holes"), (F.col("area") + F.coalesce("gone", F.lit(0.0))).alias("area"))
    return out.where(F.col("area") > least_area)


def _inside(outer: DataFrame, shells: DataFrame) -> DataFrame:
    """Outer rings (hole, hole_area) with the smallest shell that lies all around them (grp, ring). A shell is found by the cells of a grid that is
    as coarse as the shell is large, of which it touches four at most; a ring asks its own cell in each of its group's grids."""
    level = F.ceil(F.log2(F.greatest(F.col("most_x") - F.col("least_x"), F.col("most_y") - F.col("least_y"))))
    cell = lambda v: F.floor(v / F.pow(F.lit(2.0), F.col("level")))
    span = lambda c: F.explode(F.sequence(cell(F.col(f"least_{c}")), cell(F.col(f"most_{c}"))))
    placed = shells.withColumn("level", level).withColumn("i", span("x")).withColumn("j", span("y"))
    placed = placed.select("grp", "ring", "area", "level", "i", "j", polygons.sides(F.col("corners")).alias("sides"), *(F.col(n).alias(f"around_{n}") for n in ("least_x", "most_x", "least_y", "most_y")))
    levels = placed.select("grp", "level").distinct()
    asked = outer.join(levels, "grp").withColumn("i", cell(F.col("least_x"))).withColumn("j", cell(F.col("least_y")))
    met = asked.join(placed, ["grp", "level", "i", "j"])
    wider = [F.col(f"around_least_{c}") < F.col(f"least_{c}") for c in "xy"] + [F.col(f"around_most_{c}") > F.col(f"most_{c}") for c in "xy"]
    first = F.get("hole", F.lit(0))
    met = met.where(wider[0] & wider[1] & wider[2] & wider[3] & polygons.contains(F.col("sides"), first["x"], first["y"]))
    return met.groupBy("grp", "hole").agg(F.min(F.struct("area", "ring")).alias("of"), F.first("hole_area").alias("hole_area")).select("grp", "hole", "hole_area", F.col("of.ring").alias("ring"))

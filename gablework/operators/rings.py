"""Nodes, rings and wall faces of wireframes, as joins, groupings and windows by building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablework.functions import geometry as g
from gablework.operators.columns import once

RING = ("building", "component", "loop")
ORDER = ("ring_order", "seq")


def last_nodes(ends: DataFrame) -> DataFrame:
    """Nodes of edge ends (building, node, seq, endpoint, x, y, z): of several places of one node, the last one written
    counts. idx is the node's rank among the building's nodes, from 0."""
    last = ends.groupBy("building", "node").agg(F.max_by(F.struct("x", "y", "z"), F.struct("seq", "endpoint")).alias("p"))
    rank = F.row_number().over(Window.partitionBy("building").orderBy("node")) - 1
    return last.select("building", "node", "p.x", "p.y", "p.z", rank.alias("idx"))


def rings(edges: DataFrame) -> DataFrame:
    """Rings of edges (building, component, loop, ring_order, seq, source, target): grouped, a null group being one too,
    ordered stably and kept from two edges on. Without any group the building's edges are one ring."""
    item = F.struct(F.col("ring_order").isNull().alias("last"), *ORDER, "source", "target")
    made = edges.groupBy(*RING).agg(F.array_sort(F.collect_list(item)).alias("edges"))
    return made.where(F.size("edges") >= 2).select(*RING, F.transform("edges", lambda e: F.struct(e["source"].alias("source"), e["target"].alias("target"))).alias("edges"))


def ring_sizes(edges: DataFrame) -> DataFrame:
    return edges.groupBy(*RING).agg(F.count("*").alias("n_edges")).where("n_edges >= 2")


def _order() -> list[Column]:
    return [F.col("ring_order").asc_nulls_last(), F.col("seq").asc()]


def wall_faces(edges: DataFrame) -> DataFrame:
    """Walls of vertical edges (building, component, loop, ring_order, seq, p, q), p and q structs of x, y, z (null for a missing node): each
    edge with the next one of its ring, the last with the first. Columns b1, t1 and b2, t2 are the lower and upper ends;
    loop_index counts within the ring and wall_index over the building, walls without all nodes included."""
    # Nulls stand in fields of their own, and the ring's place is one column (of several, constant ones would be left out of one order and not of
    # the other), so that one order serves rings and buildings: rows are sorted once.
    edges = edges.withColumn("_place", F.struct(F.col("component").isNull(), "component", F.col("loop").isNull(), "loop"))
    ring = Window.partitionBy("building", "_place").orderBy(*_order())
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct("p", "q")
    following = F.coalesce(F.lead(own).over(ring), F.first(own).over(whole))
    # All at once, so that rows pass one window by rings.
    at = edges.withColumns({"n": F.count("*").over(whole), "next": following, "loop_index": F.row_number().over(ring) - 1}).where("n >= 2")
    over = Window.partitionBy("building").orderBy("_place", *_order())
    at = at.withColumn("wall_index", F.row_number().over(over) - 1)
    (b1, t1), (b2, t2) = g.by_height(F.col("p"), F.col("q")), g.by_height(F.col("next.p"), F.col("next.q"))
    # Generated columns are computed once; projected ones would be written into every expression that uses them.
    ends = F.inline(F.array(F.struct(b1.alias("b1"), t1.alias("t1"), b2.alias("b2"), t2.alias("t2"))))
    return at.select(*RING, *ORDER, "loop_index", "wall_index", ends)


def ring_boxes(edges: DataFrame) -> DataFrame:
    """The box around the base lines of each ring's walls (building, x1, y1, x2, y2), without an order of its edges: a wall ends where the next begins."""
    low, _ = g.by_height(F.col("p"), F.col("q"))
    at = edges.select(*RING, low["x"].alias("x"), low["y"].alias("y")).groupBy(*RING)
    return at.agg(*(f(c).alias(f"{c}{k}") for k, f in ((1, F.min), (2, F.max)) for c in "xy"), F.count("*").alias("n")).where("n >= 2").select("building", "x1", "y1", "x2", "y2")


def point(name: str, dims: str = "xyz") -> g.Point:
    return tuple(F.col(f"{name}.{c}") for c in dims)


def wall_geometry(walls: DataFrame) -> DataFrame:
    """With the unit normal (nx, ny, nz), the center (cx, cy, cz), and the base's length base_m and direction (dx, dy)."""
    b1, b2, t1, t2 = (point(n) for n in ("b1", "b2", "t1", "t2"))
    center = g.times(g.plus(g.plus(b1, b2), g.plus(t1, t2)), 0.25)
    base = g.minus(b2[:2], b1[:2])
    raw = dict(zip(("_x", "_y", "_z", "cx", "cy", "cz", "_dx", "_dy"), (*g.cross(g.minus(b2, b1), g.minus(t1, b1)), *center, *base), strict=True))
    at = walls.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in raw.items())))))
    lengths = {"_n": g.norm(tuple(F.col(f"_{c}") for c in "xyz")), "base_m": g.norm((F.col("_dx"), F.col("_dy")))}
    at = at.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in lengths.items())))))
    unit = {f"n{c}": F.when(F.col("_n") > 1e-12, F.col(f"_{c}") / F.col("_n")).otherwise(0.0) for c in "xyz"}
    along = {f"d{c}": F.when(F.col("base_m") >= 1e-9, F.col(f"_d{c}") / F.col("base_m")) for c in "xy"}
    at = at.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in (unit | along).items())))))
    return at.drop("_x", "_y", "_z", "_n", "_dx", "_dy")


def wall_metrics(walls: DataFrame) -> DataFrame:
    """Walls measured in their own plane: u along the roof edge (u_x, u_y, u_z), v upward and square to it, the corners' (u, v) with the middle of
    the top edge at v = 0, and width_m, height_left_m, height_right_m. A wall without a roof edge has zeros for its axes."""
    b1, b2, t1, t2 = (point(n) for n in ("b1", "b2", "t1", "t2"))
    u, v = (tuple(F.col(f"{a}_{c}") for c in "xyz") for a in "uv")
    at = once(walls, dict(zip(("_x", "_y", "_z"), g.minus(t2, t1), strict=True)) | dict(zip(("_p", "_q", "_r"), g.times(g.plus(g.minus(t1, b1), g.minus(t2, b2)), 0.5), strict=True)))
    at = once(at, {"_n": g.norm(tuple(F.col(f"_{c}") for c in "xyz"))})
    at = once(at, {f"u_{c}": F.when(F.col("_n") > 1e-12, F.col(f"_{c}") / F.col("_n")).otherwise(0.0) for c in "xyz"})
    seed = tuple(F.col(f"_{c}") for c in "pqr")
    at = once(at, {"_k": g.dot(seed, u)})
    at = once(at, {f"_{c}": a - F.col("_k") * b for c, a, b in zip("xyz", seed, u, strict=True)})
    at = once(at, {"_n": g.norm(tuple(F.col(f"_{c}") for c in "xyz"))})
    at = once(at, {f"v_{c}": F.when(F.col("_n") > 1e-12, F.col(f"_{c}") / F.col("_n")).otherwise(0.0) for c in "xyz"})
    # v points from the base to the roof.
    at = once(once(at, {"_k": F.when(g.dot(v, seed) < 0, -1.0).otherwise(1.0)}), {f"v_{c}": F.col(f"v_{c}") * F.col("_k") for c in "xyz"})
    corners = (("b1", b1), ("b2", b2), ("t2", t2), ("t1", t1))
    at = once(at, {f"{n}_{k}": g.dot(g.minus(p, t1), axis) for n, p in corners for k, axis in (("u", u), ("v", v))})
    at = once(once(at, {"_k": (F.col("t1_v") + F.col("t2_v")) * 0.5}), {f"{n}_v": F.col(f"{n}_v") - F.col("_k") for n, _ in corners})
    sizes = {"width_m": F.col("t2_u") - F.col("t1_u"), "height_left_m": F.col("t1_v") - F.col("b1_v"), "height_right_m": F.col("t2_v") - F.col("b2_v")}
    return once(at, sizes).drop(*(f"_{c}" for c in "xyzpqrnk"))


def base_height(edges: DataFrame) -> DataFrame:
    """Mean height of both ends of every base edge, each end counted; 0 for a building without any."""
    ends = [F.when(F.col("type") == "base", F.col(f"{e}.z")) for e in "pq"]
    sums = edges.groupBy("building").agg(*(f(z).alias(f"{n}{k}") for k, z in enumerate(ends) for n, f in (("s", F.sum), ("n", F.count))))
    total = F.coalesce("s0", F.lit(0.0)) + F.coalesce("s1", F.lit(0.0))
    return sums.select("building", F.coalesce(F.try_divide(total, F.col("n0") + F.col("n1")), F.lit(0.0)).alias("base_z"))


def shoelace(corners: DataFrame) -> DataFrame:
    """Area of polygons given by their corners (building, seq, x, y)."""
    order = Window.partitionBy("building").orderBy("seq")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(order), F.first(c).over(whole))
    at = corners.select("building", "x", "y", nxt("x").alias("x2"), nxt("y").alias("y2"))
    return at.groupBy("building").agg((F.abs(F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y"))) / 2.0).alias("area"))


def indexed_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (building, seq, source, target) by the nodes' dense index; edges with an unknown node go."""
    at = lambda end: nodes.select("building", F.col("node").alias(end), F.col("idx").alias(f"{end}_idx"))
    return edges.join(at("source"), ["building", "source"]).join(at("target"), ["building", "target"]).select("building", "seq", "source_idx", "target_idx")

"""Search for panoramas around buildings and the choice of one for each wall."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.config import Settings
from gablework.functions import geometry as g
from gablework.functions import intervals
from gablework.operators.columns import once
from gablework.operators.rings import point

#: Side of the cells by which panoramas meet grid points.
CELL = 100.0
#: Side of those by which they meet buildings' boxes, so that a box of the usual size is in one to four of them.
BOX_CELL = 200.0
#: Buildings whose grids are searched at once, and about so many of their panoramas at least.
ROWS, PAIRS = 2048, 1024


def _boxes(bases: DataFrame, s: Settings) -> DataFrame:
    """The box around a building's base lines and their surroundings: building, x0, xn, y0, yn."""
    low, high = (lambda c: F.min(F.least(f"{c}1", f"{c}2")) - s.grid_offset_m), (lambda c: F.max(F.greatest(f"{c}1", f"{c}2")) + s.grid_offset_m)
    return bases.groupBy("building").agg(low("x").alias("x0"), high("x").alias("xn"), low("y").alias("y0"), high("y").alias("yn"))


def _square(s: Settings) -> tuple[Column, Column]:
    """Of a box its square's side, and the radius of a search from its grid points."""
    side = F.greatest(F.col("xn") - F.col("x0"), F.col("yn") - F.col("y0"))
    return side, F.floor(F.greatest(F.lit(float(s.search_radius_m)), 1.2 * (side / float(s.grid_n)))).cast("int")


def search_grid(bases: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Grid points (building, i, j, x, y, radius) of a square that covers a building's base lines (building, x1, y1, x2, y2) and
    their surroundings."""
    step = F.col("side") / float(s.grid_n)
    steps = F.sequence(F.lit(0), F.lit(s.grid_n))
    side, radius = _square(s)
    at = _boxes(bases, s).withColumns({"side": side, "radius": radius}).withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps))
    place = lambda c, k: (F.col(f"{c}0") + F.col(f"{c}n")) * 0.5 - F.col("side") * 0.5 + F.col(k) * step
    return at.select("building", "i", "j", place("x", "i").alias("x"), place("y", "j").alias("y"), "radius")


def _met(boxes: DataFrame, panos: DataFrame, ends: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Boxes with the panoramas (pano_id, x, y) in them, by cells of BOX_CELL: one building has one box, whatever its lines or grid points. ends: for x and
    y the box's low and high end, of columns of boxes, so that only these are sent."""
    (x0, xn), (y0, yn) = (tuple(F.floor(e / BOX_CELL) for e in ends[c]) for c in "xy")
    # Cells are counted by one number, as rows made in two steps would be written twice.
    wide, k = xn - x0 + 1, F.col("_k")
    cells = boxes.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), wide * (yn - y0 + 1) - 1)))
    cells = cells.withColumns({"cx": x0 + k % wide, "cy": y0 + F.floor(k / wide)}).drop("_k")
    spots = panos.select("pano_id", F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("x") / BOX_CELL).alias("cx"), F.floor(F.col("y") / BOX_CELL).alias("cy"))
    at = cells.join(spots, ["cx", "cy"])
    return at.where(F.col("px").between(*ends["x"]) & F.col("py").between(*ends["y"])).drop("cx", "cy")


def _near_lines(bases: DataFrame, asked: DataFrame, m: float) -> DataFrame:
    """Of panoramas of buildings (building, pano_id, x, y) those strictly within m of one of the building's base lines."""
    d = g.point_segment_distance((F.col("x"), F.col("y")), (F.col("x1"), F.col("y1")), (F.col("x2"), F.col("y2")))
    return bases.select("building", "x1", "y1", "x2", "y2").join(asked.hint("shuffle_hash"), "building").where(d < m).select(*asked.columns).distinct()


def nearest_to_grid(grid: DataFrame, panos: DataFrame) -> DataFrame:
    """For each grid point the nearest panorama (pano_id, x, y) within its radius, by cells of CELL."""
    reach = F.col("radius")
    cells = lambda c: F.sequence(F.floor((F.col(c) - reach) / CELL), F.floor((F.col(c) + reach) / CELL))
    probes = grid.withColumn("cx", F.explode(cells("x"))).withColumn("cy", F.explode(cells("y")))
    spots = panos.select("pano_id", F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("x") / CELL).alias("cx"), F.floor(F.col("y") / CELL).alias("cy"))
    d = g.norm((F.col("px") - F.col("x"), F.col("py") - F.col("y")))
    met = probes.join(spots, ["cx", "cy"]).withColumn("d", d).where("d <= radius")
    return met.groupBy("building", "i", "j").agg(F.min_by(F.struct("pano_id", "px", "py"), F.struct("d", "pano_id")).alias("p")).select("building", "i", "j", "p.pano_id", F.col("p.px").alias("x"), F.col("p.py").alias("y"))


def in_zone(bases: DataFrame, panos: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Panoramas strictly within grid_offset_m of a building's base lines: building, pano_id, x, y. A building's box and panoramas meet by
    cells, and only what is in the box meets the lines, so the joins are equi-joins whatever their sizes."""
    m = s.grid_offset_m
    bases = bases.where("building is not null")
    asked = _met(_boxes(bases, s), panos, {c: (F.col(f"{c}0"), F.col(f"{c}n")) for c in "xy"}).select("building", "pano_id", F.col("px").alias("x"), F.col("py").alias("y"))
    return _near_lines(bases, asked, m)


def first_by_place(found: DataFrame, digits: int = 6) -> DataFrame:
    """Of panoramas (building, i, j, lat, lng, ...) at one rounded place, the first in grid order."""
    order = Window.partitionBy("building", F.round("lat", digits), F.round("lng", digits)).orderBy("i", "j")
    return found.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def _found(boxes: DataFrame, panos: DataFrame, s: Settings) -> DataFrame:
    """Panoramas that are nearest to a grid point of a building's square, with the first such point: building, pano_id, i, j, x, y. The grid is made
    where a building and its panoramas are, so neither its points nor their distances are ever sent."""
    n = s.grid_n + 1
    side, radius = _square(s)
    squares = boxes.select("building", *(((F.col(f"{c}0") + F.col(f"{c}n")) * 0.5).alias(f"m{c}") for c in "xy"), side.alias("side"), radius.alias("radius"))
    reach = F.col("side") * 0.5 + F.col("radius") + 1.0
    met = _met(squares, panos, {c: (F.col(f"m{c}") - reach, F.col(f"m{c}") + reach) for c in "xy"})
    near = F.array_sort(F.collect_list(F.struct("pano_id", "px", "py"))).alias("near")
    # The corner is that of search_grid.
    own = [(F.col(f"m{c}") - F.col("side") * 0.5).alias(c) for c in "xy"] + [(F.col("side") / float(s.grid_n)).alias("step")]
    at = met.groupBy(*squares.columns).agg(near).select("building", *own, "radius", "near")
    kind = at.schema
    out = T.StructType([kind["building"], T.StructField("pano_id", kind["near"].dataType.elementType["pano_id"].dataType), *(T.StructField(c, t) for c, t in (("i", T.IntegerType()), ("j", T.IntegerType()), ("x", T.DoubleType()), ("y", T.DoubleType())))])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            sizes = pc.list_value_length(batch.column("near")).to_numpy()
            # Buildings with more panoramas come first, so that those that have a next one are always the first so many.
            order = np.argsort(-sizes, kind="stable")
            batch, sizes = batch.take(pa.array(order)), sizes[order]
            flat = batch.column("near").flatten()
            px, py = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("px", "py"))
            first = np.cumsum(sizes) - sizes
            x, y, step, radius = (batch.column(c).to_numpy(zero_copy_only=False)[:, None] for c in ("x", "y", "step", "radius"))
            gx, gy = (a + np.arange(n) * step for a in (x, y))
            best, least = np.full((len(sizes), n, n), len(flat)), np.full((len(sizes), n, n), np.inf)
            m = 0
            while m < sizes[0]:
                # One more panorama of each of many buildings, or many more of few.
                rows = int(np.searchsorted(-sizes, -m))
                more = m + np.arange(max(1, PAIRS // rows))
                own = more < sizes[:rows, None]
                at = np.where(own, first[:rows, None] + more, 0)
                dx, dy = px[at][:, :, None] - gx[:rows, None], py[at][:, :, None] - gy[:rows, None]
                d = np.sqrt((dx * dx)[..., :, None] + (dy * dy)[..., None, :])
                d = np.where((d <= radius[:rows, :, None, None]) & own[:, :, None, None], d, np.inf)
                # Panoramas of a building are in order, so of equally near ones the first counts.
                k, d = d.argmin(axis=1), d.min(axis=1)
                closer = d < least[:rows]
                np.copyto(least[:rows], d, where=closer)
                np.copyto(best[:rows], first[:rows, None, None] + m + k, where=closer)
                m += len(more)
            # Every panorama is of one building, so the first place there is the first in all.
            place = np.full(len(flat) + 1, n * n)
            for k in reversed(range(n * n)):
                place[best[:, k // n, k % n]] = k
            spot = np.flatnonzero(place[:-1] < n * n)
            k, there = place[spot], flat.take(pa.array(spot))
            own = batch.column("building").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)[spot]))
            columns = [own, there.field("pano_id"), pa.array((k // n).astype(np.int32)), pa.array((k % n).astype(np.int32)), there.field("px"), there.field("py")]
            yield pa.RecordBatch.from_arrays(columns, out.names)

    return at.mapInArrow(nearest, out)


def discovered(bases: DataFrame, panos: DataFrame, s: Settings = Settings(), extents: DataFrame | None = None) -> DataFrame:  # noqa: B008
    """Panoramas that a search finds around buildings (bases: building, x1, y1, x2, y2): building, pano_id, x, y. Each point of a building's grid
    asks for the nearest within its radius; of what is found, panoramas in the building's zone count, and of those at one place the first in
    grid order. A panorama that is nearest to no grid point is never found. extents: columns as those of bases, with the same least and greatest
    places of each building, where they are known for less work than lines."""
    bases, extents = (df.where("building is not null") for df in (bases, bases if extents is None else extents))
    near = _near_lines(bases, _found(_boxes(extents, s), panos, s), s.grid_offset_m)
    near = near.groupBy("building", "pano_id").agg(F.min(F.struct("i", "j", "x", "y")).alias("first")).select("building", "pano_id", "first.*")
    lat, lng = g.from_utm(F.col("x"), F.col("y"))
    return first_by_place(once(near, {"lat": lat, "lng": lng})).select("building", "pano_id", "x", "y")


def best_for_walls(walls: DataFrame, zone: DataFrame, s: Settings = Settings(), near: str | None = None) -> DataFrame:  # noqa: B008
    """Each wall (with its geometry) and its panorama: of those in front of the wall and within the prism over its base, the
    one with the least (lateral, forward, dist, pano_id); null if there is none. zone: building, pano_id, x, y. Walls meet their building's panoramas
    as one row, so they are neither multiplied nor sorted by wall. near: a name for a column that tells whether the building has any panorama."""
    b1, b2 = point("b1", "xy"), point("b2", "xy")
    flat = g.safe_unit((F.col("nx"), F.col("ny")))
    none = g.norm((F.col("nx"), F.col("ny"))) < 1e-9
    n = (F.when(none, -F.col("dy")).otherwise(flat[0]), F.when(none, F.col("dx")).otherwise(flat[1]))
    beside = zone.groupBy("building").agg(F.collect_list(F.struct("pano_id", "x", "y")).alias("_near"))
    at = walls.join(beside.hint("shuffle_hash"), "building", "left")
    mx, my = (b1[0] + b2[0]) * 0.5, (b1[1] + b2[1]) * 0.5

    def seen(o: Column) -> Column:
        # The prism is the base moved along n; with n square to the base its test is a range along each.
        vec = (o["x"] - mx, o["y"] - my)
        along, forward = vec[0] * F.col("dx") + vec[1] * F.col("dy"), vec[0] * n[0] + vec[1] * n[1]
        return F.struct(F.abs(along).alias("lateral"), forward.alias("forward"), g.norm(vec).alias("dist"), o["pano_id"].alias("pano_id"), o["x"].alias("pano_x"), o["y"].alias("pano_y"))

    hit = lambda o: (o["lateral"] <= F.col("base_m") / 2.0) & o["forward"].between(0.0, s.prism_length_m)
    best = F.when(F.col("base_m") >= 1e-9, F.array_min(F.filter(F.transform("_near", seen), hit)))
    known = [F.col("_near").isNotNull().alias(near)] if near else []
    return at.withColumn("_best", best).select(*walls.columns, "_best.*", *known)


#: Points, and areas, of a zone that meet at once.
BLOCK = 1 << 17


def nearest_or_containing(points: DataFrame, areas: DataFrame) -> DataFrame:
    """For points (id, zone, v) the area of their zone (area, zone, low, high): the first that contains v, or else the nearest; of equals the first.
    A zone's points and areas meet in blocks of about BLOCK, and a pair of blocks is searched by its sorted ends, so points are never paired with
    every area. A null end is open; a null v is in every area."""
    sizes = lambda rows: rows.groupBy("zone").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    block = lambda c: F.pmod(F.xxhash64(c), F.col("n").cast("long")).cast("int")
    areas, points = areas.where("zone is not null"), points.where("zone is not null")
    to = sizes(areas)
    a = areas.join(to, "zone").select("zone", block("area").alias("b"), "area", *(F.col(c).cast("double").alias(c) for c in ("low", "high")))
    p = points.join(sizes(points), "zone").withColumn("a", block("id")).drop("n").join(to, "zone")
    p = p.select("zone", "a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("b"), "id", F.col("v").cast("double").alias("v"))
    # An area's block goes to each of its zone's blocks of points.
    a = a.join(p.groupBy("zone").agg(F.max("a").alias("to")), "zone").select("zone", F.explode(F.sequence(F.lit(0), "to")).alias("a"), "b", "area", "low", "high")
    schema = T.StructType([T.StructField("id", points.schema["id"].dataType), T.StructField("area", areas.schema["area"].dataType), T.StructField("d", T.DoubleType())])

    def met(own: pa.Table, others: pa.Table) -> pa.Table:
        if not (own.num_rows and others.num_rows):
            return pa.table({n: pa.array([], t.type) for n, t in (("id", own.schema.field("id")), ("area", others.schema.field("area")), ("d", own.schema.field("v")))})
        others = others.take(pc.sort_indices(others, sort_keys=[("area", "ascending")], null_placement="at_start"))
        known = own["v"].is_valid().to_numpy(zero_copy_only=False)
        low, high = (others[c].fill_null(far).to_numpy() for c, far in (("low", -np.inf), ("high", np.inf)))
        k, d = intervals.nearest(own["v"].fill_null(0.0).to_numpy(), low, high)
        k, d = np.where(known, k, 0), np.where(known, d, 0.0)
        return pa.table({"id": own["id"], "area": others["area"].take(pa.array(k)), "d": pa.array(d)})

    keys = ("zone", "a", "b")
    found = p.groupBy(*keys).cogroup(a.groupBy(*keys)).applyInArrow(met, schema)
    return found.groupBy("id").agg(F.min_by("area", F.struct("d", "area")).alias("area"), F.min("d").alias("distance"))

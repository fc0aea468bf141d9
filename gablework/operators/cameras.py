"""Cameras towards walls, and how much of a wall a view covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablework.config import Settings
from gablework.functions import geometry as g
from gablework.operators.columns import once
from gablework.operators.rings import point


def aim(walls: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Heading, pitch and field of view of the camera at a wall's panorama (columns pano_x, pano_y, base_z)."""
    cam = (F.col("pano_x"), F.col("pano_y"), F.col("base_z") + s.camera_height_m)
    heading = g.bearing(F.col("cx") - cam[0], F.col("cy") - cam[1])
    pitch = F.degrees(F.atan2(F.col("cz") - cam[2], g.norm((F.col("cx") - cam[0], F.col("cy") - cam[1]))))
    az = [g.bearing(p[0] - cam[0], p[1] - cam[1]) for p in (point("b1", "xy"), point("b2", "xy"))]
    middle = tuple((a + b) * 0.5 for a, b in zip(point("b1", "xy"), point("b2", "xy"), strict=True))
    forward = (middle[0] - cam[0]) * F.col("nx") + (middle[1] - cam[1]) * F.col("ny")
    at = once(walls, {"cam_x": cam[0], "cam_y": cam[1], "cam_z": cam[2], "heading": heading, "pitch": pitch, "az1": az[0], "az2": az[1], "ahead": forward})
    return once(at, {"fov": g.solve_fov(F.col("heading"), F.col("az1"), F.col("az2"), F.col("ahead"), s)}).drop("az1", "az2", "ahead")


def posed(aimed: DataFrame) -> tuple[DataFrame, tuple[g.Point, g.Point, g.Point]]:
    """With the camera's axes as columns, so that they are computed once: right, up and forward."""
    names = [tuple(f"_{a}{c}" for c in "xyz") for a in "ruf"]
    at = once(aimed, dict(zip(names[2], g.pose(F.col("heading"), F.col("pitch"))[2], strict=True)))
    f = tuple(F.col(n) for n in names[2])
    level = F.sqrt(f[0] * f[0] + f[1] * f[1])
    at = once(at, {"_rx": F.when(level < 1e-6, 1.0).otherwise(f[1] / level), "_ry": F.when(level < 1e-6, 0.0).otherwise(-f[0] / level), "_rz": F.lit(0.0)})
    r = tuple(F.col(n) for n in names[0])
    at = once(at, dict(zip(names[1], g.cross(r, f), strict=True)))
    return at, tuple(tuple(F.col(n) for n in axis) for axis in names)


def views(aimed: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Pixels of a wall's corners (b1, b2, t2, t1) in its view, and the tier: as_is if all are well inside the image,
    re_aimed if one wider view holds them, tiled otherwise, with the tiles' headings and pitches."""
    cam = tuple(F.col(f"cam_{c}") for c in "xyz")
    corners = ("b1", "b2", "t2", "t1")
    at, axes = posed(aimed)
    uv = [g.project(point(n), cam, axes, F.col("fov"), s)[:2] for n in corners]
    at = once(at, {f"{n}_{c}": x for n, p in zip(corners, uv, strict=True) for c, x in zip("uv", p, strict=True)})
    turns = [g.yaw_pitch(point(n), cam) for n in corners]
    at = once(at, {"yaw": g.circular_span(F.array(*(y for y, _ in turns))), "low": F.least(*(p for _, p in turns)), "high": F.greatest(*(p for _, p in turns))})
    fits = g.inside_image([(F.col(f"{n}_u"), F.col(f"{n}_v")) for n in corners], s.image_width, s.image_height, s.cover_margin_px)
    at = once(at, {"need": F.greatest(F.col("yaw.span"), F.col("high") - F.col("low")) + 2 * s.angle_margin_deg})
    at = once(at, {"tier": F.when(F.coalesce(fits, F.lit(False)), "as_is").when(F.col("need") <= s.fov_max_deg + 1e-6, "re_aimed").otherwise("tiled")})
    rows = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low")) / (s.tile_fov_deg - s.tile_overlap_deg)).cast("int"))
    pitches = F.when(rows == 1, F.array((F.col("low") + F.col("high")) * 0.5)).otherwise(F.transform(F.sequence(F.lit(0), rows - 1), lambda k: F.col("low") + (F.col("high") - F.col("low")) * k / F.greatest(rows - 1, F.lit(1))))
    tiled = F.col("tier") == "tiled"
    return once(at, {
        "view_heading": F.when(F.col("tier") == "re_aimed", F.col("yaw.center")).otherwise(F.col("heading")),
        "view_pitch": F.when(F.col("tier") == "re_aimed", (F.col("low") + F.col("high")) * 0.5).otherwise(F.col("pitch")),
        "view_fov": F.when(F.col("tier") == "re_aimed", g.clip(F.col("need"), s.fov_min_deg, s.fov_max_deg)).otherwise(F.col("fov")),
        "tile_headings": F.when(tiled, g.tile_centers(F.col("yaw.start"), F.col("yaw.end"), F.col("yaw.span"), s)),
        "tile_pitches": F.when(tiled, pitches),
    })


def tiles(seen: DataFrame) -> DataFrame:
    """One row for each tile of a tiled view."""
    return seen.where("tier = 'tiled'").select("building", "wall_index", F.explode("tile_headings").alias("heading"), "tile_pitches").select("building", "wall_index", "heading", F.explode("tile_pitches").alias("pitch"))


def ortho_canvas(boxes: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Size in pixels and effective resolution of a wall's metric canvas (xmin, ymin, xmax, ymax without the margin)."""
    at = once(boxes, {"w": F.col("xmax") - F.col("xmin") + 2 * s.ortho_margin_m, "h": F.col("ymax") - F.col("ymin") + 2 * s.ortho_margin_m})
    pixels = lambda side, ppm: F.greatest(F.ceil(F.col(side) * ppm), F.lit(1)).cast("long")
    full = F.lit(s.pixels_per_meter)
    area = pixels("w", full) * pixels("h", full)
    ppm = F.when(area > s.max_ortho_pixels, full * F.sqrt(F.lit(float(s.max_ortho_pixels)) / area.cast("double"))).otherwise(full)
    at = once(at, {"ppm": ppm})
    return once(at, {"width_px": pixels("w", F.col("ppm")), "height_px": pixels("h", F.col("ppm"))}).drop("w", "h")


def circular_spans(angles: DataFrame) -> DataFrame:
    """The shortest arc that holds all angles (degrees) of each group (grp, angle): grp, span, start. What the largest gap leaves; of
    equal gaps the one after the least angle. Equal angles count once, so a group is sorted by its distinct ones."""
    turned = angles.select("grp", g.floor_mod(F.col("angle"), 360.0).alias("a")).distinct()
    order = Window.partitionBy("grp").orderBy("a")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = turned.select("grp", "a", F.coalesce(F.lead("a").over(order), F.min("a").over(whole) + 360.0).alias("b"))
    best = after.groupBy("grp").agg(F.max(F.struct((F.col("b") - F.col("a")).alias("gap"), (-F.col("a")).alias("k"), "a", "b")).alias("g"))
    return best.select("grp", (F.col("g.a") + 360.0 - F.col("g.b")).alias("span"), g.floor_mod(F.col("g.b"), 360.0).alias("start"))

"""What is known of a wall at the end: its state, the viewer's rows and its whole document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.config import Settings
from gablework.functions import geometry as g
from gablework.functions import naming
from gablework.operators import cameras, panoramas, rings
from gablework.operators.columns import once
from gablework.operators.rings import point

CORNERS = ("b1", "b2", "t2", "t1")
#: Fixed values of a document.
TYPE, VERSION, NOTES = "rectified_wall_texture", "1.5-per-loop", "Per-loop processing; coverage falls back to yaw/pitch tiling."


def with_results(walls: DataFrame, results: DataFrame) -> DataFrame:
    """Every wall with its result by (building, wall_index), or nulls."""
    return walls.join(results, ["building", "wall_index"], "left")


def wall_states(edges: DataFrame, panos: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """From wireframe edges and panoramas (pano_id, x, y), which a grid search around each building finds, to every wall (with its geometry), its panorama
    and a status. One wall without a view, or a building without a panorama, is a row with a status and nulls, and stops no other."""
    faces = rings.wall_faces(edges)
    bases = faces.select("building", *(F.col(f"b{k}.{c}").alias(f"{c}{k}") for k in (1, 2) for c in "xy"))
    zone = panoramas.discovered(bases, panos, s, rings.ring_boxes(edges))
    status = F.when(~F.col("near"), "no_panorama_near_building").when(F.col("pano_id").isNull(), "no_panorama_for_wall").otherwise("ready")
    return panoramas.best_for_walls(rings.wall_geometry(faces), zone, s, "near").withColumn("status", status).drop("near")


def building_states(edges: DataFrame, panos: DataFrame, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Walls by wall_states with their views: all columns of cameras.views and the status."""
    at = wall_states(edges, panos, s).join(rings.base_height(edges), "building")
    seen = cameras.views(cameras.aim(at, s), s)
    return seen.select(*(c for c in seen.columns if c != "status"), "status")


def _tag(building_parts: tuple[Column, Column], index: Column) -> Column:
    named = [F.coalesce(c.cast("string"), F.lit("None")) for c in building_parts]
    return F.format_string("c%s_l%s_w%02d", *named, index)


def _xyz(name: str) -> Column:
    return F.array(*point(name))


def viewer_rows(seen: DataFrame) -> DataFrame:
    """A viewer's row for each wall with a view (columns of cameras.aim, and tier)."""
    lat, lng = g.from_utm(F.col("pano_x"), F.col("pano_y"))
    whole = lambda c: F.coalesce(F.col(c), F.lit(-1)).alias(f"{c}_id")
    return seen.where("pano_id is not null").select(
        "building", _tag((F.col("component"), F.col("loop")), F.col("wall_index")).alias("wall_tag"), whole("component"), whole("loop"), "loop_index", F.col("wall_index").alias("global_index"),
        "pano_id", lat.alias("pano_lat"), lng.alias("pano_lng"), F.array("cam_x", "cam_y", "cam_z").alias("camera_utm_xyz"), F.col("heading").alias("heading_deg"), F.col("pitch").alias("pitch_deg"),
        F.col("fov").alias("fov_deg"), (F.col("tier") == "tiled").alias("is_mosaic"), F.array(*(_xyz(n) for n in CORNERS)).alias("wall_quad_xyz_b1b2t2t1"),
    )


def viewer_indexes(rows: DataFrame) -> DataFrame:
    """One JSON array of viewer rows for each building, in order of its walls."""
    row = F.struct("global_index", *(c for c in rows.columns if c not in ("building", "global_index")))
    return rows.groupBy("building").agg(F.to_json(F.array_sort(F.collect_list(row))).alias("viewer_index"))


def json_bytes(value: Column) -> Column:
    return F.encode(F.to_json(value), "UTF-8")


def _matrix(values: list[Column]) -> Column:
    return F.array(*(F.array(*values[3 * r : 3 * r + 3]) for r in range(3)))


def _with_homography(rows: DataFrame, name: str, src: list[g.Point], dst: list[g.Point]) -> DataFrame:
    """With the nine values of g.homography as an array, each step of it computed once; null for degenerate points."""
    names = [[f"_{m}{k}" for k in range(9)] for m in "abcm"]
    a, b, c, m = ([F.col(n) for n in own] for own in names)
    for own, values in ((names[0], g.square_to_quad(dst)), (names[1], g.square_to_quad(src)), (names[2], g.adjugate(b)), (names[3], g.matmul(a, c))):
        rows = once(rows, dict(zip(own, values, strict=True)))
    rows = once(rows, {name: F.array(*(F.try_divide(x, m[8]) for x in m))})
    sound = F.forall(name, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return once(rows, {name: F.when(sound, F.col(name))}).drop(*(n for own in names for n in own))


def wall_documents(seen: DataFrame, fits: DataFrame | None = None, lines: DataFrame | None = None, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """A document (building, wall_index, document) of each wall with a view (columns of cameras.views). fits: building, wall_index and a
    struct fit of the quad's fit; lines: the same with a struct lines of the best left, right and top line; without them, or where
    the settings turn them off, their sections hold nulls. So do the matrices of a wall whose corners have no homography to its
    view (one without a length or height, or seen from one of its corners)."""
    at = rings.wall_metrics(once(seen.where("pano_id is not null"), {"heading": F.col("view_heading"), "pitch": F.col("view_pitch"), "fov": F.col("view_fov")}))
    at, axes = cameras.posed(at)
    cam = tuple(F.col(f"cam_{c}") for c in "xyz")
    uv = {n: g.project(point(n), cam, axes, F.col("fov"), s)[:2] for n in CORNERS}
    at = once(at, {f"{n}_px_{c}": x for n, p in uv.items() for c, x in zip("xy", p, strict=True)})
    pixel, metre = [(F.col(f"{n}_px_x"), F.col(f"{n}_px_y")) for n in CORNERS], [(F.col(f"{n}_u"), F.col(f"{n}_v")) for n in CORNERS]
    # wall_metrics names the corners' places on the wall as a view names their pixels, so these are taken anew above.
    at = once(at, {f"{c}{n}": f(*(p[k] for p in metre)) for k, c in enumerate("xy") for n, f in (("min", F.least), ("max", F.greatest))})
    at = cameras.ortho_canvas(at, s)
    low, high = {c: F.col(f"{c}min") - s.ortho_margin_m for c in "xy"}, {c: F.col(f"{c}max") + s.ortho_margin_m for c in "xy"}
    tops, feet = [v for _, v in metre[2:]], [v for _, v in metre[:2]]
    at = once(at, {"flip": g.flipped(tops, feet, low["y"], high["y"], F.col("ppm"))})
    zero, one, ppm = F.lit(0.0), F.lit(1.0), F.col("ppm")
    scale = [ppm, zero, -low["x"] * ppm, zero, F.when(F.col("flip"), -ppm).otherwise(ppm), F.when(F.col("flip"), high["y"] * ppm).otherwise(-low["y"] * ppm), zero, zero, one]
    at = _with_homography(at, "_h", pixel, metre)
    h = [F.get("_h", F.lit(k)) for k in range(9)]
    for name, more, on in (("fit", fits, s.enable_quad_fit), ("lines", lines, s.enable_line_detection)):
        at = with_results(at, more.select("building", "wall_index", name)) if more is not None and on else at.withColumn(name, F.lit(None).cast("string"))
    lat, lng = g.from_utm(F.col("pano_x"), F.col("pano_y"))
    part = lambda *cs: F.struct(*cs)
    pairs = lambda ps: F.array(*(F.array(*p) for p in ps))
    whole = lambda c: F.coalesce(F.col(c), F.lit(-1))
    order = F.lit("b1,b2,t2,t1")
    files = {"sam3_overlay": "sam3_alpha_overlay_png", "ortho_prefit_overlay": "ortho_prefit_overlay_png", "hough_overlay": "hough_overlay_png", "hough_warp_overlay": "hough_warp_overlay_png", "ortho_png": "ortho_png", "ortho_overlay": "ortho_overlay_png"}
    view = naming.wall_base(F.col("wall_index"), F.col("pano_id"), F.col("heading"), F.col("pitch"), F.col("fov")) if s.naming == "verbose" else None
    doc = part(
        F.lit(TYPE).alias("type"), F.lit(VERSION).alias("version"),
        part(F.lit("rgba_band_in_memory").alias("mode"), order.alias("uv_quad_px_order"), pairs(pixel).alias("uv_quad_px_raw"), (F.col("tier") == "tiled").alias("mosaic_used"),
             pairs(g.side_band(*pixel, s.image_width, s.image_height, s.band_buffer_px)).alias("band_polygon_px")).alias("cropped_image"),
        part(*(g.focal(s.image_width, F.col("fov")).alias(n) for n in ("fx", "fy")), F.lit(s.image_width / 2.0).alias("cx"), F.lit(s.image_height / 2.0).alias("cy"), F.col("fov").alias("fov_deg"),
             F.array(F.lit(s.image_width), F.lit(s.image_height)).alias("image_size_px")).alias("intrinsics"),
        part(F.array(*cam).alias("camera_utm_xyz"), F.col("heading").alias("heading_deg"), F.col("pitch").alias("pitch_deg"), F.array(zero, zero, one).alias("world_up")).alias("extrinsics"),
        part(whole("component").alias("component_id"), whole("loop").alias("loop_id"), "loop_index", F.col("wall_index").alias("global_index")).alias("wall_identity"),
        part(order.alias("quad_xyz_order"), F.array(*(_xyz(n) for n in CORNERS)).alias("quad_xyz"), F.array("cx", "cy", "cz").alias("center_xyz"),
             part(order.alias("order"), pairs(metre).alias("dst_wall_m"), "width_m", "height_left_m", "height_right_m").alias("metric_target")).alias("wall_geometry"),
        part(ppm.alias("pixels_per_meter"), F.lit(s.ortho_margin_m).alias("margin_m"), part(*((low if n == "min" else high)[c].alias(f"{c}{n}") for c in "xy" for n in ("min", "max"))).alias("bounds_m"),
             F.col("flip").alias("flip_vertical"),
             part(_matrix(h).alias("H_pix_to_wall_m"), _matrix(scale).alias("S_m_to_px"), _matrix(g.matmul(scale, h)).alias("H_pix_to_ortho_px")).alias("homography_chain")).alias("rectification"),
        part(*(naming.artifact(k, F.col("building").cast("string"), F.col("wall_index"), view).alias(n) for k, n in files.items())).alias("artifacts"),
        part("pano_id", lat.alias("pano_lat"), lng.alias("pano_lng"), naming.mask_key(F.concat(naming.image_url(F.col("pano_id").cast("string"), F.col("heading"), F.col("pitch"), F.col("fov")), F.lit("&key=-"))).alias("url")).alias("source"),
        F.lit(NOTES).alias("notes"),
        part(F.lit(s.enable_quad_fit).alias("enabled"), F.lit("uniform_scale_plus_translation_in_ortho_space").alias("fit_mode"), F.col("fit").alias("fit_info")).alias("post_rectification_quad_fit"),
        part(F.lit(s.enable_line_detection).alias("enabled"), part(F.lit(s.hough_band_px).alias("search_band_px"), F.lit(s.hough_min_length_px).alias("min_length_px"), F.lit(s.hough_angle_deg).alias("angle_thresh_deg")).alias("config"),
             F.col("lines").alias("lines")).alias("ortho_hough_line_detection"),
    )
    return at.select("building", "wall_index", F.to_json(doc, {"ignoreNullFields": "false"}).alias("document"))

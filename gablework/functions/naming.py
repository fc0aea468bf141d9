"""Names, masks and addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_key(url: Column) -> Column:
    """The value of every key parameter hidden."""
    return F.regexp_replace(url, "(key=)[^&]+", "$1****")


def sanitize(name: Column) -> Column:
    """Characters other than letters, digits, _ and - become _."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def stem(path: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(.)\.[^.]*$", "$1")


def building_stem(path: Column) -> Column:
    """A wireframe's stem without the suffix _3d."""
    return F.regexp_replace(stem(path), "_3d$", "")


def image_size(text: Column) -> tuple[Column, Column]:
    parts = F.split(F.lower(text), "x")
    return parts[0].cast("int"), parts[1].cast("int")


def wall_base(index: Column, pano_id: Column, heading: Column, pitch: Column, fov: Column) -> Column:
    """A wall's view in a name, with angles to whole degrees (halves to even)."""
    whole = lambda x: F.rint(x).cast("int")
    return F.format_string("wall_%02d__pano_%s__hdg_%d__pit_%d__fov_%d", index, sanitize(pano_id.cast("string")), whole(heading), whole(pitch), whole(fov))


#: What each stage's file is called, after the building and wall (legacy) or after the view (verbose).
LEGACY = {
    "raw_overlay": "_overlay.png", "lr_band_overlay": "_lr_overlay.png", "sam3_overlay": "_sam3_overlay.png", "ortho_png": "_ortho.png", "ortho_overlay": "_ortho_overlay.png",
    "ortho_meta": "_ortho.json", "sam3_instances_overlay": "_sam3_instances_overlay.png", "ortho_prefit_overlay": "_ortho_prefit_overlay.png", "hough_overlay": "_hough_overlay.png",
    "hough_warp_overlay": "_hough_warp_overlay.png",
}
VERBOSE = {
    "raw_overlay": "__overlay.png", "lr_band_overlay": "__lr_band_rgba__overlay.png", "sam3_overlay": "__sam3_building_rgba__overlay.png", "ortho_png": "__ortho_final_rgba.png",
    "ortho_overlay": "__ortho_final_rgba__overlay.png", "ortho_meta": "__ortho_final_meta.json", "sam3_instances_overlay": "__sam3_instances_overlay.png",
    "ortho_prefit_overlay": "__ortho_prefit_rgba__overlay.png", "hough_overlay": "__hough_overlay.png", "hough_warp_overlay": "__hough_warp_overlay.png",
}


def artifact(stage: str, building: Column, index: Column, view: Column | None = None) -> Column:
    """Name of a stage's file for a wall of a building: by wall number, or by the wall's view (wall_base) if one is given. The stage glb
    has one file a building."""
    if stage == "glb":
        return F.concat(building, F.lit("__textured.glb"))
    if view is not None:
        return F.concat(view, F.lit(VERBOSE[stage]))
    return F.concat(building, F.format_string("_wall%02d", index), F.lit(LEGACY[stage]))


def image_url(pano_id: Column, heading: Column, pitch: Column, fov: Column, size: str = "640x640", base: str = "https://panorama.invalid/image") -> Column:
    return F.format_string(f"{base}?size={size}&pano=%s&heading=%.4f&pitch=%.4f&fov=%.4f", pano_id, heading, pitch, fov)

"""Parameters of the facade pipeline, with overrides by upper-case name."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from typing import Any


@dataclass(frozen=True)
class Settings:
    # The defaults that results are compared under.
    grid_offset_m: float = 20.0
    grid_n: int = 10
    search_radius_m: int = 30
    image_width: int = 640
    image_height: int = 640
    fov_min_deg: float = 15.0
    fov_max_deg: float = 120.0
    fov_margin_deg: float = 2.0
    side_buffer_m: float = 3.0
    camera_height_m: float = 2.5
    cover_margin_px: float = 20.0
    angle_margin_deg: float = 3.0
    tile_fov_deg: float = 90.0
    tile_overlap_deg: float = 20.0
    band_buffer_px: float = 20.0
    prism_length_m: float = 1000.0
    pixels_per_meter: float = 100.0
    ortho_margin_m: float = 0.25
    max_ortho_pixels: int = 30_000_000
    fit_shift: float = 0.20
    fit_shift_steps: int = 21
    fit_inset_px: float = 0.25
    fit_growth: float = 1.35
    fit_max_scale: float = 6.0
    mask_close_px: int = 7
    mask_open_px: int = 3
    min_component_px: int = 200
    hough_band_px: float = 80.0
    hough_min_length_px: float = 120.0
    hough_angle_deg: float = 12.0
    naming: str = "legacy"
    enable_quad_fit: bool = True
    enable_line_detection: bool = True

    def overridden(self, local: dict[str, Any] | None = None) -> Settings:
        """Values of upper-case keys that name a setting replace it; other keys are ignored."""
        known = {f.name for f in fields(self)}
        return replace(self, **{k.lower(): v for k, v in (local or {}).items() if k.isupper() and k.lower() in known})

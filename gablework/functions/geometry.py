"""Angles, vectors, cameras, homographies and piecewise maps as Spark column expressions: no UDF, all within codegen.

Points are given as their columns. Angles are in degrees; a bearing is 0 towards +y and grows clockwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gablework.config import Settings

Point = tuple[Column, ...]
Number = Column | float | int


def lit(x: Number) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def dot(a: Point, b: Point) -> Column:
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        total = total + x * y
    return total


def minus(a: Point, b: Point) -> Point:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def plus(a: Point, b: Point) -> Point:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def times(a: Point, k: Number) -> Point:
    return tuple(x * lit(k) for x in a)


def norm(a: Point) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Point, b: Point) -> Point:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def safe_unit(a: Point, eps: float = 1e-9) -> Point:
    """The unit vector, or zeros for a vector of no length."""
    n = norm(a)
    return tuple(F.when(n > eps, x / n).otherwise(0.0) for x in a)


def floor_mod(x: Column, k: float) -> Column:
    """x modulo k with the sign of k."""
    return x - F.lit(k) * F.floor(x / F.lit(k)).cast("double")


def bearing(dx: Column, dy: Column) -> Column:
    return floor_mod(F.degrees(F.atan2(dx, dy)) + 360.0, 360.0)


def wrap_delta(a: Column, b: Column) -> Column:
    """The turn from b to a, from -180 up to but not including 180."""
    return floor_mod(a - b + 180.0, 360.0) - 180.0


def clip(x: Column, low: Number, high: Number) -> Column:
    return F.least(F.greatest(x, lit(low)), lit(high))


def solve_fov(heading: Column, az1: Column, az2: Column, forward: Column, s: Settings = Settings()) -> Column:  # noqa: B008
    """Field of view that holds both ends of a base with a buffer at its sides."""
    half = F.greatest(F.abs(wrap_delta(az1, heading)), F.abs(wrap_delta(az2, heading)))
    side = F.degrees(F.atan2(F.lit(s.side_buffer_m), F.greatest(F.abs(forward), F.lit(0.5))))
    return clip(2.0 * (half + side + s.fov_margin_deg), s.fov_min_deg, s.fov_max_deg)


def by_height(a: Column, b: Column) -> tuple[Column, Column]:
    """Two structs with a field z: the lower one first; of equal ones, the first."""
    first = a["z"] <= b["z"]
    return F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)


def pose(heading: Column, pitch: Column) -> tuple[Point, Point, Point]:
    """Right, up and forward of a camera; looking straight up or down, right is +x."""
    az, el = F.radians(heading), F.radians(pitch)
    forward = (F.sin(az) * F.cos(el), F.cos(az) * F.cos(el), F.sin(el))
    flat = (forward[1], -forward[0], F.lit(0.0))
    level = norm(flat)
    right = (F.when(level < 1e-6, 1.0).otherwise(flat[0] / level), F.when(level < 1e-6, 0.0).otherwise(flat[1] / level), F.lit(0.0))
    return right, safe_unit(cross(right, forward)), forward


def focal(width: Number, fov: Column) -> Column:
    return lit(width) / 2.0 / F.tan(F.radians(fov) / 2.0)


def project(p: Point, camera: Point, axes: tuple[Point, Point, Point], fov: Column, s: Settings = Settings()) -> tuple[Column, Column, Column]:  # noqa: B008
    """Pixel of a world point and its depth; points behind the camera have a negative depth and are mirrored."""
    d = minus(p, camera)
    x, y, z = (dot(d, a) for a in axes)
    f = focal(s.image_width, fov)
    return f * (x / z) + s.image_width / 2.0, f * (-y / z) + s.image_height / 2.0, z


def inside_image(points: Sequence[tuple[Column, Column]], width: float, height: float, margin: float) -> Column:
    out = F.lit(True)
    for u, v in points:
        out = out & u.between(margin, width - margin) & v.between(margin, height - margin)
    return out


def yaw_pitch(p: Point, camera: Point) -> tuple[Column, Column]:
    dx, dy, dz = minus(p, camera)
    return bearing(dx, dy), F.degrees(F.atan2(dz, F.greatest(F.sqrt(dx * dx + dy * dy), F.lit(1e-9))))


def circular_span(angles: Column) -> Column:
    """Struct (center, span, start, end) of the shortest arc that holds all angles of an array: what the largest gap
    (the first of equal ones) leaves."""
    a = F.array_sort(F.transform(angles, lambda x: floor_mod(x, 360.0)))
    n = F.size(a)
    gaps = F.transform(a, lambda x, i: F.struct((F.when(i + 1 < n, F.get(a, i + 1)).otherwise(F.get(a, F.lit(0)) + 360.0) - x).alias("gap"), (-i).alias("first"), x.alias("end"), F.when(i + 1 < n, F.get(a, i + 1)).otherwise(F.get(a, F.lit(0)) + 360.0).alias("start")))
    best = F.array_max(gaps)
    start, span = best["start"], best["end"] + 360.0 - best["start"]
    return F.struct(floor_mod((best["start"] + best["end"] + 360.0) * 0.5, 360.0).alias("center"), span.alias("span"), floor_mod(start, 360.0).alias("start"), floor_mod(start + span, 360.0).alias("end"))


def tile_centers(start: Column, end: Column, span: Column, s: Settings = Settings()) -> Column:  # noqa: B008
    """Centers of the tiles that cover an arc."""
    n = F.greatest(F.lit(1), F.ceil(span / (s.tile_fov_deg - s.tile_overlap_deg)).cast("int"))
    many = F.transform(F.sequence(F.lit(0), n - 1), lambda i: floor_mod(start + (i + 0.5) * (span / n), 360.0))
    return F.when(n == 1, F.array(floor_mod((start + end) * 0.5, 360.0))).otherwise(many)


def line_through(p: Point, q: Point) -> Point:
    """(a, b, c) of the line ax + by + c = 0 through two points, with a unit normal."""
    n = safe_unit((-(q[1] - p[1]), q[0] - p[0]))
    return n[0], n[1], -(n[0] * p[0] + n[1] * p[1])


def offset_line(line: Point, by: Number) -> Point:
    return line[0], line[1], line[2] - lit(by)


def x_on_line(line: Point, y: Number, fallback: Column) -> Column:
    a, b, c = line
    return F.when(F.abs(a) < 1e-9, fallback).otherwise(-(b * lit(y) + c) / a)


def side_band(b1: Point, b2: Point, t2: Point, t1: Point, width: float, height: float, buffer: float) -> list[tuple[Column, Column]]:
    """Corners of the band between the outward-shifted left and right sides of a quad, over the image's whole height."""
    center = times(plus(plus(b1, b2), plus(t2, t1)), 0.25)

    def outward(p: Point, q: Point) -> Point:
        a, b, c = line_through(p, q)
        middle = times(plus(p, q), 0.5)
        flip = F.when(dot((a, b), minus(center, middle)) < 0, 1.0).otherwise(-1.0)
        return offset_line((a * flip, b * flip, c * flip), buffer)

    left, right = outward(b1, t1), outward(b2, t2)
    at = lambda line, y, p: clip(x_on_line(line, y, p[0]), -10 * width, 10 * width)
    top, bottom = F.lit(0.0), F.lit(float(height))
    return [(at(left, 0, b1), top), (at(right, 0, b2), top), (at(right, height, b2), bottom), (at(left, height, b1), bottom)]


def apply_homography(h: Sequence[Number], x: Column, y: Column) -> tuple[Column, Column]:
    """h: nine values by rows. Null for a point that goes to infinity."""
    w = lit(h[6]) * x + lit(h[7]) * y + lit(h[8])
    return F.try_divide(lit(h[0]) * x + lit(h[1]) * y + lit(h[2]), w), F.try_divide(lit(h[3]) * x + lit(h[4]) * y + lit(h[5]), w)


def square_to_quad(p: Sequence[tuple[Column, Column]]) -> list[Column]:
    """Homography of the unit square (0,0), (1,0), (1,1), (0,1) to four points, in closed form, h[8] = 1; null where three of them are on a line
    with the third."""
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = p
    dx1, dx2, sx = x1 - x2, x3 - x2, x0 - x1 + x2 - x3
    dy1, dy2, sy = y1 - y2, y3 - y2, y0 - y1 + y2 - y3
    det = dx1 * dy2 - dx2 * dy1
    g, h = F.try_divide(sx * dy2 - dx2 * sy, det), F.try_divide(dx1 * sy - sx * dy1, det)
    return [x1 - x0 + g * x1, x3 - x0 + h * x3, x0, y1 - y0 + g * y1, y3 - y0 + h * y3, y0, g, h, F.lit(1.0)]


def adjugate(m: Sequence[Column]) -> list[Column]:
    """The inverse of a 3 x 3 matrix but for a factor, which a homography doesn't need."""
    a, b, c, d, e, f, g, h, i = m
    return [e * i - f * h, c * h - b * i, b * f - c * e, f * g - d * i, a * i - c * g, c * d - a * f, d * h - e * g, b * g - a * h, a * e - b * d]


def matmul(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [a[3 * r] * b[c] + a[3 * r + 1] * b[3 + c] + a[3 * r + 2] * b[6 + c] for r in range(3) for c in range(3)]


def homography(src: Sequence[tuple[Column, Column]], dst: Sequence[tuple[Column, Column]]) -> list[Column]:
    """The homography that takes four points to four others, its last value 1; null for degenerate points."""
    h = matmul(square_to_quad(dst), adjugate(square_to_quad(src)))
    return [F.when(F.abs(h[8]) > 1e-300, x / h[8]) for x in h]


def meter_to_pixel(x: Column, y: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column, ppm: Number, flip: Column) -> tuple[Column, Column]:
    """Pixel of a wall point; flip: y grows downward from the top."""
    return (x - xmin) * lit(ppm), F.when(flip, (ymax - y) * lit(ppm)).otherwise((y - ymin) * lit(ppm))


def flipped(top: Sequence[Column], bottom: Sequence[Column], ymin: Column, ymax: Column, ppm: Number) -> Column:
    """Whether a wall's pixels have to grow downward for it to stand upright: the heights of its top corners and bottom corners, as pixels
    both ways, and their means compared."""
    y = lambda v, flip: meter_to_pixel(v, v, ymin, ymin, ymax, ymax, ppm, F.lit(flip))[1]
    mean = lambda vs, flip: lit(0.5) * (y(vs[0], flip) + y(vs[1], flip))
    plain, turned = (mean(top, f) < mean(bottom, f) for f in (False, True))
    return F.when(plain & ~turned, False).when(turned & ~plain, True).otherwise(~plain)


def segment_angle(dx: Column, dy: Column) -> Column:
    return floor_mod(F.degrees(F.atan2(dy, dx)), 180.0)


def angle_difference(a: Column, b: Column) -> Column:
    """Of undirected lines."""
    d = F.abs(floor_mod(a, 180.0) - floor_mod(b, 180.0))
    return F.least(d, 180.0 - d)


def point_line_distance(p: Point, a: Point, b: Point) -> Column:
    n = norm(minus(b, a))
    return F.when(n < 1e-9, norm(minus(p, a))).otherwise(F.abs((b[0] - a[0]) * (a[1] - p[1]) - (a[0] - p[0]) * (b[1] - a[1])) / n)


def point_segment_distance(p: Point, a: Point, b: Point) -> Column:
    d = minus(b, a)
    n = dot(d, d)
    t = F.when(n > 0, clip(dot(minus(p, a), d) / n, 0.0, 1.0)).otherwise(0.0)
    return norm(minus(p, plus(a, times(d, t))))


def x_at_y(line: Sequence[Column], y: Column) -> Column:
    """line: x0, y0, x1, y1; a level line gives its middle."""
    x0, y0, x1, y1 = line
    return F.when(F.abs(y1 - y0) < 1e-9, 0.5 * (x0 + x1)).otherwise(x0 + (y - y0) / (y1 - y0) * (x1 - x0))


def y_at_x(line: Sequence[Column], x: Column) -> Column:
    x0, y0, x1, y1 = line
    return x_at_y((y0, x0, y1, x1), x)


def piecewise(x: Column, knots_from: Sequence[Column], knots_to: Sequence[Column], last: Number) -> Column:
    """A map of 0..last onto itself, linear between its ends and the knots (one or two, in order)."""
    out = None
    pairs = list(zip(knots_from, knots_to, strict=True))
    (a, b) = pairs[-1]
    out = b + (x - a) / F.greatest(lit(last) - a, F.lit(1e-6)) * (lit(last) - b)
    for (a0, b0), (a1, b1) in reversed(list(zip(pairs[:-1], pairs[1:], strict=True))):
        out = F.when(x <= a1, b0 + (x - a0) / F.greatest(a1 - a0, F.lit(1e-6)) * (b1 - b0)).otherwise(out)
    a, b = pairs[0]
    return F.when(x <= a, x * (b / F.greatest(a, F.lit(1e-6)))).otherwise(out)


def horizontal_map(x: Column, y: Column, from_left, from_right, to_left, to_right, width: Number) -> Column:
    """Where a warp that moves two lines to two others puts x in row y (swap the lines for the inverse)."""
    ordered = lambda a, b: (F.least(a, b), F.greatest(a, b))
    source = ordered(x_at_y(from_left, y), x_at_y(from_right, y))
    target = ordered(x_at_y(to_left, y), x_at_y(to_right, y))
    return piecewise(x, source, target, lit(width) - 1.0)


def vertical_map(y: Column, x: Column, from_top, to_top, height: Number) -> Column:
    return piecewise(y, [y_at_x(from_top, x)], [y_at_x(to_top, x)], lit(height) - 1.0)


def warped_line(line: Sequence[Column], from_left, from_right, to_left, to_right, width: Number) -> tuple[Column, ...]:
    """A line (x0, y0, x1, y1) whose ends are moved along their rows as horizontal_map does."""
    x0, y0, x1, y1 = line
    return horizontal_map(x0, y0, from_left, from_right, to_left, to_right, width), y0, horizontal_map(x1, y1, from_left, from_right, to_left, to_right, width), y1


def texture_uv(x: Column, y: Column, width: Number, height: Number) -> tuple[Column, Column]:
    """Texture coordinates of a pixel, v upward."""
    return x / lit(width), 1.0 - y / lit(height)


def affine(m: Sequence[Number], x: Column, y: Column) -> tuple[Column, Column]:
    return lit(m[0]) * x + lit(m[1]) * y + lit(m[2]), lit(m[3]) * x + lit(m[4]) * y + lit(m[5])


def world_to_pixel(a: Sequence[Column], x: Column, y: Column) -> tuple[Column, Column]:
    """Inverse of a raster's affine transform (a, b, c, d, e, f): x = a col + b row + c, y = d col + e row + f. Null if it
    has none."""
    det = a[0] * a[4] - a[1] * a[3]
    dx, dy = x - a[2], y - a[5]
    return F.try_divide(a[4] * dx - a[1] * dy, det), F.try_divide(a[0] * dy - a[3] * dx, det)


def facade_score(area: Column, inside: Column, outside: Column, wall_area: Column, distance: Column) -> Column:
    n = F.greatest(area, F.lit(1)).cast("double")
    return 4.0 * (inside / n) + 3.0 * (inside / wall_area) - 2.0 * (outside / n) - distance + 0.15 * F.log1p(area.cast("double"))


# Transverse Mercator by Krueger's series in the third flattening; fixed values of the GRS80 ellipsoid and UTM zone 32.
_A, _F, _K0, _E0, _LON0 = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0, 9.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_utm(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Easting and northing (northern half) of a latitude and longitude."""
    k = 2 * _N**0.5 / (1 + _N)
    sine = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - k * F.atanh(k * sine))
    turn = F.radians(lon - _LON0)
    xi, eta = F.atan2(t, F.cos(turn)), F.atanh(F.sin(turn) / F.sqrt(1 + t * t))
    e, n = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _E0 + _K0 * _RADIUS * e, _K0 * _RADIUS * n


def from_utm(easting: Column, northing: Column) -> tuple[Column, Column]:
    """Latitude and longitude of an easting and northing (northern half)."""
    xi, eta = northing / (_K0 * _RADIUS), (easting - _E0) / (_K0 * _RADIUS)
    a, b = xi, eta
    for j, c in enumerate(_BETA, 1):
        a = a - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        b = b - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(a) / F.cosh(b))
    lat = chi
    for j, c in enumerate(_DELTA, 1):
        lat = lat + c * F.sin(2 * j * chi)
    return F.degrees(lat), _LON0 + F.degrees(F.atan2(F.sinh(b), F.cos(a)))

"""Vector, easing and colour expressions. Vectors are structs of x, y, z unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vec(x, y, z) -> Column:
    return F.struct(_lit(x).alias("x"), _lit(y).alias("y"), _lit(z).alias("z"))


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def minus(a: Column, b: Column) -> Column:
    return vec(a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"])


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def cross(a: Column, b: Column) -> Column:
    return vec(a["y"] * b["z"] - a["z"] * b["y"], a["z"] * b["x"] - a["x"] * b["z"], a["x"] * b["y"] - a["y"] * b["x"])


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """a over its length; a zero vector stays zero."""
    size = norm(a)
    by = F.when(size == 0, 1.0).otherwise(size)
    return vec(a["x"] / by, a["y"] / by, a["z"] / by)


def face_normal(a: Column, b: Column, c: Column) -> Column:
    """Unit normal of a triangle; zero for one without area."""
    return unit(cross(minus(b, a), minus(c, a)))


def to_game(east, north, height, e0: float, n0: float, h0: float) -> Column:
    """Map coordinates to y-up axes around an origin: x east, y up, z south."""
    return vec(_lit(east) - e0, _lit(height) - h0, -(_lit(north) - n0))


def smoothstep(t: Column) -> Column:
    c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return c * c * (3.0 - 2.0 * c)


def srgb_to_linear(value: Column) -> Column:
    """Linear light of an 8-bit sRGB value."""
    c = value / 255.0
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def bearing(east: Column, north: Column) -> Column:
    """Degrees clockwise from north, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def elevation(height: Column, distance: Column) -> Column:
    return F.degrees(F.asin(height / distance))


def octant(degrees: Column) -> Column:
    """0 is north, then clockwise by 45 degrees."""
    return F.floor(F.pmod(degrees + 22.5, F.lit(360.0)) / 45.0).cast("int")


def plane_key(nx: Column, ny: Column, offset: Column, angle_step: float = 0.09, offset_step: float = 0.6) -> Column:
    """Bucket of a vertical plane by its direction and distance, rounded half to even."""
    return F.struct(F.rint(F.atan2(ny, nx) / angle_step).cast("long").alias("direction"), F.rint(offset / offset_step).cast("long").alias("place"))


def fold_tilt(degrees: Column) -> Column:
    """An angle as a tilt of 0 to 180 degrees."""
    d = F.pmod(degrees, F.lit(360.0))
    return F.when(d > 180.0, 360.0 - d).otherwise(d)


def luminance(r: Column, g: Column, b: Column) -> Column:
    return (r + g + b) / 3.0


def project(point: Column, centre: Column, rotation: Column, f_px: Column) -> Column:
    """Pixel u, v from the image's middle, and depth, of a point in a pinhole camera.

    `rotation` is an array of three row arrays: right, down, forward.
    """
    d = minus(point, centre)
    axis = lambda k: rotation[k][0] * d["x"] + rotation[k][1] * d["y"] + rotation[k][2] * d["z"]
    depth = axis(2)
    by = F.when(F.abs(depth) < 1e-6, 1e-6).otherwise(depth)
    return F.struct((f_px * axis(0) / by).alias("u"), (f_px * axis(1) / by).alias("v"), depth.alias("depth"))


def planar_uv(x: Column, y: Column, z: Column, nx: Column, ny: Column, scale: float = 4.0) -> Column:
    """Texture coordinates: roofs from above, walls along the axis they face least."""
    roof = ny > 0.5
    across = F.when(F.abs(nx) > 0.5, z).otherwise(x)
    return F.struct((F.when(roof, x).otherwise(across) / scale).alias("u"), (F.when(roof, z).otherwise(y) / scale).alias("v"))


def rotate_yaw(yaw_deg: Column) -> tuple[Column, Column]:
    """Unit vectors through and across an upright frame turned by yaw."""
    a = F.radians(yaw_deg)
    return vec(F.sin(a), F.lit(0.0), -F.cos(a)), vec(F.cos(a), F.lit(0.0), F.sin(a))


def apply_matrix(m: Column, x: Column, y: Column, z: Column) -> Column:
    """A 4 x 4 matrix, 16 values column first, times a point."""
    row = lambda k: m[k] * x + m[k + 4] * y + m[k + 8] * z + m[k + 12]
    return vec(row(0), row(1), row(2))


def bound(value: Column, body) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def look_at(eye: Column, target: Column) -> Column:
    """Rows right, up, back (structs) of a view from eye to target, y up; a view along the axis uses north as up.

    Each step names the one before several times, so every step is bound: written out, the expression would not fit in memory.
    """
    over = lambda v, by: vec(v["x"] / by, v["y"] / by, v["z"] / by)
    ahead = lambda d: F.when(norm(d) < 1e-9, vec(0.0, 0.0, -1.0)).otherwise(over(d, norm(d)))
    up = lambda f: F.when(F.abs(f["y"]) > 0.999, vec(0.0, 0.0, -1.0)).otherwise(vec(0.0, 1.0, 0.0))
    rows = lambda f, r: F.struct(r.alias("right"), cross(r, f).alias("up"), vec(-f["x"], -f["y"], -f["z"]).alias("back"))
    side = lambda f: bound(up(f), lambda u: cross(f, u))
    view = lambda f: bound(bound(side(f), lambda s: over(s, F.greatest(norm(s), F.lit(1e-9)))), lambda r: rows(f, r))
    return bound(bound(minus(target, eye), ahead), view)


def perspective(fov_deg: Column, aspect: float, near: float, far: float) -> Column:
    """The five numbers of a projection matrix that are not 0, 1 or -1: x and y scale, depth scale and offset."""
    f = 1.0 / F.tan(F.radians(fov_deg) / 2.0)
    return F.struct((f / aspect).alias("sx"), f.alias("sy"), F.lit((far + near) / (near - far)).alias("sz"), F.lit(2.0 * far * near / (near - far)).alias("tz"))

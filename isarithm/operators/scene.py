"""Pieces of a whole scene: pictures, light, haze, horizon, gate boxes, and meshes put together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.operators import grid

Box = tuple[float, float, float, float]

# Where the sun stands, and the colours of gates and of the horizon.
SUN_AZIMUTH, SUN_ELEVATION = 150.0, 42.0
HORIZON_COLOUR = (176, 186, 194)
TEMPLATE_PREFIX = "z_"

#: Two triangles for each side of a box whose corner number has a bit for right, up and back, seen from outside.
BOX_FACES = ((0, 4, 6), (0, 6, 2), (1, 3, 7), (1, 7, 5), (0, 1, 5), (0, 5, 4), (2, 6, 7), (2, 7, 3), (0, 2, 3), (0, 3, 1), (4, 5, 7), (4, 7, 6))


def preview_pixel(x: Column, z: Column, box: Box, origin: tuple[float, float], size_px: int) -> Column:
    """Struct px, py: the place of a point in y-up axes in a picture of the box that is size_px wide."""
    width, height = box[2] - box[0], box[3] - box[1]
    tall = max(1, int(size_px * height / width))
    return F.struct(((x - (box[0] - origin[0])) * (size_px / width)).alias("px"), ((z + (box[3] - origin[1])) * (tall / height)).alias("py"))


def sun_direction(azimuth: Column | None = None, elevation: Column | None = None) -> Column:
    """Unit vector from the ground to the sun, y up."""
    a, e = F.radians(F.lit(SUN_AZIMUTH) if azimuth is None else azimuth), F.radians(F.lit(SUN_ELEVATION) if elevation is None else elevation)
    return G.vec(F.cos(e) * F.sin(a), F.sin(e), F.cos(e) * F.cos(a))


def fog(start: Column, end: Column, reach: Column) -> Column:
    """Struct near, far: the tour's own distances where it sets both, else at least multiples of the subject's distance."""
    own = (start > 0) & (end > 0)
    return F.struct(F.when(own, start).otherwise(F.greatest(start, reach * 1.5)).alias("near"), F.when(own, end).otherwise(F.greatest(end, reach * 8.0)).alias("far"))


def read_resolution(step: Column, native: Column) -> Column:
    """Cell size to read heights at: two cells a step, never finer than the data."""
    return F.greatest(native, step / 2.0)


def horizon(ground: DataFrame, low: tuple[float, float, float], high: tuple[float, float, float], reach: float = 12000.0, below: float = 3.0) -> DataFrame:
    """(vid, x, y, z): the corners of a square around the map, `below` its lowest ground (row, col, h); faces are 0 2 1 and 0 3 2."""
    x, z = (low[0] + high[0]) / 2, (low[2] + high[2]) / 2
    around = F.posexplode(F.array(*[F.struct(F.lit(x + i * reach).alias("x"), F.lit(z + k * reach).alias("z")) for i, k in ((-1, -1), (1, -1), (1, 1), (-1, 1))])).alias("vid", "p")
    return ground.agg((F.min("h") - below).alias("y")).select("y", around).select("vid", "p.x", "y", "p.z")


def checker(spark: SparkSession, size: int = 256, cells: int = 8) -> DataFrame:
    """(row, col, r, g, b): a board of orange and white squares, white first."""
    side = size // cells
    spot = spark.range(size * size).select(F.floor(F.col("id") / size).cast("int").alias("row"), (F.col("id") % size).cast("int").alias("col"))
    odd = (F.floor(F.col("row") / side) + F.floor(F.col("col") / side)) % 2 == 1
    return spot.select("row", "col", *[F.when(odd, a).otherwise(b).alias(c) for c, a, b in (("r", 255, 250), ("g", 120, 250), ("b", 0, 250))])


def material(name: Column, r: Column, g: Column, b: Column) -> Column:
    """A plain material of an 8-bit colour: linear base colour, no metal, fully rough."""
    return F.struct(name.alias("name"), F.array(*[G.srgb_to_linear(c) for c in (r, g, b)], F.lit(1.0)).alias("base"), F.lit(0.0).alias("metallic"), F.lit(1.0).alias("roughness"))


def is_template(name: Column) -> Column:
    """Whether a material is one that the game replaces."""
    return name.startswith(TEMPLATE_PREFIX)


def is_page(content_type: Column) -> Column:
    """Whether a download is a web page, whatever parameters its type has."""
    return F.lower(F.trim(F.split(content_type, ";")[0])).startswith("text/html")


def checked_file(content_type: Column, url: Column) -> Column:
    """The address; an error where a page came in place of a file. A missing type passes."""
    return F.when(F.coalesce(is_page(content_type), F.lit(False)), F.raise_error(F.concat(F.lit("a page in place of a file: "), url)).cast("string")).otherwise(url)


def build_stamp(at: Column | None = None) -> Column:
    """UTC time of a build as text, to the second."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp() if at is None else at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def orthophoto(cells: DataFrame, box: Box, size_px: int, bands: tuple[str, ...] = ("r", "g", "b"), order: str = "sheet") -> DataFrame:
    """(row, col, bands): a whole picture of size_px squared over the box, of sheet cells (sheet, x, y, bands) of finer resolution.

    A pixel takes the means of the first sheet that covers it, cut to 0 to 255 and truncated; one that none covers is 0.
    """
    xmin, ymin, xmax, ymax = box
    row, col = F.floor((ymax - F.col("y")) / ((ymax - ymin) / size_px)).cast("int"), F.floor((F.col("x") - xmin) / ((xmax - xmin) / size_px)).cast("int")
    placed = cells.withColumns({"row": row, "col": col}).where(grid.inside(size_px, size_px))
    means = placed.groupBy("row", "col", order).agg(*[F.avg(b).alias(b) for b in bands])
    first = means.groupBy("row", "col").agg(F.min_by(F.struct(*bands), order).alias("p"))
    whole = grid.spine(cells, size_px, size_px).join(first, ["row", "col"], "left")
    return whole.select("row", "col", *[F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.col(f"p.{b}"))).cast("int"), F.lit(0)).alias(b) for b in bands])


def tile_up(targets: DataFrame, donors: DataFrame, values: list[str]) -> DataFrame:
    """(panel, row, col, values): panels filled with their donor's texels, repeated from the bottom row up and from the left.

    targets: panel, donor, height, width; donors: donor, row, col, d_height, d_width and the values; row 0 is the top.
    """
    rows = targets.join(donors.select("donor", "d_height", "d_width").distinct(), "donor")
    cells = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("_r")).select("*", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("_c"))
    asked = cells.select("panel", "donor", "_r", "_c", F.pmod(F.col("_r") - F.col("height"), F.col("d_height")).alias("row"), F.pmod("_c", "d_width").alias("col"))
    return asked.join(donors.select("donor", "row", "col", *values), ["donor", "row", "col"]).select("panel", F.col("_r").alias("row"), F.col("_c").alias("col"), *values)


def gate_faces(bars: DataFrame) -> DataFrame:
    """(mesh, fid, a, b, c): the twelve triangles of every bar of gates (ord, bar), over its corner numbers; gates count from 1."""
    name = F.format_string("course_gate%02d_%s", F.col("ord").cast("int"), F.col("bar"))
    faces = F.posexplode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip("abc", f, strict=True)]) for f in BOX_FACES])).alias("fid", "f")
    return bars.select("ord", "bar").distinct().select(name.alias("mesh"), faces).select("mesh", "fid", "f.a", "f.b", "f.c")


def assemble(parts: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """All vertices (mesh, vid, x, y, z, u, v) and faces (mesh, a, b, c) of a map's parts; vertices without u and v get zeros."""
    place = lambda df: df.select("mesh", F.col("vid").cast("long").alias("vid"), *[(F.col(c) if c in df.columns else F.lit(0.0)).cast("double").alias(c) for c in ("x", "y", "z", "u", "v")])
    corner = lambda df: df.select("mesh", *[F.col(c).cast("long").alias(c) for c in "abc"])
    return reduce(DataFrame.unionByName, [place(v) for v, _ in parts]), reduce(DataFrame.unionByName, [corner(f) for _, f in parts])


def mesh_report(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """(mesh, vertices, triangles, low, high) of every named mesh; one without faces has 0 triangles."""
    end = lambda kind: F.array(*[kind(c) for c in "xyz"])
    spans = vertices.groupBy("mesh").agg(F.count("*").alias("vertices"), end(F.min).alias("low"), end(F.max).alias("high"))
    count = faces.groupBy("mesh").agg(F.count("*").alias("triangles"))
    return spans.join(count, "mesh", "left").select("mesh", "vertices", F.coalesce("triangles", F.lit(0)).alias("triangles"), "low", "high")

"""Triangle meshes as vertex and face tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isarithm.functions import geometry as G


def lattice(spark, box: tuple[float, float, float, float], step: float) -> DataFrame:
    """(i, j, x, y, u, v): evenly spaced points over a box, at about `step`; v grows to the south."""
    xmin, ymin, xmax, ymax = box
    nx, ny = max(2, round((xmax - xmin) / step) + 1), max(2, round((ymax - ymin) / step) + 1)
    rows = spark.range(nx * ny).select(F.floor(F.col("id") / nx).cast("int").alias("i"), (F.col("id") % nx).cast("int").alias("j"))
    u, v = F.col("j") / (nx - 1), F.col("i") / (ny - 1)
    return rows.select("i", "j", (xmin + u * (xmax - xmin)).alias("x"), (ymax - v * (ymax - ymin)).alias("y"), u.alias("u"), v.alias("v"))


def lattice_faces(spark, rows: int, cols: int) -> DataFrame:
    """(fid, a, b, c): two triangles per lattice cell; all first triangles come before all second ones."""
    n = (rows - 1) * (cols - 1)
    cell = spark.range(n).select("id", (F.floor(F.col("id") / (cols - 1)) * cols + F.col("id") % (cols - 1)).cast("long").alias("p"))
    tri = lambda shift, *at: F.struct((F.col("id") + shift).alias("fid"), *[(F.col("p") + d).alias(k) for k, d in zip("abc", at, strict=True)])
    both = F.array(tri(0, 0, cols, 1), tri(n, 1, cols, cols + 1))
    return cell.select(F.explode(both).alias("t")).select("t.*")


def fan(ring: Column) -> Column:
    """Triangles (structs a, b, c) of a polygon's ring of vertices, all from its first one."""
    n = F.size(ring)
    first_last = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(first_last, lambda i: F.struct(ring[0].alias("a"), ring[i].alias("b"), ring[i + 1].alias("c")))


def corners(faces: DataFrame, vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Faces (keys, fid, a, b, c) with their corners' coordinates pa, pb, pc (structs)."""
    long = faces.select(*keys, "fid", F.posexplode(F.array("a", "b", "c")).alias("k", "vid"))
    met = long.join(vertices.select(*keys, "vid", F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("z").cast("double").alias("z")).alias("p")), [*keys, "vid"])
    at = lambda k: F.max(F.when(F.col("k") == k, F.col("p")))
    return met.groupBy(*keys, "fid").agg(at(0).alias("pa"), at(1).alias("pb"), at(2).alias("pc"))


def with_normals(cornered: DataFrame) -> DataFrame:
    """Adds the unit normal n of faces that have pa, pb, pc; zero without area."""
    return cornered.withColumn("n", G.face_normal(F.col("pa"), F.col("pb"), F.col("pc")))


def vertex_normals(faces: DataFrame, vertices: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, vid, n): the unit sum of the face normals around a vertex, weighted by area."""
    raw = corners(faces, vertices, keys).withColumn("w", G.cross(G.minus(F.col("pb"), F.col("pa")), G.minus(F.col("pc"), F.col("pa"))))
    spread = faces.select(*keys, "fid", F.explode(F.array("a", "b", "c")).alias("vid")).join(raw.select(*keys, "fid", "w"), [*keys, "fid"])
    total = spread.groupBy(*keys, "vid").agg(*[F.sum(f"w.{c}").alias(c) for c in "xyz"])
    return total.select(*keys, "vid", G.unit(F.struct("x", "y", "z")).alias("n"))


def classify(cornered: DataFrame, roof: float = 0.5) -> DataFrame:
    """Adds part, roof or wall, of faces in y-up axes."""
    return with_normals(cornered).withColumn("part", F.when(F.col("n.y") > roof, "roof").otherwise("wall"))


def centroids(faces: DataFrame, vertices: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x, y): mean of the different vertices that faces use."""
    used = faces.select(*keys, F.explode(F.array("a", "b", "c")).alias("vid")).distinct()
    return used.join(vertices, [*keys, "vid"]).groupBy(*keys).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def chunk(x: Column, y: Column, box: tuple[float, float, float, float], rows: int, cols: int) -> tuple[Column, Column, Column]:
    """Row, column and name of the chunk that holds a place; places outside go to the chunk at the border."""
    xmin, ymin, xmax, ymax = box
    clamp = lambda v, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), v.cast("int")))
    r, c = clamp(F.floor((ymax - y) / (ymax - ymin) * rows), rows), clamp(F.floor((x - xmin) / (xmax - xmin) * cols), cols)
    return r, c, F.format_string("r%02dc%02d", r, c)


def chunk_shape(box: tuple[float, float, float, float], size: float) -> tuple[int, int]:
    """Rows and columns of chunks of about `size` over a box."""
    xmin, ymin, xmax, ymax = box
    return max(1, round((ymax - ymin) / size)), max(1, round((xmax - xmin) / size))


def gate_bars(gates: DataFrame) -> DataFrame:
    """(ord, bar, corner, x, y, z): the eight corners of the four bars of every gate, turned about its middle.

    A gate has ord, x, y (the middle's height), z, size, bar and yaw_deg; the bars frame the opening.
    """
    off, long = F.col("size") / 2 + F.col("bar") / 2, F.col("size") + 2 * F.col("bar")
    spec = lambda name, cx, cy, sx, sy: F.struct(F.lit(name).alias("bar"), cx.alias("cx"), cy.alias("cy"), sx.alias("sx"), sy.alias("sy"))
    zero, thin = F.lit(0.0), F.col("bar")
    four = F.array(spec("left", -off, zero, thin, long), spec("right", off, zero, thin, long), spec("top", zero, off, long, thin), spec("bottom", zero, -off, long, thin))
    rows = gates.select("ord", "x", "y", "z", thin.alias("deep"), "yaw_deg", F.explode(four).alias("b")).select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("corner"))
    sign = lambda bit: F.when(F.col("corner").bitwiseAND(F.lit(bit)) > 0, 0.5).otherwise(-0.5)
    side, up, deep = F.col("b.cx") + sign(1) * F.col("b.sx"), F.col("b.cy") + sign(2) * F.col("b.sy"), sign(4) * F.col("deep")
    s, c = F.sin(F.radians("yaw_deg")), F.cos(F.radians("yaw_deg"))
    return rows.select("ord", "b.bar", "corner", (F.col("x") + side * c + deep * s).alias("x"), (F.col("y") + up).alias("y"), (F.col("z") - side * s + deep * c).alias("z"))

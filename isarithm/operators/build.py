"""A whole map: terrain, buildings, survey tiles and a course as named meshes, and its report.

Each part is a pair of tables, vertices (mesh, vid, x, y, z, u, v) and faces (mesh, a, b, c), in y-up axes
around the origin; `scene.assemble` joins them. Nothing but the origin's height and the report's one row
reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.lineage import settle
from isarithm.operators import grid, maps, mesh, scene, sequence, spatial, tree

Box = tuple[float, float, float, float]
Part = tuple[DataFrame, DataFrame]


@dataclass(frozen=True)
class Heights:
    """A raster (row, col, h) of cells of `res` whose upper left corner is (west, north)."""

    raster: DataFrame
    west: float
    north: float
    res: float
    rows: int
    cols: int

    def at(self, points: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
        """(key, h): the height at places, between the middles of cells."""
        fr, fc = (self.north - F.col(y)) / self.res - 0.5, (F.col(x) - self.west) / self.res - 0.5
        return grid.bilinear(points, self.raster, key, fr, fc, self.rows, self.cols)


def heights(cells: DataFrame, box: Box, res: float, pad: float = 4.0, shift: float = 0.0) -> Heights:
    """The raster of sheet cells (sheet, x, y, h) over a padded box, moved by `shift`."""
    rows, cols = maps.shape((box[0] - pad, box[1] - pad, box[2] + pad, box[3] + pad), res)
    raster = maps.elevation(cells, box, res, pad).select("row", "col", (F.col("h") + shift).alias("h"))
    return Heights(settle(raster), box[0] - pad, box[3] + pad, res, rows, cols)


def terrain(spark: SparkSession, field: Heights, box: Box, origin: tuple[float, float, float], step: float, size: float, sink: float = 0.0) -> Part:
    """The ground's chunks of about `size`, or one mesh for a size of 0; `sink` lowers them under a survey."""
    points, faces = maps.terrain_chunks(spark, box, step, size)
    cols = max(2, round((box[2] - box[0]) / step) + 1)
    name = F.col("chunk") if size > 0 else F.lit("terrain")
    key = [F.col("i"), F.col("j")]
    lattice = field.at(mesh.lattice(spark, box, step), ["i", "j"], "x", "y")
    p = G.to_game(F.col("x"), F.col("y"), F.col("h") - sink, *origin)
    placed = points.join(lattice, ["i", "j"]).select(name.alias("mesh"), (key[0] * cols + key[1]).alias("vid"), p.alias("p"), "u", "v")
    return placed.select("mesh", "vid", "p.x", "p.y", "p.z", "u", "v"), faces.select(name.alias("mesh"), "a", "b", "c")


def buildings(faces: DataFrame, vertices: DataFrame, keys: list[str], box: Box, origin: tuple[float, float, float], size: float = 0.0, scale: float = 4.0, photo_roofs: bool = False) -> Part:
    """Walls and roofs of the buildings whose centroid is in the box, by chunk of the centroid.

    Meshes are named after chunk and part; a size of 0 makes one of each part. Faces have keys, fid, a, b, c,
    vertices keys, vid, x, y, z (z up).
    """
    held = maps.buildings_inside(faces, vertices, keys, box)
    rows, cols = mesh.chunk_shape(box, size) if size > 0 else (1, 1)
    name = mesh.chunk(F.col("x"), F.col("y"), box, rows, cols)[2]
    prefix = F.concat(F.lit("buildings_"), name, F.lit("_")) if size > 0 else F.lit("buildings_")
    cornered = mesh.corners(faces, vertices, keys).join(held.select(*keys, prefix.alias("prefix")), keys)
    # Numbers differ between runs of a plan, so it runs once.
    numbered = settle(cornered.select("prefix", F.monotonically_increasing_id().alias("fid"), "pa", "pb", "pc"))
    made = maps.building_meshes(numbered, origin, scale, box if photo_roofs else None, keys=("prefix",))
    return _triangles(made.withColumn("mesh", F.concat("prefix", "part")))


def _triangles(rows: DataFrame) -> Part:
    """Unwelded triangles (mesh, fid, corner, p, uv), fid unique, as vertices and faces."""
    v = (F.col("fid") * 3).alias("a")
    return rows.select("mesh", (F.col("fid") * 3 + F.col("corner")).alias("vid"), "p.x", "p.y", "p.z", "uv.u", "uv.v"), rows.where("corner = 0").select("mesh", v, (v + 1).alias("b"), (v + 2).alias("c"))


def survey(nodes: DataFrame, primitives: DataFrame, transforms: DataFrame, most_error: float, origin: tuple[float, float, float], shift: float = 0.0, box: Box | None = None) -> Part:
    """The tiles of the cut at an error, each primitive a mesh; those whose box does not touch `box` are dropped.

    nodes as `files.tile_nodes` reads them, primitives as `gltf.meshes`, transforms block and m. Textures stay in the tiles.
    """
    taken = tree.tree_cut(nodes, most_error).join(nodes.select("block", "node", "uri"), ["block", "node"]).select("block", F.col("uri").alias("path"))
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    name = F.concat(F.lit("mesh_"), F.concat_ws("_", stem, F.col("mesh_index").cast("string"), F.col("part").cast("string")))
    tiles = taken.join(primitives.drop("mesh"), "path").withColumn("mesh", name)
    points = tiles.select("block", "mesh", "uv", F.posexplode("positions").alias("vid", "q"))
    local = points.select("block", "mesh", "vid", *[F.col("q")[k].alias(c) for k, c in enumerate("xyz")])
    placed = maps.survey_vertices(local, transforms, origin, shift, box)
    painted = points.select("mesh", "vid", *[F.get(F.get("uv", F.col("vid")), F.lit(k)).alias(c) for k, c in enumerate("uv")])
    faces = tiles.select("mesh", F.explode("faces").alias("f")).select("mesh", *[F.col("f")[k].alias(c) for k, c in enumerate("abc")])
    vertices = placed.join(painted, ["mesh", "vid"]).select("mesh", "vid", "p.x", "p.y", "p.z", F.coalesce("u", F.lit(0.0)).alias("u"), F.coalesce("v", F.lit(0.0)).alias("v"))
    return vertices, faces.join(placed.select("mesh").distinct(), "mesh", "left_semi")


def course(gates: DataFrame, field: Heights, origin: tuple[float, float, float]) -> tuple[Part, DataFrame]:
    """The gates' bars as meshes, and the gates where they stand: ord, x, y, z, size, bar, yaw_deg.

    Gates have ord, east, north, height_m over the ground, size_m, bar_m and yaw_deg.
    """
    spot = G.to_game(F.col("east"), F.col("north"), F.col("h") + F.col("height_m"), *origin)
    ground = field.at(gates, ["ord"], "east", "north")
    standing = gates.join(ground, "ord").select("ord", spot.alias("p"), F.col("size_m").alias("size"), F.col("bar_m").alias("bar"), "yaw_deg").select("ord", "p.x", "p.y", "p.z", "size", "bar", "yaw_deg")
    bars = mesh.gate_bars(standing)
    name = F.format_string("course_gate%02d_%s", F.col("ord").cast("int"), F.col("bar"))
    return (bars.select(name.alias("mesh"), F.col("corner").alias("vid"), "x", "y", "z"), scene.gate_faces(bars)), standing


def walls(panels: DataFrame, packed: DataFrame, faces: DataFrame, atlas: tuple[int, int], origin: tuple[float, float, float]) -> Part:
    """`buildings_walls` with the atlas on it: the triangles of panels (panel, origin, u_axis, width, height).

    packed: panel, x, y, w, h in pixels; faces: panel, fid, pa, pb, pc in z-up axes.
    """
    rows = faces.join(panels.select("panel", F.col("origin").alias("o"), F.col("u_axis").alias("ua"), "width", "height"), "panel").join(packed.select("panel", "x", "y", "w", "h"), "panel")
    rows = settle(rows.withColumn("fid", F.monotonically_increasing_id()))
    spread = rows.select("*", F.posexplode(F.array("pa", "pb", "pc")).alias("corner", "q")).withColumn("from", G.minus(F.col("q"), F.col("o")))
    uv = maps.atlas_uv(F.col("x"), F.col("y"), F.col("w"), F.col("h"), G.dot(F.col("from"), F.col("ua")), F.col("from.z"), F.col("width"), F.col("height"), atlas)
    return _triangles(spread.select(F.lit("buildings_walls").alias("mesh"), "fid", "corner", G.to_game(F.col("q.x"), F.col("q.y"), F.col("q.z"), *origin).alias("p"), uv.alias("uv")))


def coverage(panels: DataFrame, covered: DataFrame) -> DataFrame:
    """(panels, panels_with_photo, area_weighted_coverage) of panels (panel, width, height) and covered (panel, coverage)."""
    rows = panels.join(covered.select("panel", "coverage").distinct(), "panel", "left").withColumns({"area": F.col("width") * F.col("height"), "coverage": F.coalesce("coverage", F.lit(0.0))})
    return rows.agg(F.count("*").alias("panels"), F.count_if(F.col("coverage") > 0).alias("panels_with_photo"), F.round(F.try_divide(F.sum(F.col("coverage") * F.col("area")), F.sum("area")), 4).alias("area_weighted_coverage"))


def build_map(
    spark: SparkSession, name: str, box: Box, spot: tuple[float, float], field: Heights, step: float, size: float, *, sink: float = 0.0,
    houses: tuple[DataFrame, DataFrame, list[str]] | None = None, photo_roofs: bool = False, parts: tuple[Part, ...] = (), gates: DataFrame | None = None, private: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All vertices and faces of a map around `spot`, and its report in one row.

    houses: faces, vertices and keys of buildings; parts: others that are ready, as survey tiles or painted walls. The
    report tells the gates that geometry other than the course blocks. A private one tells no place.
    """
    here = field.at(spark.range(1).select(F.lit(0).alias("at"), F.lit(float(spot[0])).alias("x"), F.lit(float(spot[1])).alias("y")), ["at"], "x", "y").first()["h"]
    origin = (float(spot[0]), float(spot[1]), float(here))
    ground = terrain(spark, field, box, origin, step, size, sink)
    every: list[Part] = [ground, *parts]
    if houses is not None:
        every.append(buildings(*houses, box, origin, size, photo_roofs=photo_roofs))
    told = {"map": F.lit(name), "area_km2": F.lit(round((box[2] - box[0]) * (box[3] - box[1]) / 1e6, 2)), "terrain_step_m": F.lit(float(step)), "chunk_m": F.lit(float(size)), "built_at": scene.build_stamp()}
    if not private:
        told |= {"bbox": F.array(*[F.lit(float(v)) for v in box]), "origin": F.array(*[F.lit(v) for v in origin])}
    lines = [spark.range(1).select(*[c.alias(k) for k, c in told.items()], F.lit(private).alias("private"))]
    if houses is not None:
        lines.append(maps.buildings_inside(*houses, box).agg(F.count("*").alias("buildings_in_bbox")))
    if gates is not None:
        bars, standing = course(gates, field, origin)
        clear = spatial.box_counts(standing, scene.assemble(every)[0], "ord", 16.0)
        lap = sequence.ring_length(gates.withColumn("_", F.lit(0)), ["_"], ["ord"], "east", "north").select(F.col("n").alias("gates"), F.round("length", 1).alias("lap_length_m"))
        lines += [lap, clear.agg(F.array_sort(F.collect_list(F.when(~F.col("clear"), F.col("ord")))).alias("blocked_gates"))]
        every.append(bars)
    vertices, faces = scene.assemble(every)
    lines += [vertices.agg(F.count("*").alias("vertices"), F.count_distinct("mesh").alias("meshes")), faces.agg(F.count("*").alias("triangles"))]
    # Each line is one row; they meet on a constant.
    return vertices, faces, reduce(lambda a, b: a.join(b, "_k"), [row.withColumn("_k", F.lit(0)) for row in lines]).drop("_k")

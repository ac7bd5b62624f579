"""Whole stages of a map, composed of the operators: terrain, buildings, surveys, courses, facades, tours."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.functions import projection as P
from isarithm.lineage import settle
from isarithm.operators import facade, grid, mesh, select, sequence, spatial
from isarithm.operators.quantile import exact_median

Box = tuple[float, float, float, float]


def shape(box: Box, res: float) -> tuple[int, int]:
    """Rows and columns of a grid over a box."""
    return max(1, round((box[3] - box[1]) / res)), max(1, round((box[2] - box[0]) / res))


def elevation(cells: DataFrame, box: Box, res: float, pad: float = 4.0) -> DataFrame:
    """A whole raster (row, col, h) over the padded box, of sheet cells (sheet, x, y, h) of any finer resolution.

    A target cell takes the mean of the first sheet that covers it; cells that none covers take the median.
    """
    xmin, ymin, xmax, ymax = box[0] - pad, box[1] - pad, box[2] + pad, box[3] + pad
    rows, cols = shape((xmin, ymin, xmax, ymax), res)
    r, c = grid.floor_cell(F.col("x"), F.col("y"), xmin, ymax, res)
    placed = cells.where(F.col("h").isNotNull() & ~F.isnan("h")).withColumns({"row": r, "col": c}).where(grid.inside(rows, cols))
    means = placed.groupBy("row", "col", "sheet").agg(F.avg("h").alias("h"))
    found = settle(grid.mosaic_first(means, ["sheet"]))
    return grid.dense(found, rows, cols, exact_median(found, F.col("h")) or 0.0)


def warp(cells: DataFrame, place: tuple[Column, Column], box: Box, rows: int, cols: int, values: list[str], order: str = "sheet") -> DataFrame:
    """Sheets in any projection on a grid over a box: means per sheet and cell, the last covering sheet wins.

    `place` gives east and north of a cell as expressions; cells that no sheet covers are absent.
    """
    xmin, ymin, xmax, ymax = box
    east, north = place
    spot = {"row": F.floor((ymax - north) / ((ymax - ymin) / rows)).cast("int"), "col": F.floor((east - xmin) / ((xmax - xmin) / cols)).cast("int")}
    placed = cells.withColumns(spot).where(grid.inside(rows, cols))
    for v in values:
        placed = placed.where(F.col(v).isNotNull() & ~F.isnan(F.col(v).cast("double")))
    means = placed.groupBy("row", "col", order).agg(*[F.avg(v).alias(v) for v in values])
    return means.groupBy("row", "col").agg(*[F.max_by(v, order).alias(v) for v in values])


def ground_raster(vertices: DataFrame, step: float = 4.0) -> tuple[DataFrame, dict]:
    """Highest vertex per nearest cell of (x, y, z), y up, and the grid; cells without one take the median height."""
    xmin, zmin, xmax, zmax = vertices.agg(F.min("x"), F.min("z"), F.max("x"), F.max("z")).first()
    if xmin is None:
        raise ValueError("the terrain has no vertices")
    cols, rows = max(1, math.ceil((xmax - xmin) / step) + 1), max(1, math.ceil((zmax - zmin) / step) + 1)
    r, c = grid.nearest_cell(F.col("x"), F.col("z"), xmin, zmin, step)
    top = vertices.withColumns({"row": F.least(r, F.lit(rows - 1)), "col": F.least(c, F.lit(cols - 1))}).groupBy("row", "col").agg(F.max("y").alias("h"))
    return grid.dense(top, rows, cols, exact_median(vertices, F.col("y"))), {"x0": xmin, "z0": zmin, "step": step, "rows": rows, "cols": cols}


def on_ground(points: DataFrame, raster: DataFrame, g: dict, x: Column, z: Column, out: str) -> DataFrame:
    """Adds the ground's height under points, clamped to the raster."""
    fr, fc = (z - g["z0"]) / g["step"], (x - g["x0"]) / g["step"]
    return grid.sample_nearest(points, raster.withColumnRenamed("h", out), fr, fc, g["rows"], g["cols"], out).drop("row", "col")


def tall_points(structures: DataFrame, ground: DataFrame, g: dict, count: int = 3, step: float = 8.0, apart: float = 150.0) -> DataFrame:
    """(place, x, z, height) of the highest structures over the ground, each a square of +-apart away from those before."""
    xmin, zmin = structures.agg(F.min("x"), F.min("z")).first()
    r, c = grid.truncated_cell(F.col("x"), F.col("z"), xmin or 0.0, zmin or 0.0, step)
    top = structures.withColumns({"row": r, "col": c}).groupBy("row", "col").agg(F.max("y").alias("top"))
    x, z = xmin_plus(xmin, "col", step), xmin_plus(zmin, "row", step)
    placed = on_ground(top.withColumns({"x": x, "z": z, "r": F.col("row"), "c": F.col("col")}).drop("row", "col"), ground, g, F.col("x"), F.col("z"), "under")
    above = settle(placed.select(F.col("r").alias("row"), F.col("c").alias("col"), (F.col("top") - F.col("under")).alias("h")))
    picks = select.spaced_maxima(above, count, max(1, int(apart / step)))
    return picks.select("place", xmin_plus(xmin, "col", step).alias("x"), xmin_plus(zmin, "row", step).alias("z"), F.col("h").alias("height"))


def xmin_plus(low: float | None, cell: str, step: float) -> Column:
    return F.col(cell) * step + (low or 0.0)


def terrain_chunks(spark: SparkSession, box: Box, step: float, size: float) -> tuple[DataFrame, DataFrame]:
    """(points, faces) of a lattice in chunks that share their border points.

    points: chunk, i, j, x, y, u, v; faces: chunk and the lattice points a, b, c, two for each cell.
    """
    points = mesh.lattice(spark, box, step)
    nx, ny = max(2, round((box[2] - box[0]) / step) + 1), max(2, round((box[3] - box[1]) / step) + 1)
    rows, cols = mesh.chunk_shape(box, size) if size > 0 else (1, 1)
    dealt = sequence.split_shared(sequence.split_shared(points, "i", ny - 1, rows, "r"), "j", nx - 1, cols, "c")
    named = F.format_string("terrain_r%02dc%02d", "r", "c")
    edges = lambda n, parts: F.array(*[F.lit(b) for _, b in sequence.even_runs(n, parts)])
    own = lambda at, n, parts: F.size(F.filter(edges(n, parts), lambda e: e <= at))
    faces = mesh.lattice_faces(spark, ny, nx)
    corner = F.least("a", "b", "c")  # a cell's first point; a second triangle's least point is right of it
    cell = F.when(F.col("fid") < (nx - 1) * (ny - 1), corner).otherwise(corner - 1)
    r, c = own(F.floor(cell / nx), ny - 1, rows), own(cell % nx, nx - 1, cols)
    return dealt.select(named.alias("chunk"), "i", "j", "x", "y", "u", "v"), faces.select(F.format_string("terrain_r%02dc%02d", r, c).alias("chunk"), "a", "b", "c")


def building_meshes(cornered: DataFrame, origin: tuple[float, float, float], scale: float = 4.0, roof_box: Box | None = None, roof: float = 0.5, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, part, fid, corner, p, uv): unwelded triangles of walls and roofs in y-up axes, from z-up faces with pa, pb, pc.

    With `roof_box` roofs take their picture from straight above.
    """
    e0, n0, h0 = origin
    game = cornered.select(*keys, "fid", *[G.to_game(F.col(f"{k}.x"), F.col(f"{k}.y"), F.col(f"{k}.z"), e0, n0, h0).alias(k) for k in ("pa", "pb", "pc")])
    parts = mesh.classify(game, roof)
    rows = parts.select(*keys, F.concat("part", F.lit("s")).alias("part"), "fid", "n", F.posexplode(F.array("pa", "pb", "pc")).alias("corner", "p"))
    uv = G.planar_uv(F.col("p.x"), F.col("p.y"), F.col("p.z"), F.col("n.x"), F.col("n.y"), scale)
    if roof_box is not None:
        xmin, ymin, xmax, ymax = roof_box
        above = F.struct(((F.col("p.x") + e0 - xmin) / (xmax - xmin)).alias("u"), ((ymax - (n0 - F.col("p.z"))) / (ymax - ymin)).alias("v"))
        uv = F.when(F.col("part") == "roofs", above).otherwise(uv)
    return rows.select(*keys, "part", "fid", "corner", "p", uv.alias("uv"))


def buildings_inside(faces: DataFrame, vertices: DataFrame, keys: list[str], box: Box) -> DataFrame:
    """Keys and centroids of the buildings whose centroid lies in the box, borders included."""
    return spatial.inside_box(mesh.centroids(faces, vertices, keys), "x", "y", box)


def survey_vertices(tiles: DataFrame, transforms: DataFrame, origin: tuple[float, float, float], shift: float = 0.0, box: Box | None = None) -> DataFrame:
    """(mesh, vid, p): tile vertices in y-up axes; tiles whose box does not touch `box` are dropped.

    Tiles have block, mesh, vid and local x, y, z; transforms have block and m, 16 values column first.
    """
    earth = tiles.join(transforms, "block").withColumn("e", G.apply_matrix(F.col("m"), F.col("x"), F.col("y"), F.col("z")))
    east, north, up = P.geocentric_to_conic(F.col("e.x"), F.col("e.y"), F.col("e.z"))
    placed = earth.select("mesh", "vid", east.alias("east"), north.alias("north"), (up + shift).alias("up"))
    if box is not None:
        spans = placed.groupBy("mesh").agg(F.min("east").alias("x0"), F.max("east").alias("x1"), F.min("north").alias("y0"), F.max("north").alias("y1"))
        near = spans.where((F.col("x1") >= box[0]) & (F.col("x0") <= box[2]) & (F.col("y1") >= box[1]) & (F.col("y0") <= box[3])).select("mesh")
        placed = placed.join(near, "mesh", "left_semi")
    return placed.select("mesh", "vid", G.to_game(F.col("east"), F.col("north"), F.col("up"), *origin).alias("p"))


def clearance(gates: DataFrame, vertices: DataFrame, ground: DataFrame, g: dict, origin: tuple[float, float], cell: float = 16.0) -> DataFrame:
    """(ord, in_opening, in_approach, clear) of gates (ord, east, north, height_m, size_m, yaw_deg) over the ground.

    `vertices` has mesh, x, y, z in y-up axes; the course's own meshes are no obstacles.
    """
    placed = gates.select("ord", (F.col("east") - origin[0]).alias("x"), (origin[1] - F.col("north")).alias("z"), F.col("size_m").alias("size"), "yaw_deg", "height_m")
    standing = on_ground(placed, ground, g, F.col("x"), F.col("z"), "floor").withColumn("y", F.col("floor") + F.col("height_m"))
    return spatial.box_counts(standing, vertices.where(~F.col("mesh").startswith("course_")), "ord", cell)


def control_points(spark: SparkSession, box: Box, hull_rows: DataFrame, n: int = 180, inset: float = 5.0, buffer: float = 12.0) -> DataFrame:
    """(id, x, y): an n x n lattice inside the box without the points near buildings."""
    xmin, ymin, xmax, ymax = box[0] + inset, box[1] + inset, box[2] - inset, box[3] - inset
    j, i = F.col("id") % n, F.floor(F.col("id") / n)
    points = spark.range(n * n).select("id", (xmin + j * (xmax - xmin) / max(1, n - 1)).alias("x"), (ymax - i * (ymax - ymin) / max(1, n - 1)).alias("y"))
    return spatial.outside_hulls(points, hull_rows, "x", "y", buffer, max(50.0, 4 * buffer))


def panel_samples(panels: DataFrame, key: str, step: float = 1.5) -> DataFrame:
    """(key, nu, nv, iu, iv, p): the middles of a coarse grid of cells over each panel."""
    n = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / step).cast("int"))
    rows = panels.withColumns({"nu": n("width"), "nv": n("height")}).select("*", F.explode(F.sequence(F.lit(0), F.col("nu") - 1)).alias("iu")).select("*", F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("iv"))
    u, v = (F.col("iu") + 0.5) * F.col("width") / F.col("nu"), (F.col("iv") + 0.5) * F.col("height") / F.col("nv")
    up = lambda c: F.col(f"origin.{c}") + u * F.col(f"u_axis.{c}")
    return rows.select(key, "nu", "nv", "iu", "iv", G.vec(up("x"), up("y"), up("z") + v).alias("p"))


def coarse_cell(px: Column, size: Column, n: Column) -> Column:
    """The coarse cell, of n, of a texel's middle among `size` texels."""
    return F.greatest(F.lit(0), F.least(n - 1, ((px + 0.5) / size * n).cast("int")))


def atlas_uv(x: Column, y: Column, w: Column, h: Column, u: Column, v: Column, width: Column, height: Column, atlas: tuple[int, int]) -> Column:
    """Atlas coordinates of a place (u, v) in metres on a panel that is packed at (x, y, w, h)."""
    small = F.lit(1e-6)
    return F.struct(((x + w * (u / F.greatest(width, small))) / atlas[0]).alias("u"), ((y + h * (1.0 - v / F.greatest(height, small))) / atlas[1]).alias("v"))


def bake(texels: DataFrame, scores: DataFrame, panels: DataFrame, value: str = "value") -> DataFrame:
    """(panel, texel, value, coverage): colours of all texels of all panels.

    texels: panel, texel, source, value (null where the source does not see it), a row per texel and source;
    scores: panel, source, score; panels: panel, building, area and origin. A texel is the blend of the
    sources that see it; gaps take their panel's mean; a panel that no source sees takes the mean of its
    building's best panel, else of the nearest covered one, else of all.
    """
    weights = facade.blend_weights(scores, "panel").select("panel", "source", "weight")
    seen = texels.where(F.col(value).isNotNull()).join(weights, ["panel", "source"])
    colour = settle(facade.blend(seen, ["panel", "texel"], value))
    every = texels.select("panel", "texel").distinct()
    means = colour.groupBy("panel").agg(F.avg(value).alias("mean"), F.count("*").alias("filled"))
    total = every.groupBy("panel").agg(F.count("*").alias("texels"))
    covered = settle(panels.join(total, "panel").join(means, "panel", "left").withColumn("coverage", F.coalesce(F.col("filled") / F.col("texels"), F.lit(0.0))))
    own = facade.donors(covered, "building", "panel", "area", "coverage")
    empty = covered.where("coverage = 0").select("panel", "building", "origin")
    near = _nearest(empty, covered.where("coverage > 0"))
    donor_mean = covered.where("coverage > 0").select(F.col("panel").alias("donor"), F.col("mean").alias("borrowed"))
    best = empty.join(own, "building", "left").join(near, "panel", "left").withColumn("donor", F.coalesce("donor", "near")).join(donor_mean, "donor", "left").select("panel", "borrowed")
    overall = colour.agg(F.avg(value)).first()[0]
    rows = every.join(colour, ["panel", "texel"], "left").join(covered.select("panel", "mean", "coverage"), "panel").join(best, "panel", "left")
    return rows.select("panel", "texel", F.coalesce(F.col(value), F.col("mean"), F.col("borrowed"), F.lit(overall)).alias(value), "coverage")


def _nearest(empty: DataFrame, covered: DataFrame, size: float = 200.0) -> DataFrame:
    """(panel, near): the covered panel nearest in space, by rings of cells that double until all have one.

    Panels with a missing or infinite coordinate are near nothing. A round asks only for panels that found
    none so far, and all have one once cells are as wide as the farthest of them is away.
    """
    real = lambda c: reduce(lambda a, b: a & b, [F.coalesce(F.abs(F.col(f"{c}.{k}")) < float("inf"), F.lit(False)) & ~F.isnan(F.col(f"{c}.{k}")) for k in "xyz"])
    left, found = settle(empty.where(real("origin")).select("panel", "origin")), None
    donors = settle(covered.where(real("origin")).select(F.col("panel").alias("other"), F.col("origin").alias("there")))
    if donors.isEmpty():
        return empty.select("panel", F.col("panel").alias("near")).limit(0)
    while not left.isEmpty():
        cells = F.explode(F.array(*[F.struct((F.floor(F.col("origin.x") / size) + i).alias("i"), (F.floor(F.col("origin.y") / size) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        asked = left.select("panel", "origin", cells.alias("k"))
        there = donors.withColumn("k", F.struct(F.floor(F.col("there.x") / size).alias("i"), F.floor(F.col("there.y") / size).alias("j")))
        gap = G.norm(G.minus(F.col("origin"), F.col("there")))
        near = asked.join(there, "k").select("panel", "other", gap.alias("d")).where(F.col("d") <= size)
        best = settle(near.groupBy("panel").agg(F.min_by("other", F.struct("d", "other")).alias("near")))
        found = best if found is None else found.unionByName(best)
        left = settle(left.join(best, "panel", "left_anti"))
        size *= 2
    return found if found is not None else empty.select("panel", F.col("panel").alias("near")).limit(0)


def auto_tour(spark: SparkSession, low: tuple[float, float, float], high: tuple[float, float, float], landmarks: DataFrame) -> DataFrame:
    """Shots in order: a wide orbit, one around each landmark (place, x, z, height), a reveal at the spawn."""
    width = max(high[0] - low[0], high[2] - low[2])
    spot = lambda x, z: F.struct(F.lit(x).cast("double").alias("x") if not isinstance(x, Column) else x.alias("x"), F.lit(z).cast("double").alias("z") if not isinstance(z, Column) else z.alias("z"))
    one = spark.range(1)
    shot = lambda df, n, name, kind, seconds, target, radius, height, turns, start, look, fov: df.select(
        n.cast("int").alias("ord"), name.alias("name"), F.lit(kind).alias("kind"), F.lit(float(seconds)).alias("seconds"), target.alias("target"), radius.alias("radius_m"), height.alias("height_m"),
        F.lit(turns).alias("turns"), start.alias("start_deg"), look.alias("look_height_m"), F.lit(fov).cast("double").alias("fov_deg"),
    )
    num = lambda v: F.lit(float(v))
    wide = shot(one, F.lit(0), F.lit("overview"), "orbit", 14, spot((low[0] + high[0]) / 2, (low[2] + high[2]) / 2), num(width * 0.62), num(width * 0.40), 0.30, num(0), num(width * 0.02), 42.0)
    h, k = F.col("height"), F.col("place")
    around = shot(landmarks, k, F.concat(F.lit("landmark-"), k), "orbit", 10, spot(F.col("x"), F.col("z")), F.greatest(num(90), h * 2.5), F.greatest(num(60), h * 2.0), 0.30, k * 60.0 + 200.0, h * 0.55, None)
    spawn = shot(one, F.lit(1 << 20), F.lit("spawn"), "reveal", 10, spot(0.0, 0.0), num(min(260.0, width * 0.28)), num(min(120.0, width * 0.14)), 0.22, num(0), num(8.0), None)
    return wide.unionByName(around).unionByName(spawn)


def pyramid_level(width: Column, height: Column, level: int | None = None) -> Column:
    """Level of a tile pyramid that holds the full frame, or the smaller one asked for."""
    full = F.ceil(F.log2(F.greatest(width, height).cast("double"))).cast("int")
    return full if level is None else F.least(F.lit(level), full)


def pyramid_size(width: Column, height: Column, level: Column) -> Column:
    """Struct of width and height of a level."""
    by = F.pow(F.lit(2.0), pyramid_level(width, height) - level)
    side = lambda v: F.greatest(F.lit(1), F.ceil(v / by).cast("int"))
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def pyramid_tiles(photos: DataFrame, key: str, level: int, tile: int = 256) -> DataFrame:
    """(key, level, i, j): the tiles that hold a level of each frame."""
    lv = pyramid_level(F.col("width"), F.col("height"), level)
    size = pyramid_size(F.col("width"), F.col("height"), lv)
    n = lambda c: F.ceil(size[c] / tile).cast("int") - 1
    rows = photos.select(key, lv.alias("level"), n("width").alias("ni"), n("height").alias("nj"))
    return rows.select(key, "level", "nj", F.explode(F.sequence(F.lit(0), F.col("ni"))).alias("i")).select(key, "level", "i", F.explode(F.sequence(F.lit(0), F.col("nj"))).alias("j"))


def next_number(names: DataFrame, path: str) -> DataFrame:
    """(number): the next free number of pictures, 1 without any."""
    from isarithm.functions.texts import natural_number

    return names.agg((F.coalesce(F.max(natural_number(F.col(path))), F.lit(0)) + 1).alias("number"))


def height_prefix(points: DataFrame, file_ord: str, point_ord: str, chunk: int, sample: int, keep: Column) -> DataFrame:
    """The kept points of the first whole chunks, in file order, until at least `sample` are taken.

    Chunks are counted first: one number per chunk is all that is put in order.
    """
    from pyspark.sql import Window

    part = F.floor(F.col(point_ord) / chunk)
    kept = points.where(keep).withColumn("_chunk", part)
    counts = kept.groupBy(file_ord, "_chunk").agg(F.count("*").alias("_n"))
    w = Window.orderBy(file_ord, "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chosen = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).where(F.col("_before") < sample).select(file_ord, "_chunk")
    return kept.join(chosen, [file_ord, "_chunk"]).drop("_chunk")

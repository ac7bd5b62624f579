"""Which photographs a map's walls are painted from, and which points of the walls they see."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.operators import facade, maps, select

LOW, HIGH = 25.0, 55.0
LEAST_INCIDENCE = 0.35
MARGIN = 2.0
FARTHEST = 20000.0
#: Cameras that walls are held against at a time; they are chosen ones, so few.
MOST_CAMERAS = 256


def newest(photos: DataFrame, date: str, arrival: str, most: int) -> DataFrame:
    """The first `most` photos by date text, newest first; equal dates in order of arrival."""
    return photos.orderBy(F.desc(date), arrival).limit(most)


def pose_passes(corr: Column, elevation: Column, least: float) -> Column:
    """Whether a pose agrees with the ground well enough, and looks down neither too flat nor too steep."""
    return (corr >= least) & (elevation > LOW) & (elevation < HIGH)


def by_score(scores: DataFrame, panel: str, score: str, source: str) -> DataFrame:
    """Adds `place` of a panel's sources, best first; of equal scores the larger source comes first."""
    return scores.withColumn("place", F.row_number().over(Window.partitionBy(panel).orderBy(F.desc(score), F.desc(source))))


def height_models(*fits: DataFrame) -> DataFrame:
    """The cameras fitted on several height models, with the model's number."""
    return reduce(DataFrame.unionByName, [f.withColumn("model", F.lit(i)) for i, f in enumerate(fits)])


def vanishing_azimuths(corners: Column) -> Column:
    """Azimuths (radians) that the converging edges of a ring of four ground corners (structs e, n) suggest, at most two.

    The lines through opposite edges meet in a point; from there to the middle of the corners is the way
    the camera looks. Pairs that meet nowhere, or farther away than FARTHEST, say nothing.
    """
    mid = lambda k: (corners[0][k] + corners[1][k] + corners[2][k] + corners[3][k]) / 4.0

    def of(a: int, b: int, p: int, q: int) -> Column:
        line = lambda s, t: (corners[s]["n"] - corners[t]["n"], corners[t]["e"] - corners[s]["e"], corners[s]["e"] * corners[t]["n"] - corners[t]["e"] * corners[s]["n"])
        (x1, y1, z1), (x2, y2, z2) = line(a, b), line(p, q)
        w = x1 * y2 - y1 * x2
        e, n = F.try_divide(y1 * z2 - z1 * y2, w), F.try_divide(z1 * x2 - x1 * z2, w)
        de, dn = mid("e") - e, mid("n") - n
        return F.when((F.abs(w) >= 1e-12) & (F.hypot(de, dn) <= FARTHEST), F.atan2(de, dn))

    return F.array_compact(F.array(of(0, 1, 3, 2), of(1, 2, 0, 3)))


def _held(cameras: DataFrame) -> list:
    rows = cameras.select("source", "centre", "rotation", "f_px", "width", "height").orderBy("source").limit(MOST_CAMERAS + 1).collect()
    if len(rows) > MOST_CAMERAS:
        raise ValueError(f"more than {MOST_CAMERAS} cameras; choose some first")
    return rows


def _literal(row) -> Column:
    turn = F.array(*[F.array(*[F.lit(float(v)) for v in axis]) for axis in row["rotation"]])
    c = row["centre"]
    return F.struct(F.lit(row["source"]).alias("source"), G.vec(c["x"], c["y"], c["z"]).alias("centre"), turn.alias("rotation"), *[F.lit(float(row[k])).alias(k) for k in ("f_px", "width", "height")])


def views(points: DataFrame, cameras: DataFrame) -> DataFrame:
    """The points (p, normal and others) beside every camera that has them in its frame: source, centre, incidence, distance.

    A point counts where it lies before the camera, MARGIN pixels inside the frame, and faces the camera
    by more than LEAST_INCIDENCE. The cameras are at most MOST_CAMERAS, read once; points are not joined.
    """
    held = _held(cameras)
    if not held:
        raise ValueError("no cameras")
    rows = points.select("*", F.explode(F.array(*[_literal(c) for c in held])).alias("_camera")).select("*", "_camera.source", "_camera.centre")
    to = G.minus(F.col("centre"), F.col("p"))
    seen = G.project(F.col("p"), F.col("centre"), F.col("_camera.rotation"), F.col("_camera.f_px"))
    measured = rows.withColumns({"distance": G.norm(to), "_q": seen}).withColumn("incidence", G.dot(F.col("normal"), to) / F.col("distance"))
    inside = (F.col("_q.depth") > 0) & (F.abs("_q.u") < F.col("_camera.width") / 2 - MARGIN) & (F.abs("_q.v") < F.col("_camera.height") / 2 - MARGIN)
    return measured.where(inside & (F.col("incidence") > LEAST_INCIDENCE)).drop("_camera", "_q")


def panel_scores(panels: DataFrame, cameras: DataFrame, triangles: DataFrame, panel: str = "panel", cell: float = 50.0, step: float = 1.5) -> DataFrame:
    """(panel, source, fraction, score): the share of each panel's samples that a camera sees, and the panel's score for it.

    A sample is seen if it is in the frame and no triangle stands between. The score is that share times
    incidence over distance, both taken at the panel's origin.
    """
    samples = maps.panel_samples(panels, panel, step).join(panels.select(panel, "normal"), panel)
    total = samples.groupBy(panel).agg(F.count("*").alias("samples"))
    rays = views(samples, cameras).withColumn("ray", F.concat_ws("/", panel, "iu", "iv", "source"))
    hidden = facade.occluded(rays.select("ray", "p", "normal", "centre"), triangles, "ray", cell)
    free = rays.join(hidden.where("occluded").select("ray"), "ray", "left_anti").groupBy(panel, "source", "centre").agg(F.count("*").alias("seen"))
    at = free.join(total, panel).join(panels.select(panel, "origin", "normal"), panel)
    to = G.minus(F.col("centre"), F.col("origin"))
    scored = at.withColumns({"fraction": F.col("seen") / F.col("samples"), "_d": G.norm(to)}).withColumn("_i", G.dot(F.col("normal"), to) / F.col("_d"))
    return scored.select(panel, "source", "fraction", (F.col("fraction") * F.col("_i") / F.greatest(F.col("_d"), F.lit(1.0))).alias("score"))


def choose(photos: DataFrame, cameras: DataFrame, centre: tuple[float, float, float], candidates: int, sources: int, least: float) -> DataFrame:
    """The photos that walls are painted from: image, date, the best camera's place and corr, bearing, elevation, octant, place.

    photos: image, date, arrival and what usable_photos reads; an image counts once. cameras: image, model,
    x, y, z, corr, one row per fitted camera. Of each of the newest candidates the camera that agrees best is
    kept if its pose passes; then octants around the centre take turns, best first.
    """
    usable = select.first_wins(facade.usable_photos(photos), ["image"], ["arrival"])
    tried = newest(usable, "date", "arrival", candidates).select("image", "date")
    best = facade.best_of(cameras.where("corr IS NOT NULL AND NOT isnan(corr)"), ["image"], "corr", ["model"])
    east, north, up = F.col("x") - centre[0], F.col("y") - centre[1], F.col("z") - centre[2]
    far = F.sqrt(east * east + north * north + up * up)
    posed = tried.join(best, "image").withColumns({"bearing": G.bearing(east, north), "elevation": G.elevation(up, far)}).withColumn("octant", G.octant(F.col("bearing")))
    kept = posed.where(pose_passes(F.col("corr"), F.col("elevation"), least))
    return select.round_robin(kept, "octant", [F.desc("corr"), F.col("image")], sources)

"""Wall panels from photographs: planes, visibility, blending, borrowing, camera fitting."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.operators import select

BLEND_POWER, BLEND_LEAST = 4, 0.02

# Focal length in pixels and tilt that a camera's fit starts from.
START_FOCAL, START_TILT = 13000.0, 0.78


def gated_correlation(df: DataFrame, group: list[str], a: str, b: str, least: int = 400) -> DataFrame:
    """(group, n, corr): Pearson correlation; 0 with fewer than `least` pairs or no variance."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    pairs = df.where(both).groupBy(*group).agg(F.count("*").alias("n"), F.corr(a, b).alias("_c"))
    return pairs.select(*group, "n", F.when(F.col("n") < least, 0.0).otherwise(F.coalesce(F.nanvl("_c", F.lit(0.0)), F.lit(0.0))).alias("corr"))


def best_of(candidates: DataFrame, group: list[str], score: str, order: list[str], highest: bool = True) -> DataFrame:
    """The candidate with the best score of each group; the first in order of equal ones."""
    rest = [c for c in candidates.columns if c not in group]
    rank = F.struct((-F.col(score) if highest else F.col(score)).alias("_s"), *order)
    return candidates.groupBy(*group).agg(F.min_by(F.struct(*rest), rank).alias("_r")).select(*group, "_r.*")


def visibility_scores(samples: DataFrame, panel: str, source: str, visible: str, incidence: str, distance: str) -> DataFrame:
    """(panel, source, fraction, score) of sources that see some sample: fraction * incidence / max(distance, 1)."""
    seen = samples.groupBy(panel, source).agg(F.avg(F.col(visible).cast("double")).alias("fraction"), F.first(incidence).alias("_i"), F.first(distance).alias("_d"))
    return seen.where("fraction > 0").select(panel, source, "fraction", (F.col("fraction") * F.col("_i") / F.greatest(F.col("_d"), F.lit(1.0))).alias("score"))


def blend_weights(scores: DataFrame, panel: str, score: str = "score") -> DataFrame:
    """Adds weight = (score / best of the panel) ** 4 and drops weights under the cut."""
    top = scores.groupBy(panel).agg(F.max(score).alias("_top"))
    weighted = scores.join(top, panel).withColumn("weight", F.pow(F.col(score) / F.col("_top"), F.lit(float(BLEND_POWER)))).drop("_top")
    return weighted.where(F.col("weight") >= BLEND_LEAST)


def blend(texels: DataFrame, key: list[str], value: str, weight: str = "weight") -> DataFrame:
    """(key, value): weighted means; null without weight."""
    return texels.groupBy(*key).agg(F.try_divide(F.sum(F.col(weight) * F.col(value)), F.sum(weight)).alias(value))


def fill_from_group(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Missing values take their group's mean of those that are there."""
    mean = rows.where(F.col(value).isNotNull()).groupBy(*group).agg(F.avg(value).alias("_m"))
    return rows.join(mean, group, "left").withColumn(value, F.coalesce(value, "_m")).drop("_m")


def donors(panels: DataFrame, building: str, panel: str, area: str, coverage: str) -> DataFrame:
    """(building, donor): each building's covered panel with the largest area times coverage, the first of equal ones."""
    covered = panels.where(F.col(coverage) > 0)
    return covered.groupBy(building).agg(F.min_by(panel, F.struct((-F.col(area) * F.col(coverage)).alias("s"), F.col(panel))).alias("donor"))


def area_weighted(df: DataFrame, group: list[str], value: str, area: str) -> DataFrame:
    return df.groupBy(*group).agg(F.try_divide(F.sum(F.col(value) * F.col(area)), F.sum(area)).alias(value))


def wall_panels(faces: DataFrame, building: str = "building", max_tilt: float = 0.35, min_area: float = 6.0) -> DataFrame:
    """Upright planes of buildings in z-up axes, from faces with fid, pa, pb, pc.

    Faces group by rounded direction and distance of their plane; a panel's frame comes from the mean
    direction; its base point is that of its first triangle, moved to the lower left corner.
    """
    n = G.face_normal(F.col("pa"), F.col("pb"), F.col("pc"))
    walls = faces.withColumn("n", n).where((G.norm(F.col("n")) > 0) & (F.abs(F.col("n.z")) < max_tilt))
    flat = walls.withColumn("_l", F.hypot("n.x", "n.y")).where("_l > 1e-9").withColumns({"hx": F.col("n.x") / F.col("_l"), "hy": F.col("n.y") / F.col("_l")})
    offset = F.col("hx") * F.col("pa.x") + F.col("hy") * F.col("pa.y")
    keyed = flat.withColumn("plane", G.plane_key(F.col("hx"), F.col("hy"), offset))
    frame = keyed.groupBy(building, "plane").agg(F.avg("hx").alias("mx"), F.avg("hy").alias("my"), F.min_by("pa", "fid").alias("p0"), F.min("fid").alias("first_fid"))
    frame = frame.withColumn("_l", F.hypot("mx", "my")).where("_l >= 1e-9").withColumns({"mx": F.col("mx") / F.col("_l"), "my": F.col("my") / F.col("_l")}).drop("_l")
    # u = up x normal = (-ny, nx, 0)
    u = lambda p: F.col(f"{p}.y") * F.col("mx") - F.col(f"{p}.x") * F.col("my")
    spans = keyed.join(frame, [building, "plane"]).groupBy(building, "plane", "mx", "my", "p0", "first_fid").agg(
        F.min(F.least(*[u(p) for p in ("pa", "pb", "pc")])).alias("u0"), F.max(F.greatest(*[u(p) for p in ("pa", "pb", "pc")])).alias("u1"),
        F.min(F.least("pa.z", "pb.z", "pc.z")).alias("v0"), F.max(F.greatest("pa.z", "pb.z", "pc.z")).alias("v1"), F.count("*").alias("n_faces"),
    )
    w, h = F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0")
    sized = spans.withColumns({"width": w, "height": h}).where((w * h >= min_area) & (w >= 1.0) & (h >= 1.0))
    back = F.col("p0.y") * F.col("mx") - F.col("p0.x") * F.col("my") - F.col("u0")
    return sized.select(
        building, "first_fid", "n_faces", "width", "height", G.vec(F.col("mx"), F.col("my"), 0.0).alias("normal"), G.vec(-F.col("my"), F.col("mx"), 0.0).alias("u_axis"),
        G.vec(F.col("p0.x") + back * F.col("my"), F.col("p0.y") - back * F.col("mx"), F.col("v0")).alias("origin"),
    )


def ray_hits(origins: np.ndarray, directions: np.ndarray, triangles: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
    """Number of triangles (n, 3, 3) that each ray meets in front of it, up to the distance `most`."""
    out = np.zeros(len(origins), np.int64)
    e1, e2 = triangles[:, 1] - triangles[:, 0], triangles[:, 2] - triangles[:, 0]
    for lo in range(0, len(origins), max(1, 2_000_000 // max(1, len(triangles)))):
        hi = lo + max(1, 2_000_000 // max(1, len(triangles)))
        o, d = origins[lo:hi, None, :], directions[lo:hi, None, :]
        p = np.cross(d, e2[None])
        det = (e1[None] * p).sum(-1)
        safe = np.where(np.abs(det) < 1e-12, 1.0, det)
        s = o - triangles[None, :, 0]
        a = (s * p).sum(-1) / safe
        q = np.cross(s, e1[None])
        b = (d * q).sum(-1) / safe
        t = (e2[None] * q).sum(-1) / safe
        hit = (np.abs(det) >= 1e-12) & (a >= 0) & (b >= 0) & (a + b <= 1) & (t > 1e-9)
        if most is not None:
            hit &= t < most[lo:hi, None]
        out[lo:hi] = hit.sum(1)
    return out


def occluded(rays: DataFrame, triangles: DataFrame, key: str, cell: float, offset: float = 0.25) -> DataFrame:
    """(key, occluded): whether a triangle stands between a sample and its camera.

    Rays have key and structs p, normal, centre; each starts `offset` along the normal. Rays and
    triangles meet in the plan cells that both touch, in groups of one cell, and a ray is occluded
    if any of its cells says so.
    """
    start = G.vec(F.col("p.x") + offset * F.col("normal.x"), F.col("p.y") + offset * F.col("normal.y"), F.col("p.z") + offset * F.col("normal.z"))
    r = rays.withColumn("_o", start)
    steps = F.ceil(F.hypot(F.col("centre.x") - F.col("_o.x"), F.col("centre.y") - F.col("_o.y")) / (cell / 4)) + 1
    along = lambda c: F.transform(F.sequence(F.lit(0), steps), lambda k: F.floor((F.col(f"_o.{c}") + (F.col(f"centre.{c}") - F.col(f"_o.{c}")) * k / steps) / cell))
    met = F.explode(F.array_distinct(F.arrays_zip(along("x").alias("cx"), along("y").alias("cy"))))
    rc = r.select(F.col(key).alias("_key"), "_o", "centre", met.alias("_c")).select("_key", "_o", "centre", F.col("_c.cx").alias("cx"), F.col("_c.cy").alias("cy"))
    low = lambda c: F.floor((F.least(*[F.col(f"{v}.{c}") for v in ("pa", "pb", "pc")]) - cell / 4) / cell)
    high = lambda c: F.floor((F.greatest(*[F.col(f"{v}.{c}") for v in ("pa", "pb", "pc")]) + cell / 4) / cell)
    tc = triangles.select("pa", "pb", "pc", F.explode(F.sequence(low("x"), high("x"))).alias("cx")).select("*", F.explode(F.sequence(low("y"), high("y"))).alias("cy"))
    flat = lambda s: F.array(F.col(f"{s}.x"), F.col(f"{s}.y"), F.col(f"{s}.z"))

    def test(k, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"_key": np.zeros(0, object), "_hit": np.zeros(0, bool)})
        o, c = np.stack(left["o"].to_list()), np.stack(left["c"].to_list())
        tri = np.stack(right["t"].to_list()).reshape(-1, 3, 3) if len(right) else np.zeros((0, 3, 3))
        far = np.linalg.norm(c - o, axis=1)
        hits = ray_hits(o, (c - o) / np.maximum(far, 1e-12)[:, None], tri, far) if len(tri) else np.zeros(len(o))
        return pd.DataFrame({"_key": left["_key"].astype(object), "_hit": hits > 0})

    kind = rays.schema[key].dataType.simpleString()
    a = rc.select("_key", flat("_o").alias("o"), flat("centre").alias("c"), "cx", "cy").groupBy("cx", "cy")
    b = tc.select(F.concat(flat("pa"), flat("pb"), flat("pc")).alias("t"), "cx", "cy").groupBy("cx", "cy")
    found = a.cogroup(b).applyInPandas(test, f"_key {kind}, _hit boolean")
    return found.groupBy(F.col("_key").alias(key)).agg(F.bool_or("_hit").alias("occluded"))


def outward(panels: DataFrame, faces: DataFrame, building: str = "building", probe: float = 0.3) -> DataFrame:
    """Panels with normal and u_axis turned outward where the building is watertight, by ray parity.

    A point `probe` in front of a panel's middle lies inside if a ray from it meets an odd number of
    the building's faces. A building, one group, is watertight if every edge occurs once each way.
    """
    flat = lambda s: F.array(F.col(f"{s}.x"), F.col(f"{s}.y"), F.col(f"{s}.z"))
    p = panels.select(building, "first_fid", flat("origin").alias("o"), flat("normal").alias("n"), flat("u_axis").alias("u"), "width", "height")
    f = faces.select(F.col(building).alias("_of"), F.concat(flat("pa"), flat("pb"), flat("pc")).alias("t"))

    def turn(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = left[[building, "first_fid"]].assign(flip=False)
        tri = np.stack(right["t"].to_list()).reshape(-1, 3, 3) if len(right) else np.zeros((0, 3, 3))
        edges: dict = {}
        for t in np.round(tri, 6).tolist():
            for x, y in ((0, 1), (1, 2), (2, 0)):
                e = (tuple(t[x]), tuple(t[y]))
                edges[e] = edges.get(e, 0) + 1
        if len(left) and len(tri) and all(n == 1 and edges.get(e[::-1]) == 1 for e, n in edges.items()):
            o, n, u = (np.stack(left[c].to_list()) for c in "onu")
            up = np.array([0.0, 0.0, 1.0])
            spot = o + u * left["width"].to_numpy()[:, None] / 2 + up * left["height"].to_numpy()[:, None] / 2 + n * probe
            ray = np.tile(np.array([0.5377, 0.2913, 0.7912]), (len(spot), 1))
            out["flip"] = ray_hits(spot, ray, tri) % 2 == 1
        return out[[building, "first_fid", "flip"]]

    kind = panels.schema[building].dataType.simpleString()
    flips = p.groupBy(building).cogroup(f.groupBy("_of")).applyInPandas(turn, f"{building} {kind}, first_fid {panels.schema['first_fid'].dataType.simpleString()}, flip boolean")
    other = lambda c: F.when(F.col("flip"), G.vec(-F.col(f"{c}.x"), -F.col(f"{c}.y"), -F.col(f"{c}.z"))).otherwise(F.col(c))
    moved = G.vec(F.col("origin.x") + F.col("width") * F.col("u_axis.x"), F.col("origin.y") + F.col("width") * F.col("u_axis.y"), F.col("origin.z"))
    joined = panels.join(flips, [building, "first_fid"])
    return joined.withColumns({"origin": F.when(F.col("flip"), moved).otherwise(F.col("origin")), "normal": other("normal"), "u_axis": other("u_axis")}).drop("flip")


def homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """The plane map that takes four points to four points (the null vector of eight equations)."""
    rows = []
    for (x, y), (u, v) in zip(src, dst, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y, -u], [0, 0, 0, x, y, 1, -v * x, -v * y, -v]]
    return np.linalg.svd(np.array(rows, float))[2][-1].reshape(3, 3)


def camera_axes(azimuth, tilt, roll) -> np.ndarray:
    """Rows right, down, forward of cameras looking along the azimuth, tilted from straight down; numbers or arrays."""
    sa, ca, st, ct = np.sin(azimuth), np.cos(azimuth), np.sin(tilt), np.cos(tilt)
    forward = np.stack([sa * st, ca * st, -ct], axis=-1)
    right = np.stack([ca, -sa, np.zeros_like(sa)], axis=-1)
    down = np.cross(forward, right)
    sr, cr = np.sin(roll)[..., None], np.cos(roll)[..., None]
    return np.stack([cr * right + sr * down, -sr * right + cr * down, forward], axis=-2)


def fit_cameras(corners: np.ndarray, width: np.ndarray, height: np.ndarray, seeds: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Seven camera parameters (focal, x, y, z, azimuth, tilt, roll) and the root mean square error in pixels of every fit.

    corners: n x 4 x 3 ground places of the frame's corners from the top left around; seeds: n x 7. All fits take
    their damped least-squares steps at once; one that has settled takes no part in later rounds.
    """
    zero = np.zeros(len(seeds))
    frame = np.stack([np.stack(c, axis=-1) for c in ((zero, zero), (width, zero), (width, height), (zero, height))], axis=1) - np.stack([width, height], axis=-1)[:, None] / 2
    scale = np.array([1e3, 1e2, 1e2, 1e2, 1e-2, 1e-2, 1e-2])

    def errors(q: np.ndarray, of: np.ndarray) -> np.ndarray:
        seen = np.einsum("nij,nkj->nki", camera_axes(q[:, 4], q[:, 5], q[:, 6]), corners[of] - q[:, None, 1:4])
        flat = q[:, None, :1] * seen[..., :2] / np.maximum(seen[..., 2:], 1e-6)
        return (flat - frame[of]).reshape(len(q), 8)

    q, damping = seeds.astype(float).copy(), np.full(len(seeds), 1e-3)
    live = np.arange(len(seeds))
    e = errors(q, live)
    cost = (e * e).sum(axis=1)
    for _ in range(rounds):
        if not len(live):
            break
        now = q[live]
        jac = np.stack([(errors(now + h * unit, live) - errors(now - h * unit, live)) / (2 * h) * s for s, h, unit in zip(scale, scale * 1e-4, np.eye(7), strict=True)], axis=2)
        damped = np.concatenate([jac, np.sqrt(damping[live])[:, None, None] * np.eye(7)], axis=1)
        left, upper = np.linalg.qr(damped)
        step = np.linalg.solve(upper, -np.einsum("nij,ni->nj", left[:, :8], e[live])[..., None])[..., 0]
        after = now + step * scale
        e2 = errors(after, live)
        cost2 = (e2 * e2).sum(axis=1)
        better = cost2 < cost[live]
        small = better & (cost[live] - cost2 < 1e-12 * np.maximum(cost[live], 1e-12))
        won = live[better]
        q[won], e[won], cost[won] = after[better], e2[better], cost2[better]
        damping[live] = np.where(better, np.maximum(damping[live] / 5, 1e-12), damping[live] * 5)
        live = live[~small & (damping[live] <= 1e12)]
    return q, np.sqrt(cost / 8)


def fit_camera(corners: np.ndarray, width: float, height: float, seeds: list[np.ndarray], rounds: int = 200) -> tuple[np.ndarray, float]:
    """The best of the fits of one camera from all seeds."""
    n = len(seeds)
    q, rms = fit_cameras(np.broadcast_to(corners, (n, 4, 3)), np.full(n, float(width)), np.full(n, float(height)), np.stack(seeds), rounds)
    best = int(np.argmin(rms))
    return q[best], float(rms[best])


def resect(photos: DataFrame, key: str = "id") -> DataFrame:
    """(key, f_px, x, y, z, azimuth, tilt, roll, rms_px): the camera of each photo, fitted on its own row.

    A photo has width, height, camera height guess `above` and corners, an array of four ground places (x, y, z).
    """

    def fit(batches):
        for part in batches:
            rows = []
            for row in part.itertuples():
                c = np.array([[p["x"], p["y"], p["z"]] for p in row.corners], float)
                middle = c.mean(axis=0)
                seeds = []
                for azimuth in np.arange(0, 2 * np.pi, np.pi / 4):
                    for tilt in (0.3, 0.8):
                        back = row.above * np.tan(tilt)
                        eye = middle + np.array([-np.sin(azimuth) * back, -np.cos(azimuth) * back, row.above])
                        seeds.append(np.array([1.5 * row.width, *eye, azimuth, tilt, 0.0]))
                q, rms = fit_camera(c, row.width, row.height, seeds)
                rows.append((getattr(row, key), *q.tolist(), rms))
            yield pd.DataFrame(rows, columns=[key, "f_px", "x", "y", "z", "azimuth", "tilt", "roll", "rms_px"])

    kind = photos.schema[key].dataType.simpleString()
    return photos.select(key, "width", "height", "above", "corners").mapInPandas(fit, f"{key} {kind}, f_px double, x double, y double, z double, azimuth double, tilt double, roll double, rms_px double")


def camera_starts(photos: DataFrame, azimuths: Column, key: str = "id") -> DataFrame:
    """(key, width, height, above, ground, rot, rev, seed, roll, azimuth): a row for every fit that a photo's camera asks for.

    A photo has width, height, the guess `above` of the camera's height and corners, a ring of four ground places
    (e, n, z) of which nobody knows where it starts and which way it runs. `azimuths` are the ways that it may look,
    each tried back to front too; without any, eight all around. `ground` are the corners in the order of one
    of the eight readings. A photo without four whole corners has no rows.
    """
    whole = (F.size("corners") == 4) & F.forall("corners", lambda c: c["e"].isNotNull() & c["n"].isNotNull() & c["z"].isNotNull())
    around = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: k * (math.pi / 4))
    seeds = F.when(F.size(azimuths) > 0, F.flatten(F.transform(azimuths, lambda a: F.array(a, a + math.pi)))).otherwise(around)
    turned = F.concat(F.slice("corners", F.col("rot") + 1, 4), F.slice("corners", 1, F.col("rot")))
    rows = photos.where(whole).select(key, "width", "height", "above", "corners", seeds.alias("_seeds"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("rot"))
    both = rows.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("rev")).withColumn("ground", F.when(F.col("rev"), F.reverse(turned)).otherwise(turned))
    aimed = both.drop("corners").select("*", F.posexplode("_seeds").alias("seed", "azimuth")).drop("_seeds")
    return aimed.select("*", F.explode(F.array(F.lit(0.0), F.lit(math.pi))).alias("roll"))


def camera_candidates(photos: DataFrame, azimuths: Column, key: str = "id") -> DataFrame:
    """Every different plausible camera of each photo: key, rot, rev, f_px, centre, rotation, tilt_deg, rms_px, width, height, ground_z.

    Several readings of a ring fit to a pixel, so all are kept for `ordering_scores` to choose from. Each start of
    `camera_starts` is a row of its own and is fitted by itself, so one photo's fits are spread over tasks.
    Of cameras that agree in place to 5 m and in focal length to 50 pixels the first start's stays.
    A photo that no plausible camera fits has no rows.
    """

    def fit(batches):
        for part in batches:
            ring = np.array([[[c["e"], c["n"], c["z"]] for c in g] for g in part["ground"]], float).reshape(-1, 4, 3)
            middle, n = ring.mean(axis=1), len(part)
            seeds = np.column_stack([np.full(n, START_FOCAL), middle[:, :2], middle[:, 2] + part["above"], part["azimuth"], np.full(n, START_TILT), part["roll"]])
            # The frame's corners run top left, top right, bottom right, bottom left; the ring runs the other way.
            q, rms = fit_cameras(ring[:, [0, 3, 2, 1]], part["width"].to_numpy(float), part["height"].to_numpy(float), seeds)
            turn = camera_axes(q[:, 4], q[:, 5], q[:, 6] + np.where(q[:, 0] < 0, np.pi, 0.0))
            fits = {"f_px": np.abs(q[:, 0]), "x": q[:, 1], "y": q[:, 2], "z": q[:, 3], "rotation": turn.tolist(), "_tilt": np.degrees(q[:, 5]), "rms_px": rms, "ground_z": middle[:, 2]}
            yield part.drop(columns=["ground"]).assign(**fits)

    starts = camera_starts(photos, azimuths, key).repartition(key, "rot", "rev", "seed", "roll")
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in starts.schema if f.name != "ground")
    fitted = starts.mapInPandas(fit, f"{rest}, f_px double, x double, y double, z double, rotation array<array<double>>, _tilt double, rms_px double, ground_z double").withColumn("tilt_deg", G.fold_tilt(F.col("_tilt")))
    kept = fitted.where(plausible(F.col("z") - F.col("ground_z"), F.col("above"), F.col("tilt_deg"), F.col("rms_px"), F.col("width")))
    near = {f"_{c}": F.rint(F.col(c) / by) for c, by in (("x", 5.0), ("y", 5.0), ("z", 5.0), ("f_px", 50.0))}
    first = select.first_wins(kept.withColumns(near), [key, *near], ["rot", "rev", "seed", "roll"])
    return first.select(key, "rot", "rev", "f_px", G.vec(F.col("x"), F.col("y"), F.col("z")).alias("centre"), "rotation", "tilt_deg", "rms_px", "width", "height", "ground_z")


def usable_photos(photos: DataFrame) -> DataFrame:
    """Accurate tiled photos of two camera models from a plausible height, from 2022 on; dates compare as text."""
    camera = F.split("rada", "/")[1]
    return photos.where((F.col("accuracy") == 2) & F.col("tiled") & (F.col("korgus_m") > 400) & (F.col("korgus_m") < 3000) & camera.isin("a7r3", "a7r4") & (F.col("date") >= "2022"))


def plausible(height: Column, above: Column, tilt: Column, rms: Column, width: Column) -> Column:
    """Whether a fitted camera can be true."""
    return (height > 0.4 * above) & (height < 1.05 * above) & (tilt > 5) & (tilt < 75) & (rms <= 0.01 * width)


def sample_image(points: DataFrame, cells: DataFrame, key: list[str], x: Column, y: Column, width: int, height: int, values: list[str]) -> DataFrame:
    """(key, values...): bilinear samples at fractional pixels; points that are not well inside give no row.

    `cells` has row, col and one column per band; a point becomes four weighted cells, one join for all bands.
    """
    inside = (x >= 0) & (x < width - 1) & (y >= 0) & (y < height - 1)
    rows = points.where(inside).select(*key, F.floor(x).cast("int").alias("_x"), F.floor(y).cast("int").alias("_y"), (x - F.floor(x)).alias("_fx"), (y - F.floor(y)).alias("_fy"))
    share = lambda c, d: F.col(c) if d else 1.0 - F.col(c)
    four = F.array(*[F.struct((F.col("_y") + dy).alias("row"), (F.col("_x") + dx).alias("col"), (share("_fx", dx) * share("_fy", dy)).alias("w")) for dx in (0, 1) for dy in (0, 1)])
    spread = rows.select(*key, F.explode(four).alias("k")).select(*key, "k.*")
    return spread.join(cells, ["row", "col"]).groupBy(*key).agg(*[F.sum(F.col("w") * F.col(v)).alias(v) for v in values])


def readings(photos: DataFrame, key: str = "id") -> DataFrame:
    """(key, rot, rev, m): the eight ways to read a photo's ring of ground corners, each with its plane map to the frame.

    A photo has width, height and corners, an array of four structs e, n. Frame places count from the middle.
    """

    def run(batches):
        for part in batches:
            rows = []
            for p in part.itertuples():
                w, h = p.width / 2, p.height / 2
                frame = np.array([(-w, -h), (-w, h), (w, h), (w, -h)])
                ring = np.array([[c["e"], c["n"]] for c in p.corners], float)
                for rot in range(4):
                    for rev in (False, True):
                        turned = np.roll(ring, -rot, axis=0)
                        rows.append((getattr(p, key), rot, rev, homography(turned[::-1] if rev else turned, frame).ravel().tolist()))
            yield pd.DataFrame(rows, columns=[key, "rot", "rev", "m"])

    return photos.select(key, "width", "height", "corners").mapInPandas(run, f"{key} {photos.schema[key].dataType.simpleString()}, rot int, rev boolean, m array<double>")


def ordering_scores(maps: DataFrame, control: DataFrame, cells: DataFrame, key: str, size: tuple[int, int], scale: float = 1.0, offset: tuple[float, float] = (0.0, 0.0), least: int = 400) -> DataFrame:
    """(key, rot, rev, n, corr): how well each reading's picture agrees with the ground's luminance.

    `control` has key, x, y, lum: the open ground points that a photo may see; `cells` has key, row, col
    and gray, the photo's own raster of `size` (width, height) at `scale` of the frame's pixels.
    """
    m = F.col("m")
    q = lambda r: m[3 * r] * F.col("x") + m[3 * r + 1] * F.col("y") + m[3 * r + 2]
    width, height = size
    met = maps.join(control, key).withColumns({"px": (F.try_divide(q(0), q(2)) + width / scale / 2) * scale - offset[0], "py": (F.try_divide(q(1), q(2)) + height / scale / 2) * scale - offset[1]})
    inside = met.where((F.col("px") >= 0) & (F.col("px") < width - 1) & (F.col("py") >= 0) & (F.col("py") < height - 1))
    seen = inside.withColumns({"col": F.floor("px").cast("int"), "row": F.floor("py").cast("int")}).join(cells, [key, "row", "col"])
    return gated_correlation(seen, [key, "rot", "rev"], "gray", "lum", least)

"""Scenes and photographs: errors, files, visibility and choices that the queries do not reach."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from isarithm.operators import facade, maps, mesh, photos, scene
from isarithm.sources import gltf


def test_a_page_in_place_of_a_file_is_an_error(spark):
    df = spark.createDataFrame([("application/zip", "a"), (None, "b"), ("TEXT/html;x", "c")], "kind string, url string")
    good = df.where("url <> 'c'").select(scene.checked_file(F.col("kind"), F.col("url")).alias("u")).collect()
    assert [r["u"] for r in good] == ["a", "b"]
    with pytest.raises(Exception, match="a page in place of a file: c"):
        df.select(scene.checked_file(F.col("kind"), F.col("url"))).collect()


def test_build_stamps_are_in_utc(spark):
    row = spark.range(1).select(scene.build_stamp(F.lit(datetime.datetime(2024, 5, 6, 7, 8, 9, 999))).alias("a"), scene.build_stamp().alias("now")).first()
    assert row["a"] == "2024-05-06T07:08:09+00:00" and len(row["now"]) == 25


def test_gate_boxes_are_closed_and_face_outward(spark):
    gates = spark.createDataFrame([(1, 3.0, 7.0, -2.0, 5.0, 0.25, 33.0)], "ord int, x double, y double, z double, size double, bar double, yaw_deg double")
    bars = mesh.gate_bars(gates)
    faces = scene.gate_faces(bars).collect()
    assert len(faces) == 48 and {f["mesh"] for f in faces} == {f"course_gate01_{b}" for b in ("left", "right", "top", "bottom")}
    points = {(r["bar"], r["corner"]): np.array([r["x"], r["y"], r["z"]]) for r in bars.collect()}
    for bar in ("left", "right", "top", "bottom"):
        own = [(f["a"], f["b"], f["c"]) for f in faces if f["mesh"].endswith(bar)]
        edges = [e for a, b, c in own for e in ((a, b), (b, c), (c, a))]
        assert len(set(edges)) == 36 and all((b, a) in edges for a, b in edges)
        middle = np.mean([points[bar, k] for k in range(8)], axis=0)
        for a, b, c in own:
            p, q, r = (points[bar, k] for k in (a, b, c))
            assert np.cross(q - p, r - p) @ (p - middle) > 0


def test_tables_become_one_binary(spark, tmp_path):
    v = spark.createDataFrame([("b", 10, 0.0, 0.0, 0.0, 0.25, 0.25), ("b", 20, 1.0, 0.0, 0.0, 0.5, 0.0), ("b", 30, 0.0, 2.0, 0.0, 0.0, 1.0), ("a", 1, 5.0, 5.0, 5.0, 0.0, 0.0)], "mesh string, vid long, x double, y double, z double, u double, v double")
    f = spark.createDataFrame([("b", 30, 10, 20)], "mesh string, a long, b long, c long")
    whole = scene.assemble([(v.where("mesh = 'b'"), f), (v.where("mesh = 'a'").drop("u", "v"), f.limit(0))])
    size = gltf.write_tables(*whole, str(tmp_path / "m.glb"))
    assert size == (tmp_path / "m.glb").stat().st_size
    [row] = [r for r in gltf.meshes(spark, str(tmp_path / "m.glb")).collect() if r["mesh"] == "b"]
    assert np.allclose(row["positions"], [[0, 0, 0], [1, 0, 0], [0, 2, 0]]) and [list(x) for x in row["faces"]] == [[2, 0, 1]]
    stats = gltf.stats(gltf.documents(spark, str(tmp_path / "m.glb"))).first()
    assert stats["triangles"] == 1
    with pytest.raises(ValueError, match="more than one binary"):
        gltf.write_tables(*whole, str(tmp_path / "n.glb"), most=3)
    with pytest.raises(ValueError, match="does not have"):
        gltf.write_tables(v, spark.createDataFrame([("b", 30, 10, 99)], f.schema), str(tmp_path / "n.glb"))


def test_panels_without_a_place_are_near_nothing(spark):
    kind = "panel long, origin struct<x: double, y: double, z: double>"
    rows = [(1, (0.0, 0.0, 0.0)), (2, (float("nan"), 0.0, 0.0)), (3, None), (4, (None, 1.0, 1.0)), (5, (1e6, 0.0, 0.0)), (6, (float("inf"), 0.0, 0.0))]
    donors = [(10, (30.0, 0.0, 0.0)), (11, (-30.0, 0.0, 0.0)), (12, (float("nan"), 0.0, 0.0)), (13, (4e5, 0.0, 0.0))]
    got = maps._nearest(spark.createDataFrame(rows, kind), spark.createDataFrame(donors, kind)).collect()
    assert {r["panel"]: r["near"] for r in got} == {1: 10, 5: 13}
    assert maps._nearest(spark.createDataFrame(rows, kind), spark.createDataFrame(donors[2:3], kind)).count() == 0


CAMERA = "source int, centre struct<x: double, y: double, z: double>, rotation array<array<double>>, f_px double, width double, height double"
NORTH = [[-1.0, 0.0, 0.0], [0.0, 0.0, -1.0], [0.0, -1.0, 0.0]]  # of a camera north of the wall that looks south


def test_scores_of_walls_that_others_hide(spark):
    panels = spark.createDataFrame(
        [(1, (0.0, 0.0, 0.0), (0.0, 1.0, 0.0), (1.0, 0.0, 0.0), 6.0, 3.0), (2, (0.0, 0.0, 0.0), (0.0, -1.0, 0.0), (-1.0, 0.0, 0.0), 6.0, 3.0)],
        "panel int, origin struct<x: double, y: double, z: double>, normal struct<x: double, y: double, z: double>, u_axis struct<x: double, y: double, z: double>, width double, height double",
    )
    cameras = spark.createDataFrame([(0, (3.0, 40.0, 1.5), NORTH, 1000.0, 800.0, 600.0), (1, (3.0, 40.0, 1.5), NORTH, 9000.0, 800.0, 600.0)], CAMERA)
    far = spark.createDataFrame([((500.0, 500.0, 0.0), (501.0, 500.0, 0.0), (500.0, 501.0, 0.0))], ", ".join(f"p{k} struct<x: double, y: double, z: double>" for k in "abc"))
    wall = spark.createDataFrame([((-9.0, 20.0, -9.0), (3.0, 20.0, -9.0), (3.0, 20.0, 99.0)), ((-9.0, 20.0, -9.0), (3.0, 20.0, 99.0), (-9.0, 20.0, 99.0))], far.schema)
    score = lambda t: {(r["panel"], r["source"]): r for r in photos.panel_scores(panels, cameras, t).collect()}
    free = score(far)
    distance = np.linalg.norm([3.0, 40.0, 1.5])
    assert set(free) == {(1, 0), (1, 1)} and free[1, 0]["fraction"] == 1.0
    assert abs(free[1, 0]["score"] - 40.0 / distance / distance) < 1e-9
    assert free[1, 1]["fraction"] == 0.5  # the narrow frame holds the middle columns alone
    assert score(wall)[1, 0]["fraction"] == 0.5
    with pytest.raises(ValueError, match="no cameras"):
        photos.views(panels, cameras.limit(0))


def test_photos_are_chosen_around_the_map(spark):
    rows = [(f"i{k}", f"2023-0{1 + k % 9}", k, 2, True, 1500.0, "x/a7r3/y") for k in range(12)] + [("i0", "2023-01", 99, 2, True, 1500.0, "x/a7r3/y"), ("old", "2021-05", 50, 2, True, 1500.0, "x/a7r3/y"), ("other", "2023-09", 51, 2, True, 1500.0, "x/p1/y")]
    taken = spark.createDataFrame(rows, "image string, date string, arrival long, accuracy int, tiled boolean, korgus_m double, rada string")
    cams = []
    for k in range(12):
        a = np.radians(45.0 * (k % 4))
        for model, corr in ((0, 0.1 + 0.05 * k), (1, 0.12 + 0.05 * k if k % 2 else float("nan"))):
            cams.append((f"i{k}", model, float(np.sin(a) * 1000), float(np.cos(a) * 1000), 900.0 if k != 7 else 9000.0, corr))
    cameras = spark.createDataFrame(cams, "image string, model int, x double, y double, z double, corr double")
    got = photos.choose(taken, cameras, (0.0, 0.0, 0.0), 10, 5, 0.2).orderBy("place").collect()
    # Of twelve usable images the ten newest are tried; i7 looks down too steeply, and octants take turns.
    newest = sorted(range(12), key=lambda k: (-(1 + k % 9), k))[:10]
    fit = {k: 0.1 + 0.05 * k + (0.02 if k % 2 else 0) for k in newest if k != 7}
    left = sorted((k for k in fit if fit[k] >= 0.2), key=lambda k: -fit[k])
    turns = sorted(left, key=lambda k: ([j for j in left if j % 4 == k % 4].index(k), -fit[k]))[:5]
    assert [r["image"] for r in got] == [f"i{k}" for k in turns]
    assert all(r["model"] == (int(r["image"][1:]) % 2) and r["octant"] == int(r["image"][1:]) % 4 for r in got)


def test_vanishing_points_of_a_tilted_frame(spark):
    """The ground ring of a camera that looks north: its sides converge to the south, its far edge is parallel."""
    near, wide = [(-50.0, 100.0), (50.0, 100.0)], [(120.0, 400.0), (-120.0, 400.0)]
    ring = [near[0], wide[1], wide[0], near[1]]
    df = spark.createDataFrame([([{"e": e, "n": n} for e, n in ring],)], "c array<struct<e: double, n: double>>")
    out = df.select(photos.vanishing_azimuths(F.col("c")).alias("a")).first()["a"]
    assert len(out) == 1 and abs(out[0]) < 1e-9


def test_candidates_hold_the_true_camera(spark):
    """Whichever corner the ring starts at and whichever way it runs; photos without four whole corners have none."""
    focal, eye, w, h = 13000.0, np.array([100.0, -200.0, 900.0]), 7952, 5304
    axes = facade.camera_axes(0.7, np.radians(45), 0.02)
    ring = []
    for px, py in ((0, 0), (0, h), (w, h), (w, 0)):
        d = axes.T @ np.array([(px - w / 2) / focal, (py - h / 2) / focal, 1.0])
        ring.append(tuple(float(v) for v in eye + d * (-eye[2] / d[2])))
    rings = {1: ring, 2: ring[2:] + ring[:2], 3: ring[::-1], 4: ring[:3], 5: ring[:3] + [(None, 0.0, 0.0)], 6: []}
    df = spark.createDataFrame([(i, w, h, 950.0, r) for i, r in rings.items()], "id long, width int, height int, above double, corners array<struct<e: double, n: double, z: double>>")
    df = df.unionByName(spark.createDataFrame([(7, w, h, 950.0, None)], df.schema))
    out = facade.camera_candidates(df, photos.vanishing_azimuths(F.col("corners"))).collect()
    assert {r["id"] for r in out} == {1, 2, 3}
    for i in (1, 2, 3):
        own = [r for r in out if r["id"] == i]
        places = [(round(r["centre"]["x"] / 5), round(r["centre"]["y"] / 5), round(r["centre"]["z"] / 5), round(r["f_px"] / 50)) for r in own]
        assert len(set(places)) == len(places)
        true = min(own, key=lambda r: np.abs(np.array([r["centre"][c] for c in "xyz"]) - eye).max())
        assert np.abs(np.array([true["centre"][c] for c in "xyz"]) - eye).max() < 5 and abs(true["f_px"] - focal) < 100 and true["rms_px"] < 1
        assert abs(true["tilt_deg"] - 45) < 1


def test_starts_read_a_ring_eight_ways(spark):
    ring = [(float(k), float(-k), 0.0) for k in range(4)]
    df = spark.createDataFrame([(1, 10, 10, 1.0, ring)], "id long, width int, height int, above double, corners array<struct<e: double, n: double, z: double>>")
    none, one = F.array().cast("array<double>"), F.array(F.lit(0.5))
    rows = facade.camera_starts(df, one).collect()
    orders = {(r["rot"], r["rev"]): tuple(int(c["e"]) for c in r["ground"]) for r in rows}
    assert len(rows) == 8 * 2 * 2 and len(set(orders.values())) == 8
    assert orders[(1, False)] == (1, 2, 3, 0) and orders[(1, True)] == (0, 3, 2, 1)
    assert facade.camera_starts(df, none).count() == 8 * 8 * 2

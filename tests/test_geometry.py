"""Golden values of projections, meshes, cameras, joins and selection."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.functions import projection as P
from isarithm.functions import texts
from isarithm.operators import facade, mesh, report, select, sequence, spatial, tree


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_conic_projection(spark):
    for (lat, lon), (east, north) in {(58.37990, 26.72743): (659516.3, 6474290.7), (58.3747, 26.7726): (662180.6, 6473820.3)}.items():
        got = one(spark, *P.conic_forward(F.lit(lat), F.lit(lon)))
        assert abs(got[0] - east) < 0.5 and abs(got[1] - north) < 0.5
        back = one(spark, *P.conic_inverse(F.lit(got[0]), F.lit(got[1])))
        assert abs(back[0] - lat) < 1e-9 and abs(back[1] - lon) < 1e-9


def test_transverse_and_geocentric_roundtrip(spark):
    e, n = one(spark, *P.transverse_forward(F.lit(58.4), F.lit(26.7)))
    lat, lon = one(spark, *P.transverse_inverse(F.lit(e), F.lit(n)))
    assert abs(lat - 58.4) < 1e-8 and abs(lon - 26.7) < 1e-8 and 480000 < e < 500000
    xyz = one(spark, *P.geodetic_to_geocentric(F.lit(58.4), F.lit(26.7), F.lit(80.0)))
    back = one(spark, *P.geocentric_to_geodetic(*[F.lit(v) for v in xyz]))
    assert np.allclose(tuple(back), (58.4, 26.7, 80.0), atol=1e-4)


def test_sheet_numbers(spark):
    assert one(spark, texts.sheet_1km(F.lit(662180.6), F.lit(6473820.3)))[0] == "473662"
    assert one(spark, texts.sheet_5km(F.lit(662180.6), F.lit(6473820.3)))[0] == "54761"
    assert len(one(spark, report.sheets_in((656000.0, 6468500.0, 665000.0, 6477500.0), 1000))[0]) == 90
    assert len(one(spark, report.sheets_in((656000.0, 6468500.0, 665000.0, 6477500.0), 5000))[0]) == 6


def test_curves(spark):
    s = one(spark, *[G.srgb_to_linear(F.lit(float(v))) for v in (0, 255, 128)])
    assert s[0] == 0 and s[1] == pytest.approx(1) and s[2] == pytest.approx(0.2158, abs=1e-4)
    assert tuple(one(spark, *[G.smoothstep(F.lit(v)) for v in (0.0, 0.5, 1.0, -1.0, 2.0)])) == (0, 0.5, 1, 0, 1)


def test_texts(spark):
    assert tuple(one(spark, *[texts.slug(F.lit(s)) for s in ("Old Mill", "  ", "A/B_1")])) == ("old-mill", "shot", "a-b-1")
    assert tuple(one(spark, *[texts.natural_number(F.lit(s)) for s in ("m-ingame-10.jpg", "m-ingame-2.jpg", "m-ingame-x.jpg")])) == (10, 2, 0)
    assert one(spark, texts.numbered_after(F.lit("m-tour-07-mill.jpg"), "-tour-"))[0] == 7
    assert one(spark, texts.title(F.lit("d/m-tour-07-old-mill.jpg"), F.lit("m-tour-")))[0] == "Old mill"
    assert tuple(one(spark, *[texts.owner_and_name(F.lit(s)) for s in ("git@host.org:own/name.git", "https://host.org/own/name")])) == ("own/name",) * 2
    assert one(spark, texts.tile_level(F.lit("a_L16_003.b3dm")))[0] == 16


def test_lattice(spark):
    assert mesh.lattice(spark, (0, 0, 1000, 1000), 100).count() == 121
    faces = mesh.lattice_faces(spark, 11, 11).orderBy("fid").collect()
    assert len(faces) == 200 and tuple(faces[0])[1:] == (0, 11, 1) and tuple(faces[100])[1:] == (1, 11, 12)


def box_faces(spark, name="b", size=(12.0, 12.0, 9.0)):
    v = np.array([[x, y, z] for x in (0, size[0]) for y in (0, size[1]) for z in (0, size[2])], float)
    quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
    rows = []
    p = lambda i: tuple(map(float, v[i]))
    for a, b, c, d in quads:
        rows += [(name, len(rows), p(a), p(b), p(c)), (name, len(rows) + 1, p(a), p(c), p(d))]
    kind = "struct<x: double, y: double, z: double>"
    return spark.createDataFrame(rows, f"building string, fid int, pa {kind}, pb {kind}, pc {kind}")


def test_wall_panels_of_a_box(spark):
    faces = box_faces(spark)
    panels = facade.outward(facade.wall_panels(faces), faces).collect()
    assert sorted((round(p["width"], 6), round(p["height"], 6)) for p in panels) == [(12, 9)] * 4
    for p in panels:
        middle = np.array(p["origin"]) + np.array(p["u_axis"]) * p["width"] / 2 + np.array([0, 0, p["height"] / 2])
        assert (middle - np.array([6, 6, 4.5])) @ np.array(p["normal"]) > 0
    assert facade.wall_panels(box_faces(spark, size=(12.0, 12.0, 0.4))).count() == 0


def test_occlusion(spark):
    kind = "struct<x: double, y: double, z: double>"
    rays = [(1, (-5.0, 6.0, 4.0), (-1.0, 0.0, 0.0), (30.0, 6.0, 4.0)), (2, (-5.0, 6.0, 4.0), (-1.0, 0.0, 0.0), (-30.0, 6.0, 4.0)), (3, (-5.0, 6.0, 20.0), (0.0, 0.0, 1.0), (30.0, 6.0, 20.0))]
    df = spark.createDataFrame(rays, f"id int, p {kind}, normal {kind}, centre {kind}")
    out = {r["id"]: r["occluded"] for r in facade.occluded(df, box_faces(spark), "id", 10.0).collect()}
    assert out == {1: True, 2: False, 3: False}


def test_camera_is_recovered():
    true = np.array([13000.0, 100.0, -200.0, 900.0, 0.7, math.radians(45), 0.02])
    axes = facade.camera_axes(*true[4:7])
    corners = []
    for px in ([0, 0], [7952, 0], [7952, 5304], [0, 5304]):
        d = axes.T @ np.array([(px[0] - 3976) / true[0], (px[1] - 2652) / true[0], 1.0])
        corners.append(true[1:4] + d * (-true[3] / d[2]))
    seeds = [np.array([11000.0, 0.0, 0.0, 850.0, a, 0.7, 0.0]) for a in (0.0, 0.8, 1.6)]
    q, rms = facade.fit_camera(np.array(corners), 7952, 5304, seeds)
    assert rms < 1 and np.abs(q[1:4] - true[1:4]).max() < 5 and abs(q[0] - true[0]) < 100


def test_homography():
    src, dst = np.array([[0, 0], [1, 0], [1, 1], [0, 1]], float), np.array([[3, 2], [7, 3], [6, 8], [2, 6]], float)
    h = facade.homography(src, dst)
    for s, d in zip(src, dst, strict=True):
        p = h @ np.array([*s, 1])
        assert np.allclose(p[:2] / p[2], d)


def test_gates(spark):
    gates = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 5.0, 0.25, 30.0)], "ord int, x double, y double, z double, size double, bar double, yaw_deg double")
    bars = mesh.gate_bars(gates)
    assert bars.count() == 32
    assert spatial.box_counts(gates, bars.select("x", "y", "z"), "ord", 4.0).first()["clear"]
    cube = spark.createDataFrame([(x, y, z) for x in (-0.5, 0.5) for y in (-0.5, 0.5) for z in (-0.5, 0.5)], "x double, y double, z double")
    got = spatial.box_counts(gates, cube, "ord", 4.0).first()
    assert (got["in_opening"], got["in_approach"], got["clear"]) == (8, 8, False)
    none = spatial.box_counts(gates, cube.limit(0), "ord", 4.0).first()
    assert none["clear"] and none["in_opening"] == 0


def test_copies_of_gates_are_not_broadcast(spark):
    # 2,000 gates pass for 100 kB, their copies over some 52 * 52 * 13 cells are 70 million rows.
    gates = spark.range(2000).selectExpr("id AS ord", "id * 1.0D AS x", "0.0D AS y", "0.0D AS z", "50.0D AS size", "0.0D AS yaw_deg")
    vertices = spark.range(1 << 20).selectExpr("id * 1.0D AS x", "0.0D AS y", "0.0D AS z")
    plan = spatial.box_counts(gates, vertices, "ord", 4.0, (0.5, 1.5), (0.3, 100.0))._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [_cx" in plan and "BroadcastHashJoin [_cx" not in plan


def test_range_counts_are_those_of_their_sql(spark, tmp_path):
    from isarithm.plans.catalog import oracle_sql, queries

    duckdb = pytest.importorskip("duckdb")
    # Ends of which the computed one falls short of the value, values between hundredths, keys that repeat or are missing.
    nan, inf = float("nan"), float("inf")
    s = [(1, 8241.95), (2, 100.1), (2, 100.1), (None, 0.0), (None, 7.0), (3, None), (4, nan), (5, inf), (6, -inf), (7, 1e300), (8, -100.1), (9, 0.004)]
    c = [8191.95, 8291.95, 50.1, 150.1, 50.099, 50.0, -50.0, 57.001, -0.0, nan, nan, inf, -inf, 1e300, None, -150.1, -50.1, 50.0049, 50.004]
    spark.createDataFrame(s, "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame(list(enumerate(c)), "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = sorted(map(repr, map(tuple, queries()["range_left_count"](spark, str(tmp_path)).select("s_suppkey", "n").collect())))
    con = duckdb.connect()
    for t in ("supplier", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert got == sorted(map(repr, con.execute(oracle_sql()["range_left_count"]).fetchall()))


def test_lap(spark):
    df = spark.createDataFrame([("a", 1, 0.0, 0.0), ("a", 2, 30.0, 0.0), ("a", 3, 30.0, 40.0), ("b", 1, 5.0, 5.0)], "g string, i int, x double, y double")
    assert {r["g"]: r["length"] for r in sequence.ring_length(df, ["g"], ["i"], "x", "y").collect()} == {"a": 120.0, "b": 0.0}


def test_tree_cuts_cover_once(spark):
    nodes = [("A", "r", None, 2.0, "r.b3dm", 2), ("A", "x", "r", 0.5, "x.b3dm", 1), ("A", "y", "r", 0.5, "y.b3dm", 1), ("A", "p", "x", 0.1, "p.b3dm", 0), ("A", "q", "y", 0.1, "q.b3dm", 0)]
    df = spark.createDataFrame(nodes, "block string, node string, parent string, error double, uri string, n_children int")
    cut = lambda e: sorted(r["node"] for r in tree.tree_cut(df, e).collect())
    assert cut(2.0) == ["r"] and cut(0.5) == ["x", "y"] and cut(0.1) == ["p", "q"] and cut(0) == ["p", "q"]


def test_shelves_do_not_overlap(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate(rng.uniform(8, 30, 48))], "id long, w double")
    spots = select.shelf_pack(df, "id", F.col("w"), F.lit(12.0), 0.25, 1024, "id").collect()
    used = np.zeros((2000, 1024), int)
    for s in spots:
        used[s["y"] : s["y"] + s["h"], s["x"] : s["x"] + s["w"]] += 1
        assert s["x"] + s["w"] <= 1024
    assert used.max() == 1


def test_round_robin_takes_every_group_first(spark):
    df = spark.createDataFrame([("a", 9.0), ("a", 8.0), ("a", 7.0), ("b", 1.0), ("c", 5.0)], "g string, s double")
    assert [(r["g"], r["s"]) for r in select.round_robin(df, "g", [F.desc("s")], 4).orderBy("place").collect()] == [("a", 9.0), ("c", 5.0), ("b", 1.0), ("a", 8.0)]


def test_hull_anti_join(spark):
    square = spark.createDataFrame([(1, 0.0, 0.0), (1, 10.0, 0.0), (1, 10.0, 10.0), (1, 0.0, 10.0), (1, 5.0, 5.0)], "b int, x double, y double")
    points = spark.createDataFrame([(1, 5.0, 4.0), (2, 15.0, 5.0), (3, 30.0, 5.0), (4, 19.0, 19.0)], "id int, x double, y double")
    hulls = spatial.hulls(square, "b", "x", "y")
    assert hulls.select(F.size("hull")).first()[0] == 4
    assert sorted(r["id"] for r in spatial.outside_hulls(points, hulls, "x", "y", 12.0, 20.0).collect()) == [3, 4]


def test_area_report(spark):
    row = report.area_report(spark, "m", (662000.0, 6473000.0, 663000.0, 6474000.0)).first()
    assert row["chunks"] == 16 and row["sheets_1km"] == ["473662"] and 58 < row["south_west"]["lat"] < 59

"""A whole map on small fixtures."""

import numpy as np
from pyspark.sql import functions as F

from isarithm.functions import projection as P
from isarithm.operators import build, scene, spatial
from isarithm.sources import gltf
from tests.test_geometry import box_faces, one

BOX = (0.0, 0.0, 40.0, 20.0)


def plane(spark):
    rows = [(0, x + 0.5, y + 0.5, 5.0 + 0.25 * (x + 0.5) + 0.5 * (y + 0.5)) for x in range(-4, 44) for y in range(-4, 24)]
    return build.heights(spark.createDataFrame(rows, "sheet int, x double, y double, h double"), BOX, 1.0)


def houses(spark):
    corners = [(x, y, z) for x in (18.0, 24.0) for y in (8.0, 14.0) for z in (0.0, 30.0)]
    quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
    faces = [("in", k, *f) for k, f in enumerate(f for a, b, c, d in quads for f in ((a, b, c), (a, c, d)))]
    v = [("in", i, *p) for i, p in enumerate(corners)] + [("out", i, p[0] + 500.0, p[1], p[2]) for i, p in enumerate(corners)]
    f = faces + [("out", *x[1:]) for x in faces]
    return spark.createDataFrame(f, "b string, fid int, a int, b2 int, c int").toDF("b", "fid", "a", "_b", "c"), spark.createDataFrame(v, "house string, vid int, x double, y double, z double")


def test_a_whole_map(spark, tmp_path):
    f, v = houses(spark)
    f = f.select(F.col("b").alias("house"), "fid", "a", F.col("_b").alias("b"), "c")
    gates = spark.createDataFrame([(1, 21.0, 2.0, 6.0, 4.0, 0.25, 0.0), (2, 21.0, 11.0, 6.0, 4.0, 0.25, 90.0), (3, 35.0, 18.0, 90.0, 4.0, 0.25, 0.0)], "ord int, east double, north double, height_m double, size_m double, bar_m double, yaw_deg double")
    field = plane(spark)
    vertices, faces, report = build.build_map(spark, "m", BOX, (20.0, 10.0), field, 5.0, 20.0, sink=1.0, houses=(f, v, ["house"]), gates=gates)
    told = {r["mesh"]: r for r in scene.mesh_report(vertices, faces).collect()}
    assert {m for m in told if m.startswith("terrain")} == {"terrain_r00c00", "terrain_r00c01"}
    assert told["terrain_r00c00"]["vertices"] == 25 and told["terrain_r00c00"]["triangles"] == 32
    assert {m: told[m]["triangles"] for m in told if m.startswith("build")} == {"buildings_r00c01_roofs": 2, "buildings_r00c01_walls": 10}
    assert sum(m.startswith("course_gate") for m in told) == 12
    for r in vertices.where("mesh LIKE 'terrain%'").collect():  # the ground is a plane, a metre sunk, around the origin
        assert abs(r["y"] - (0.25 * r["x"] - 0.5 * r["z"] - 1.0)) < 1e-9
    row = report.first().asDict()
    assert row["origin"] == [20.0, 10.0, 15.0] and row["buildings_in_bbox"] == 1 and row["gates"] == 3
    assert row["triangles"] == sum(r["triangles"] for r in told.values()) and row["meshes"] == len(told) and row["vertices"] == vertices.count()
    assert 3 not in row["blocked_gates"]
    hidden = build.build_map(spark, "m", BOX, (20.0, 10.0), field, 5.0, 0.0, private=True)
    assert "bbox" not in hidden[2].columns and "origin" not in hidden[2].columns and {r["mesh"] for r in hidden[0].select("mesh").distinct().collect()} == {"terrain"}
    assert gltf.write_tables(vertices, faces, str(tmp_path / "m.glb")) == (tmp_path / "m.glb").stat().st_size
    assert gltf.stats(gltf.documents(spark, str(tmp_path / "m.glb"))).first()["triangles"] == row["triangles"]


def test_survey_tiles_of_the_cut(spark):
    x, y, z = one(spark, *P.geodetic_to_geocentric(F.lit(58.3747), F.lit(26.7726), F.lit(40.0)))
    nodes = spark.createDataFrame([("b", "r", None, 8.0, "file:/t/top.b3dm", 2), ("b", "k", "r", 0.5, "file:/t/near.b3dm", 0), ("b", "l", "r", 0.5, "file:/t/far.b3dm", 0)], "block string, node string, parent string, error double, uri string, n_children int")
    at = lambda d: [[d, 0.0, 0.0], [d + 1.0, 0.0, 0.0], [d, 1.0, 0.0]]
    tiles = spark.createDataFrame([(f"file:/t/{n}.b3dm", "", at(d), uv, [[0, 1, 2]], 0, k) for n, d, uv, k in (("top", 0.0, [], 0), ("near", 0.0, [[0.25, 0.5]] * 3, 0), ("near", 2.0, [], 1), ("far", 50000.0, [], 0))], gltf.MESH)
    m = spark.createDataFrame([("b", [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, x, y, z, 1.0])], "block string, m array<double>")
    v, f = build.survey(nodes, tiles, m, 1.0, (662180.6, 6473820.3, 0.0), -19.0, (662000.0, 6473000.0, 663000.0, 6474000.0))
    rows = {(r["mesh"], r["vid"]): r for r in v.collect()}
    assert {k[0] for k in rows} == {"mesh_near_0_0", "mesh_near_0_1"} == {r["mesh"] for r in f.collect()} and len(rows) == 6
    assert (rows["mesh_near_0_0", 1]["u"], rows["mesh_near_0_0", 1]["v"]) == (0.25, 0.5) and rows["mesh_near_0_1", 1]["u"] == 0
    assert abs(rows["mesh_near_0_0", 0]["y"] - 21) < 0.01


def test_painted_walls_use_the_whole_of_their_place(spark):
    faces = box_faces(spark).where("fid IN (4, 5)").withColumn("panel", F.lit(7))
    lows = faces.select(F.explode(F.array("pa", "pb", "pc")).alias("p")).agg(*[F.min(f"p.{c}").alias(c) for c in "xyz"]).first()
    along = [c for c in "xy" if faces.select(F.explode(F.array("pa", "pb", "pc")).alias("p")).agg(F.count_distinct(f"p.{c}")).first()[0] == 2][0]
    kind = "struct<x: double, y: double, z: double>"
    panel = spark.createDataFrame([(7, tuple(lows), (1.0 * (along == "x"), 1.0 * (along == "y"), 0.0), 12.0, 9.0)], f"panel int, origin {kind}, u_axis {kind}, width double, height double")
    packed = spark.createDataFrame([(7, 10, 20, 30, 40)], "panel int, x int, y int, w int, h int")
    v, f = build.walls(panel, packed, faces, (100, 200), (0.0, 0.0, 0.0))
    assert {(round(r["u"], 9), round(r["v"], 9)) for r in v.collect()} == {(a, b) for a in (0.1, 0.4) for b in (0.1, 0.3)}
    ids = {r["vid"] for r in v.collect()}
    assert len(ids) == 6 and {x for r in f.collect() for x in (r["a"], r["b"], r["c"])} == ids
    covered = spark.createDataFrame([(7, 0.5), (8, 0.0)], "panel int, coverage double")
    two = panel.unionByName(panel.withColumn("panel", F.lit(8)))
    assert tuple(build.coverage(two, covered).first()) == (2, 1, 0.25)


def test_the_nearest_on_a_line_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(spatial, "BINS", 2)
    rng = np.random.default_rng(3)
    points, donors = rng.uniform(0, 1000, 60), np.round(rng.choice([10.0, 20.0, 600.0, 610.0, 990.0], 12) + rng.uniform(-5, 5, 12), 3)
    p = spark.createDataFrame([(i, float(x)) for i, x in enumerate(points)], "id int, x double")
    d = spark.createDataFrame([(i, float(x)) for i, x in enumerate(donors)], "who int, at double")
    got = {r["id"]: (r["donor"], r["distance"]) for r in spatial.nearest_on_line(p, d, ["id"], "x", "who", "at", 10.0).collect()}
    for i, x in enumerate(points):
        gap, who = min((abs(x - y), j) for j, y in enumerate(donors))
        assert got[i][0] == who and abs(got[i][1] - gap) < 1e-9

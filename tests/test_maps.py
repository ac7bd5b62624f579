"""Composed stages on small fixtures."""

import numpy as np
from pyspark.sql import functions as F

from isarithm.functions import projection as P
from isarithm.operators import maps, mesh, sequence
from tests.test_geometry import box_faces, one


def test_elevation_takes_the_first_sheet_and_fills(spark):
    rows = [(s, x + 0.5, y + 0.5, h) for s, x0, h in ((0, 0, 10.0), (1, 4, 30.0)) for x in range(x0, x0 + 6) for y in range(6)]
    cells = spark.createDataFrame(rows, "sheet int, x double, y double, h double")
    out = {(r["row"], r["col"]): r["h"] for r in maps.elevation(cells, (0, 0, 12, 6), 2.0, 0.0).collect()}
    assert len(out) == 18 and out[(0, 0)] == out[(0, 2)] == 10 and out[(1, 3)] == 30 and out[(0, 5)] in (10.0, 20.0, 30.0)


def test_warp_lets_the_last_sheet_win(spark):
    cells = spark.createDataFrame([(0, 0.5, 0.5, 1.0), (1, 0.6, 0.4, 5.0), (1, 0.4, 0.6, 7.0), (0, 1.5, 0.5, 2.0), (1, 1.5, 0.5, None)], "sheet int, x double, y double, v double")
    out = {(r["row"], r["col"]): r["v"] for r in maps.warp(cells, (F.col("x"), F.col("y")), (0, 0, 2, 1), 1, 2, ["v"]).collect()}
    assert out == {(0, 0): 6.0, (0, 1): 2.0}


def test_tall_points_and_tour(spark):
    ground = spark.createDataFrame([(float(x), 2.0, float(z)) for x in range(0, 500, 25) for z in range(0, 500, 25)], "x double, y double, z double")
    raster, g = maps.ground_raster(ground, 25.0)
    towers = spark.createDataFrame([(0.0, 3.0, 0.0), (100.0, 52.0, 100.0), (110.0, 45.0, 108.0), (400.0, 32.0, 400.0)], "x double, y double, z double")
    picks = maps.tall_points(towers, raster, g).orderBy("place").collect()
    assert [(round(p["x"]), round(p["height"])) for p in picks] == [(96, 50), (400, 30)]
    shots = maps.auto_tour(spark, (0, 0, 0), (500, 50, 500), spark.createDataFrame([tuple(p) for p in picks], "place int, x double, z double, height double")).orderBy("ord").collect()
    assert [s["name"] for s in shots] == ["overview", "landmark-1", "landmark-2", "spawn"] and shots[1]["radius_m"] == 125.0


def test_terrain_chunks_share_points_and_keep_triangles(spark):
    points, faces = maps.terrain_chunks(spark, (0, 0, 100, 60), 10.0, 50.0)
    whole = mesh.lattice_faces(spark, 7, 11).count()
    per = {r["chunk"]: r["count"] for r in faces.groupBy("chunk").count().collect()}
    assert sum(per.values()) == whole == 120 and set(per) == {"terrain_r00c00", "terrain_r00c01"}
    assert points.groupBy("i", "j").count().where("count > 1").select("j").distinct().collect()[0][0] == 5
    own = points.select("chunk", (F.col("i") * 11 + F.col("j")).alias("p"))
    used = faces.select("chunk", F.explode(F.array("a", "b", "c")).alias("p"))
    assert used.join(own, ["chunk", "p"], "left_anti").count() == 0


def test_building_meshes(spark):
    rows = maps.building_meshes(box_faces(spark), (6.0, 6.0, 0.0), roof_box=(0.0, 0.0, 12.0, 12.0))
    count = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}
    assert count == {"roofs": 6, "walls": 30}
    uv = [tuple(r["uv"]) for r in rows.where("part = 'roofs'").collect()]
    assert set(uv) <= {(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)}


def test_survey_mesh_lands_on_the_map(spark):
    x, y, z = one(spark, *P.geodetic_to_geocentric(F.lit(58.3747), F.lit(26.7726), F.lit(40.0)))
    tiles = spark.createDataFrame([("b", "near", 0, 0.0, 0.0, 0.0), ("b", "far", 0, 50000.0, 0.0, 0.0)], "block string, mesh string, vid int, x double, y double, z double")
    m = spark.createDataFrame([("b", [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, x, y, z, 1.0])], "block string, m array<double>")
    out = maps.survey_vertices(tiles, m, (662180.6, 6473820.3, 0.0), -19.0, (662000.0, 6473000.0, 663000.0, 6474000.0)).collect()
    assert [r["mesh"] for r in out] == ["near"]
    assert abs(out[0]["p"]["x"]) < 0.5 and abs(out[0]["p"]["z"]) < 0.5 and abs(out[0]["p"]["y"] - 21) < 0.01


def test_clearance_over_ground(spark):
    ground = spark.createDataFrame([(float(x), 10.0, float(z)) for x in range(-50, 51, 10) for z in range(-50, 51, 10)], "x double, y double, z double")
    raster, g = maps.ground_raster(ground, 10.0)
    gates = spark.createDataFrame([(1, 100.0, 200.0, 6.0, 5.0, 0.0), (2, 120.0, 200.0, 6.0, 5.0, 90.0)], "ord int, east double, north double, height_m double, size_m double, yaw_deg double")
    cube = spark.createDataFrame([("tree", 0.1, 16.2, 0.3), ("course_gate01_top", 0.0, 16.0, 0.0)], "mesh string, x double, y double, z double")
    out = {r["ord"]: (r["in_opening"], r["clear"]) for r in maps.clearance(gates, cube, raster, g, (100.0, 200.0)).collect()}
    assert out == {1: (1, False), 2: (0, True)}


def test_bake_blends_fills_and_borrows(spark):
    texels = [(1, 0, 0, 10.0), (1, 0, 1, 30.0), (1, 1, 0, None), (1, 1, 1, None), (2, 0, 0, None), (3, 0, 0, None), (4, 0, 0, 50.0)]
    t = spark.createDataFrame(texels, "panel int, texel int, source int, value double")
    scores = spark.createDataFrame([(1, 0, 1.0), (1, 1, 0.5), (4, 0, 0.2)], "panel int, source int, score double")
    kind = "struct<x: double, y: double, z: double>"
    panels = spark.createDataFrame([(1, "a", 9.0, (0.0, 0.0, 0.0)), (2, "a", 9.0, (900.0, 0.0, 0.0)), (3, "b", 9.0, (990.0, 0.0, 0.0)), (4, "c", 9.0, (1000.0, 0.0, 0.0))], f"panel int, building string, area double, origin {kind}")
    out = {(r["panel"], r["texel"]): round(r["value"], 6) for r in maps.bake(t, scores, panels).collect()}
    mix = round((10 + 30 * 0.0625) / 1.0625, 6)
    assert out == {(1, 0): mix, (1, 1): mix, (2, 0): mix, (3, 0): 50.0, (4, 0): 50.0}


def test_pyramids_samples_and_numbers(spark):
    w, h = F.lit(7952), F.lit(5304)
    assert one(spark, maps.pyramid_level(w, h))[0] == 13 and one(spark, maps.pyramid_level(w, h, 20))[0] == 13
    assert tuple(one(spark, maps.pyramid_size(w, h, F.lit(12)))[0]) == (3976, 2652) and tuple(one(spark, maps.pyramid_size(w, h, F.lit(10)))[0]) == (994, 663)
    photos = spark.createDataFrame([(1, 7952, 5304)], "id int, width int, height int")
    assert maps.pyramid_tiles(photos, "id", 10).count() == 4 * 3
    shots = spark.createDataFrame([("m-ingame-3.jpg",), ("m-ingame-12.jpg",), ("x.jpg",)], "path string")
    assert maps.next_number(shots, "path").first()[0] == 13 and maps.next_number(shots.limit(0), "path").first()[0] == 1
    from isarithm.operators import facade

    panels = facade.wall_panels(box_faces(spark))
    samples = maps.panel_samples(panels, "first_fid").groupBy("first_fid").count().collect()
    assert [r["count"] for r in samples] == [8 * 6] * 4


def test_height_prefix_takes_whole_chunks(spark):
    rows = [(f, p, 2 if p % 2 else 5) for f in range(2) for p in range(100)]
    df = spark.createDataFrame(rows, "f int, p int, class int")
    got = maps.height_prefix(df, "f", "p", 10, 12, F.col("class") == 2)
    assert got.count() == 15 and got.agg(F.max("p")).first()[0] == 29


def test_control_points_avoid_buildings(spark):
    square = spark.createDataFrame([(1, 40.0, 40.0), (1, 60.0, 40.0), (1, 60.0, 60.0), (1, 40.0, 60.0)], "b int, x double, y double")
    from isarithm.operators import spatial

    points = maps.control_points(spark, (0.0, 0.0, 100.0, 100.0), spatial.hulls(square, "b", "x", "y"), 10, 5.0, 12.0).collect()
    xy = np.array([(p["x"], p["y"]) for p in points])
    gap = np.hypot(np.maximum(0, np.abs(xy[:, 0] - 50) - 10), np.maximum(0, np.abs(xy[:, 1] - 50) - 10))
    assert gap.min() > 12 and 60 < len(points) < 100
    assert sequence.even_runs(5, 2) == [(0, 2), (2, 5)]


def test_the_right_reading_of_the_corners_wins(spark):
    rng = np.random.default_rng(7)
    from isarithm.operators import facade

    gray = rng.uniform(0, 255, (40, 60))
    ring = [(0.0, 40.0), (0.0, 0.0), (60.0, 0.0), (60.0, 40.0)]  # north-west, south-west, south-east, north-east
    photos = spark.createDataFrame([(1, 60, 40, ring[1:] + ring[:1])], "id int, width int, height int, corners array<struct<e: double, n: double>>")
    cells = spark.createDataFrame([(1, r, c, float(gray[r, c])) for r in range(40) for c in range(60)], "id int, row int, col int, gray double")
    control = spark.createDataFrame([(1, c + 0.5, 39.5 - r, float(gray[r, c])) for r in range(39) for c in range(59)], "id int, x double, y double, lum double")
    scores = facade.ordering_scores(facade.readings(photos), control, cells, "id", (60, 40)).collect()
    best = max(scores, key=lambda r: r["corr"])
    assert len(scores) == 8 and (best["rot"], best["rev"]) == (3, False) and best["corr"] > 0.99
    assert sorted(r["corr"] for r in scores)[-2] < 0.3


def test_image_samples(spark):
    from isarithm.operators import facade

    cells = spark.createDataFrame([(0, 0, 0.0), (0, 1, 10.0), (1, 0, 20.0), (1, 1, 30.0)], "row int, col int, v double")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.0, 0.0), (3, 1.0, 0.5), (4, -0.1, 0.0)], "id int, x double, y double")
    out = {r["id"]: r["v"] for r in facade.sample_image(points, cells, ["id"], F.col("x"), F.col("y"), 2, 2, ["v"]).collect()}
    assert out == {1: 15.0, 2: 0.0}


def test_tours_views_and_reports(spark, tmp_path):
    from isarithm.functions import geometry as G
    from isarithm.functions import texts
    from isarithm.operators import report
    from isarithm.sources import files

    text = """[tour]
fps = 30
[[tour.shot]]
seconds = 8.0
target = [100.0, 200.0]
[[tour.shot]]
kind = "fly"
name = "over"
seconds = 6.0
start = [0.0, 0.0]
end = [100.0, 0.0]
"""
    form, shots = files.load_tour(spark, text, (100.0, 100.0))
    assert form["fps"] == 30 and [r["name"] for r in shots.orderBy("ord").collect()] == ["shot-1", "over"]
    assert tuple(shots.where("ord = 1").first()["target"]) == (0.0, -100.0) and files.load_tour(spark, "[map]", (0, 0)) is None
    frames = sequence.frames(shots, shots.columns, "seconds", 30)
    assert frames.count() == 420
    ahead = shots.where("kind = 'fly'").select(sequence.look_ahead(F.lit(0.5), F.lit(30.0), F.col("start"), F.col("end")).alias("p")).first()["p"]
    assert abs(ahead["x"] + 20.0) < 1e-9
    view = one(spark, G.look_at(G.vec(0.0, 0.0, 5.0), G.vec(0.0, 0.0, 0.0)))[0]
    assert tuple(view["right"]) == (1, 0, 0) and tuple(view["up"]) == (0, 1, 0) and tuple(view["back"]) == (0, 0, 1)
    assert abs(one(spark, G.perspective(F.lit(90.0), 2.0, 1.0, 100.0))[0]["sy"] - 1) < 1e-12
    df = spark.createDataFrame([("a", True, [1.0], [("d", ["f"])]), ("b", False, [2.0], [("d", ["f"])])], "map string, private boolean, box array<double>, sources array<struct<dataset: string, files: array<string>>>")
    lines = {r["map"]: r["json"] for r in report.to_lines(report.redacted(df, "private", ["box"], "sources"), "map").collect()}
    assert "box" not in lines["a"] and "files" not in lines["a"] and '"files":["f"]' in lines["b"]
    assert one(spark, texts.first_keyword(F.lit("z_concrete2"), {"asphalt": "a", "concrete": "c"}, "-"))[0] == "c"
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    assert report.cached(spark, str(tmp_path / "t"), build).count() == report.cached(spark, str(tmp_path / "t"), build).count() == 3 and len(built) == 1


def test_poses_and_pinhole(spark):
    import math

    from isarithm.functions import geometry as G

    spot = "struct<x: double, z: double>"
    rows = [("orbit", 0.5, (1.0, 2.0), None, None, 10.0, 4.0, 0.5, 0.0), ("reveal", 0.0, (0.0, 0.0), None, None, 100.0, 20.0, 1.0, 90.0), ("fly", 0.25, (0.0, 0.0), (0.0, 0.0), (40.0, 80.0), 0.0, 7.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, f"kind string, t double, target {spot}, start {spot}, end {spot}, radius_m double, height_m double, turns double, start_deg double")
    out = {r["kind"]: (r["x"], r["z"], r["above"]) for r in sequence.poses(df).collect()}
    want = {"orbit": (1.0, 12.0, 4.0), "reveal": (0.0, 25.0, 3.0), "fly": (10.0, 20.0, 7.0)}
    assert all(math.isclose(a, b, abs_tol=1e-9) for k in want for a, b in zip(out[k], want[k], strict=True))
    turn = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in ((1, 0, 0), (0, 0, -1), (0, 1, 0))])
    p = one(spark, G.project(G.vec(3.0, 100.0, 48.0), G.vec(0.0, 0.0, 50.0), turn, F.lit(1000.0)))[0]
    assert tuple(p) == (30.0, 20.0, 100.0)

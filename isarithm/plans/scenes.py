"""Pieces of scenes and the choice of photographs, over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.operators import facade, mesh, photos, scene
from isarithm.plans.rasters import SURFACE, _surface
from isarithm.plans.registry import query


@query("preview_pixels", "SELECT p_partkey, (p_size * 20.0::DOUBLE - (100.0::DOUBLE - 40.0::DOUBLE)) * (640 / 1000.0::DOUBLE) AS px, (0.0::DOUBLE - p_retailprice + (2500.0::DOUBLE - 30.0::DOUBLE)) * (320 / 500.0::DOUBLE) AS py FROM part")
def preview_pixels(t):
    at = scene.preview_pixel(F.col("p_size") * 20.0, -F.col("p_retailprice"), (100.0, 2000.0, 1100.0, 2500.0), (40.0, 30.0), 640)
    return t("part").select("p_partkey", at["px"].alias("px"), at["py"].alias("py"))


@query("sun_directions", """
SELECT n_nationkey, round(cos(radians(e)) * sin(radians(a)), 9) AS x, round(sin(radians(e)), 9) AS y, round(cos(radians(e)) * cos(radians(a)), 9) AS z
FROM (SELECT n_nationkey, n_nationkey * 15.0::DOUBLE AS a, n_regionkey * 10.0::DOUBLE + 5.0::DOUBLE AS e FROM nation) UNION ALL
SELECT -1, round(cos(radians(42.0::DOUBLE)) * sin(radians(150.0::DOUBLE)), 9), round(sin(radians(42.0::DOUBLE)), 9), round(cos(radians(42.0::DOUBLE)) * cos(radians(150.0::DOUBLE)), 9)""")
def sun_directions(t):
    own = t("nation").select("n_nationkey", scene.sun_direction(F.col("n_nationkey") * 15.0, F.col("n_regionkey") * 10.0 + 5.0).alias("s"))
    usual = t("region").where("r_regionkey = 0").select(F.lit(-1).cast(own.schema[0].dataType).alias("n_nationkey"), scene.sun_direction().alias("s"))
    return own.unionByName(usual).select("n_nationkey", *[F.round(f"s.{c}", 9).alias(c) for c in "xyz"])


@query("fog_distances", """
WITH k AS (SELECT c_custkey, c_nationkey % 3 * 100.0::DOUBLE AS a, c_nationkey % 2 * 2000.0::DOUBLE AS b, abs(c_acctbal) AS d FROM customer)
SELECT c_custkey, CASE WHEN a > 0 AND b > 0 THEN a ELSE greatest(a, d * 1.5::DOUBLE) END AS near, CASE WHEN a > 0 AND b > 0 THEN b ELSE greatest(b, d * 8.0::DOUBLE) END AS far FROM k""")
def fog_distances(t):
    haze = scene.fog(F.col("c_nationkey") % 3 * 100.0, F.col("c_nationkey") % 2 * 2000.0, F.abs("c_acctbal"))
    return t("customer").select("c_custkey", haze["near"].alias("near"), haze["far"].alias("far"))


@query("read_resolutions", "SELECT p_partkey, greatest(5.0::DOUBLE, p_size / 2.0::DOUBLE) AS res FROM part")
def read_resolutions(t):
    return t("part").select("p_partkey", scene.read_resolution(F.col("p_size").cast("double"), F.lit(5.0)).alias("res"))


@query("template_materials", "SELECT p_partkey, p_size % 3 = 0 AS template FROM part")
def template_materials(t):
    named = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("z_"), "p_brand")).otherwise(F.concat(F.lit("az_"), "p_brand"))
    return t("part").select("p_partkey", scene.is_template(named).alias("template"))


@query("page_types", "SELECT page_id, page_id % 3 = 0 AS is_page FROM pages")
def page_types(t):
    kind = F.element_at(F.array(F.lit(" Text/HTML; charset=utf-8"), F.lit("application/zip"), F.lit("image/tiff;text/html")), (F.col("page_id") % 3 + 1).cast("int"))
    return t("pages").select("page_id", scene.is_page(kind).alias("is_page"))


@query("horizon_square", f"""
WITH {SURFACE} SELECT CAST(vid AS INTEGER) AS vid, 500.0::DOUBLE + x * 12000.0::DOUBLE AS x, (SELECT min(h) FROM s) - 3.0::DOUBLE AS y, -200.0::DOUBLE + z * 12000.0::DOUBLE AS z
FROM (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1)) AS k(vid, x, z)""")
def horizon_square(t):
    return scene.horizon(_surface(t), (0.0, 0.0, -400.0), (1000.0, 80.0, 0.0))


@query("checker_board", """
SELECT CAST(a.range AS INTEGER) AS "row", CAST(b.range AS INTEGER) AS col, CASE WHEN o THEN 255 ELSE 250 END AS r, CASE WHEN o THEN 120 ELSE 250 END AS g, CASE WHEN o THEN 0 ELSE 250 END AS b
FROM range(64) a, range(64) b, LATERAL (SELECT (a.range // 8 + b.range // 8) % 2 = 1 AS o)""")
def checker_board(t):
    return scene.checker(t("region").sparkSession, 64, 8)


@query("plain_materials", """
WITH k AS (SELECT p_partkey, p_size * 5 AS r, p_partkey % 256 AS g, 10 AS b FROM part)
SELECT p_partkey, round(CASE WHEN r / 255.0::DOUBLE <= 0.04045::DOUBLE THEN r / 255.0::DOUBLE / 12.92::DOUBLE ELSE pow((r / 255.0::DOUBLE + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END, 9) AS r,
       round(CASE WHEN g / 255.0::DOUBLE <= 0.04045::DOUBLE THEN g / 255.0::DOUBLE / 12.92::DOUBLE ELSE pow((g / 255.0::DOUBLE + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END, 9) AS g,
       round(10 / 255.0::DOUBLE / 12.92::DOUBLE, 9) AS b, 1.0::DOUBLE AS a, 0.0::DOUBLE AS metallic, 1.0::DOUBLE AS roughness FROM k""")
def plain_materials(t):
    made = t("part").select("p_partkey", scene.material(F.col("p_name"), F.col("p_size") * 5, F.col("p_partkey") % 256, F.lit(10)).alias("m"))
    return made.select("p_partkey", *[F.round(F.col("m.base")[i], 9).alias(c) for i, c in enumerate("rgba")], "m.metallic", "m.roughness")


@query("orthophoto_pixels", """
WITH p AS (
  SELECT l_linenumber AS sheet, CAST(floor((50.0::DOUBLE - (l_quantity - 0.5::DOUBLE)) / 2.5::DOUBLE) AS INTEGER) AS r, CAST(floor((l_partkey % 61 + 0.5::DOUBLE) / 3.0::DOUBLE) AS INTEGER) AS c,
         floor(l_extendedprice / 100) AS red, l_suppkey AS green, l_linenumber * 10.0::DOUBLE - 20.0::DOUBLE AS blue FROM lineitem),
m AS (SELECT r, c, sheet, avg(red) AS red, avg(green) AS green, avg(blue) AS blue FROM p WHERE r BETWEEN 0 AND 19 AND c BETWEEN 0 AND 19 GROUP BY ALL),
f AS (SELECT r, c, arg_min(red, sheet) AS red, arg_min(green, sheet) AS green, arg_min(blue, sheet) AS blue FROM m GROUP BY r, c)
SELECT CAST(a.range AS INTEGER) AS "row", CAST(b.range AS INTEGER) AS col, coalesce(CAST(trunc(greatest(0, least(255, red))) AS INTEGER), 0) AS r,
       coalesce(CAST(trunc(greatest(0, least(255, green))) AS INTEGER), 0) AS g, coalesce(CAST(trunc(greatest(0, least(255, blue))) AS INTEGER), 0) AS b
FROM range(20) a CROSS JOIN range(20) b LEFT JOIN f ON f.r = a.range AND f.c = b.range""")
def orthophoto_pixels(t):
    cells = t("lineitem").select(
        F.col("l_linenumber").alias("sheet"), (F.col("l_partkey") % 61 + 0.5).alias("x"), (F.col("l_quantity") - 0.5).alias("y"), F.floor(F.col("l_extendedprice") / 100).alias("r"), F.col("l_suppkey").alias("g"),
        (F.col("l_linenumber") * 10.0 - 20.0).alias("b"),
    )
    return scene.orthophoto(cells, (0.0, 0.0, 60.0, 50.0), 20)


@query("borrowed_texels", """
WITH t AS (SELECT n_nationkey AS panel, n_regionkey AS donor, CAST(n_nationkey % 7 + 1 AS INTEGER) AS h, CAST(n_nationkey % 9 + 1 AS INTEGER) AS w FROM nation),
d AS (SELECT r_regionkey AS donor, CAST(a.range AS INTEGER) AS r, CAST(b.range AS INTEGER) AS c, r_regionkey * 100 + a.range * 10 + b.range AS v FROM region, range(3) a, range(4) b),
k AS (SELECT panel, donor, h, CAST(a.range AS INTEGER) AS r, CAST(b.range AS INTEGER) AS c FROM t, range(8) a, range(10) b WHERE a.range < h AND b.range < w)
SELECT panel, k.r AS "row", k.c AS col, v FROM k JOIN d ON d.donor = k.donor AND d.r = (k.r - k.h + 9) % 3 AND d.c = k.c % 4""")
def borrowed_texels(t):
    targets = t("nation").select(F.col("n_nationkey").alias("panel"), F.col("n_regionkey").alias("donor"), (F.col("n_nationkey") % 7 + 1).cast("int").alias("height"), (F.col("n_nationkey") % 9 + 1).cast("int").alias("width"))
    spots = t("region").select(F.col("r_regionkey").alias("donor"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("k"))
    donors = spots.select("donor", F.floor(F.col("k") / 4).cast("int").alias("row"), (F.col("k") % 4).alias("col"), F.lit(3).alias("d_height"), F.lit(4).alias("d_width"))
    return scene.tile_up(targets, donors.withColumn("v", F.col("donor") * 100 + F.col("row") * 10 + F.col("col")), ["v"])


@query("gate_triangles", """
WITH f(fid, a, b, c) AS (VALUES (0, 0, 4, 6), (1, 0, 6, 2), (2, 1, 3, 7), (3, 1, 7, 5), (4, 0, 1, 5), (5, 0, 5, 4), (6, 2, 6, 7), (7, 2, 7, 3), (8, 0, 2, 3), (9, 0, 3, 1), (10, 4, 5, 7), (11, 4, 7, 6)), b(bar) AS (VALUES ('left'), ('right'), ('top'), ('bottom'))
SELECT printf('course_gate%02d_%s', CAST(n_nationkey + 1 AS INTEGER), bar) AS mesh, fid, a, b, c FROM nation, b, f""")
def gate_triangles(t):
    gates = t("nation").select((F.col("n_nationkey") + 1).alias("ord"), F.lit(0.0).alias("x"), F.lit(6.0).alias("y"), F.lit(0.0).alias("z"), F.lit(5.0).alias("size"), F.lit(0.25).alias("bar"), F.lit(0.0).alias("yaw_deg"))
    return scene.gate_faces(mesh.gate_bars(gates))


@query("assembled_meshes", """
SELECT 'terrain' AS mesh, 231 AS vertices, 400 AS triangles, 0.0::DOUBLE AS x0, 200.0::DOUBLE AS x1, 0.0::DOUBLE AS z0, 100.0::DOUBLE AS z1 UNION ALL
SELECT printf('group%d', CAST(c_nationkey AS INTEGER)), count(*), greatest(count(*) - 2, 0), min(c_acctbal), max(c_acctbal), min(c_custkey)::DOUBLE, max(c_custkey)::DOUBLE FROM customer GROUP BY c_nationkey""")
def assembled_meshes(t):
    from pyspark.sql import Window

    spark = t("region").sparkSession
    ground = mesh.lattice(spark, (0.0, 0.0, 200.0, 100.0), 10.0).select(F.lit("terrain").alias("mesh"), (F.col("i") * 21 + F.col("j")).alias("vid"), "x", F.lit(0.0).alias("y"), F.col("y").alias("z"), "u", "v")
    flat = mesh.lattice_faces(spark, 11, 21).withColumn("mesh", F.lit("terrain"))
    own = t("customer").select(F.format_string("group%d", F.col("c_nationkey").cast("int")).alias("mesh"), F.col("c_custkey").alias("vid"), F.col("c_acctbal").alias("x"), F.lit(0.0).alias("y"), F.col("c_custkey").alias("z"))
    w = Window.partitionBy("mesh").orderBy("vid")
    faces = own.select("mesh", F.col("vid").alias("a"), F.lead("vid", 1).over(w).alias("b"), F.lead("vid", 2).over(w).alias("c")).where("c IS NOT NULL")
    told = scene.mesh_report(*scene.assemble([(ground, flat), (own, faces)]))
    return told.select("mesh", "vertices", "triangles", F.col("low")[0].alias("x0"), F.col("high")[0].alias("x1"), F.col("low")[2].alias("z0"), F.col("high")[2].alias("z1"))


@query("newest_photos", "SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS day FROM orders ORDER BY CAST(o_orderdate AS VARCHAR) DESC, o_orderkey LIMIT 60")
def newest_photos(t):
    return photos.newest(t("orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("day")), "day", "o_orderkey", 60)


@query("pose_gate", "SELECT c_custkey FROM customer WHERE c_acctbal / 10000.0::DOUBLE >= 0.2::DOUBLE AND c_custkey % 90 > 25 AND c_custkey % 90 < 55")
def pose_gate(t):
    return t("customer").where(photos.pose_passes(F.col("c_acctbal") / 10000.0, (F.col("c_custkey") % 90).cast("double"), 0.2)).select("c_custkey")


@query("source_places", "SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber DESC, l_partkey DESC) AS INTEGER) AS place FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, 0 AS l_partkey FROM lineitem GROUP BY ALL)")
def source_places(t):
    scores = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    return photos.by_score(scores, "l_orderkey", "q", "l_linenumber").select("l_orderkey", "l_linenumber", "place")


@query("height_model_choice", """
WITH k AS (SELECT c_nationkey AS photo, c_custkey AS fit, c_acctbal AS corr, 0 AS model FROM customer UNION ALL SELECT s_nationkey, s_suppkey, s_acctbal, 1 FROM supplier)
SELECT photo, arg_min(fit, {'s': -corr, 'm': model, 'f': fit}) AS fit, arg_min(model, {'s': -corr, 'm': model, 'f': fit}) AS model FROM k GROUP BY photo""")
def height_model_choice(t):
    a = t("customer").select(F.col("c_nationkey").alias("photo"), F.col("c_custkey").alias("fit"), F.col("c_acctbal").alias("corr"))
    b = t("supplier").select(F.col("s_nationkey").alias("photo"), F.col("s_suppkey").alias("fit"), F.col("s_acctbal").alias("corr"))
    return facade.best_of(photos.height_models(a, b), ["photo"], "corr", ["model", "fit"]).select("photo", "fit", "model")


_LINE = "({0}n - {1}n) AS {2}x, ({1}e - {0}e) AS {2}y, ({0}e * {1}n - {1}e * {0}n) AS {2}z"


@query("vanishing_azimuths", f"""
WITH k AS (SELECT p_partkey, 0.0::DOUBLE AS ae, 0.0::DOUBLE AS an, 0.0::DOUBLE AS be, 800.0::DOUBLE + p_size AS bn, 600.0::DOUBLE + p_size AS ce, 900.0::DOUBLE AS cn, 500.0::DOUBLE AS de, p_partkey % 17 * -10.0::DOUBLE AS dn FROM part),
l AS (SELECT p_partkey, (ae + be + ce + de) / 4 AS me, (an + bn + cn + dn) / 4 AS mn, {_LINE.format("a", "b", "p")}, {_LINE.format("d", "c", "q")}, {_LINE.format("b", "c", "r")}, {_LINE.format("a", "d", "s")} FROM k),
w AS (SELECT *, px * qy - py * qx AS w1, rx * sy - ry * sx AS w2 FROM l),
v AS (SELECT *, CASE WHEN abs(w1) >= 1e-12::DOUBLE THEN me - (py * qz - pz * qy) / w1 END AS e1, CASE WHEN abs(w1) >= 1e-12::DOUBLE THEN mn - (pz * qx - px * qz) / w1 END AS n1,
  CASE WHEN abs(w2) >= 1e-12::DOUBLE THEN me - (ry * sz - rz * sy) / w2 END AS e2, CASE WHEN abs(w2) >= 1e-12::DOUBLE THEN mn - (rz * sx - rx * sz) / w2 END AS n2 FROM w),
a AS (SELECT p_partkey, 1 AS pair, atan2(e1, n1) AS azimuth FROM v WHERE sqrt(e1 * e1 + n1 * n1) <= 20000 UNION ALL SELECT p_partkey, 2, atan2(e2, n2) FROM v WHERE sqrt(e2 * e2 + n2 * n2) <= 20000)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY pair) - 1 AS INTEGER) AS place, round(azimuth, 6) AS azimuth FROM a""")
def vanishing_azimuths(t):
    spot = lambda e, n: F.struct((e + F.lit(0.0)).alias("e"), (n + F.lit(0.0)).alias("n"))
    ring = F.array(spot(F.lit(0.0), F.lit(0.0)), spot(F.lit(0.0), 800.0 + F.col("p_size")), spot(600.0 + F.col("p_size"), F.lit(900.0)), spot(F.lit(500.0), F.col("p_partkey") % 17 * -10.0))
    found = t("part").select("p_partkey", F.posexplode(photos.vanishing_azimuths(ring)).alias("place", "azimuth"))
    return found.withColumn("azimuth", F.round("azimuth", 6))


@query("wall_views", """
WITH p AS (SELECT c_custkey, CAST(c_custkey % 97 AS DOUBLE) AS x, CAST(c_nationkey AS DOUBLE) AS y, CAST(c_custkey % 31 AS DOUBLE) AS z FROM customer),
c(source, cx, cy, cz) AS (VALUES (0, 40.0::DOUBLE, 300.0::DOUBLE, 20.0::DOUBLE), (1, 60.0, 500.0, 10.0), (2, 10.0, -100.0, 5.0)),
d AS (SELECT *, cx - x AS dx, cy - y AS dy, cz - z AS dz FROM p, c),
v AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS dist, 2000.0::DOUBLE * dx / dy AS u, 2000.0::DOUBLE * dz / dy AS w FROM d WHERE dy > 0)
SELECT c_custkey, source, round(dist, 6) AS distance, round(dy / dist, 9) AS incidence FROM v WHERE dy / dist > 0.35::DOUBLE AND abs(u) < 398 AND abs(w) < 298""")
def wall_views(t):
    rows = [(0, (40.0, 300.0, 20.0)), (1, (60.0, 500.0, 10.0)), (2, (10.0, -100.0, 5.0))]
    turn = F.array(*[F.array(*[F.lit(v) for v in axis]) for axis in ((-1.0, 0.0, 0.0), (0.0, 0.0, -1.0), (0.0, -1.0, 0.0))])
    spark = t("region").sparkSession
    cameras = spark.createDataFrame(rows, "source int, centre struct<x: double, y: double, z: double>").select("source", "centre", turn.alias("rotation"), F.lit(2000.0).alias("f_px"), F.lit(800.0).alias("width"), F.lit(600.0).alias("height"))
    num = lambda c: c.cast("double")
    points = t("customer").select("c_custkey", G.vec(num(F.col("c_custkey") % 97), num(F.col("c_nationkey")), num(F.col("c_custkey") % 31)).alias("p"), G.vec(0.0, 1.0, 0.0).alias("normal"))
    return photos.views(points, cameras).select("c_custkey", "source", F.round("distance", 6).alias("distance"), F.round("incidence", 9).alias("incidence"))

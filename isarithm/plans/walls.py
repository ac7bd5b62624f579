"""Pieces of walls, cameras, tours and photo records, over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.functions import texts
from isarithm.operators import facade, maps
from isarithm.plans.rasters import CENTS, COLS, ROWS, SURFACE, _cents, _surface
from isarithm.plans.registry import query
from isarithm.sources import files


def _num(c):
    return c.cast("double")


@query("planar_uvs", """
WITH k AS (SELECT c_custkey, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y, CAST(c_custkey % 31 AS DOUBLE) AS z, (c_custkey % 5 - 2) / 2.0::DOUBLE AS nx, c_custkey % 4 / 4.0::DOUBLE AS ny FROM customer)
SELECT c_custkey, CASE WHEN ny > 0.5::DOUBLE THEN x WHEN abs(nx) > 0.5::DOUBLE THEN z ELSE x END / 4.0::DOUBLE AS u, CASE WHEN ny > 0.5::DOUBLE THEN z ELSE y END / 4.0::DOUBLE AS v FROM k""")
def planar_uvs(t):
    key = F.col("c_custkey")
    uv = G.planar_uv(F.col("c_acctbal"), _num(F.col("c_nationkey")), _num(key % 31), (key % 5 - 2) / 2.0, key % 4 / 4.0)
    return t("customer").select("c_custkey", uv.alias("uv")).select("c_custkey", "uv.u", "uv.v")


@query("panel_sample_points", """
WITH p AS (SELECT n_nationkey, n_nationkey % 7 + 0.5::DOUBLE AS w, n_nationkey % 4 + 1.0::DOUBLE AS h, n_nationkey * 10.0::DOUBLE AS x, n_regionkey * 10.0::DOUBLE AS y FROM nation),
n AS (SELECT *, CAST(greatest(1, ceil(w / 1.5::DOUBLE)) AS INTEGER) AS nu, CAST(greatest(1, ceil(h / 1.5::DOUBLE)) AS INTEGER) AS nv FROM p),
k AS (SELECT *, CAST(a.range AS INTEGER) AS iu, CAST(b.range AS INTEGER) AS iv, (a.range + 0.5::DOUBLE) * w / nu AS u, (b.range + 0.5::DOUBLE) * h / nv AS v FROM n, range(8) a, range(4) b WHERE a.range < nu AND b.range < nv)
SELECT n_nationkey, iu, iv, round(x + u * 0.6::DOUBLE, 9) AS x, round(y + u * 0.8::DOUBLE, 9) AS y, round(1.0::DOUBLE + v, 9) AS z FROM k""")
def panel_sample_points(t):
    key = F.col("n_nationkey")
    panels = t("nation").select("n_nationkey", (key % 7 + 0.5).alias("width"), (key % 4 + 1.0).alias("height"), G.vec(key * 10.0, F.col("n_regionkey") * 10.0, 1.0).alias("origin"), G.vec(0.6, 0.8, 0.0).alias("u_axis"))
    return maps.panel_samples(panels, "n_nationkey").select("n_nationkey", "iu", "iv", *[F.round(f"p.{c}", 9).alias(c) for c in "xyz"])


@query("atlas_places", """
WITH k AS (SELECT p_partkey, p_partkey % 100 AS x, p_size AS y, p_size + 2 AS w, p_retailprice % 7 AS u, p_size % 5 + 0.25::DOUBLE AS v, CAST(p_size % 9 AS DOUBLE) AS width, 6.0::DOUBLE AS height FROM part)
SELECT p_partkey, round((x + w * (u / greatest(width, 1e-6::DOUBLE))) / 512, 9) AS u, round((y + 20 * (1.0::DOUBLE - v / height)) / 256, 9) AS v,
       CAST(greatest(0, least(p_partkey % 9, trunc((p_partkey % 50 + 0.5::DOUBLE) / 50 * (p_partkey % 9 + 1)))) AS INTEGER) AS cell FROM k""")
def atlas_places(t):
    key, size = F.col("p_partkey"), F.col("p_size")
    uv = maps.atlas_uv(key % 100, size, size + 2, F.lit(20), F.col("p_retailprice") % 7, size % 5 + 0.25, _num(size % 9), F.lit(6.0), (512, 256))
    cell = maps.coarse_cell(key % 50, F.lit(50), (key % 9 + 1).cast("int"))
    return t("part").select("p_partkey", uv.alias("uv"), cell.alias("cell")).select("p_partkey", F.round("uv.u", 9).alias("u"), F.round("uv.v", 9).alias("v"), "cell")


@query("look_at_views", """
WITH e AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS x, c_custkey % 50 + 1.0::DOUBLE AS y, CASE WHEN c_custkey % 10 = 0 THEN 0.0::DOUBLE ELSE c_nationkey * 9.0::DOUBLE + 1 END AS z FROM customer),
f AS (SELECT c_custkey, -x / sqrt(x * x + y * y + z * z) AS fx, -y / sqrt(x * x + y * y + z * z) AS fy, -z / sqrt(x * x + y * y + z * z) AS fz FROM e),
s AS (SELECT *, CASE WHEN abs(fy) > 0.999::DOUBLE THEN -fy ELSE -fz END AS sx, CASE WHEN abs(fy) > 0.999::DOUBLE THEN fx ELSE 0.0::DOUBLE END AS sy, CASE WHEN abs(fy) > 0.999::DOUBLE THEN 0.0::DOUBLE ELSE fx END AS sz FROM f),
r AS (SELECT *, sx / sqrt(sx * sx + sy * sy + sz * sz) AS rx, sy / sqrt(sx * sx + sy * sy + sz * sz) AS ry, sz / sqrt(sx * sx + sy * sy + sz * sz) AS rz FROM s)
SELECT c_custkey, round(rx, 9) + 0.0::DOUBLE AS rx, round(ry, 9) + 0.0::DOUBLE AS ry, round(rz, 9) + 0.0::DOUBLE AS rz, round(ry * fz - rz * fy, 9) + 0.0::DOUBLE AS ux, round(rz * fx - rx * fz, 9) + 0.0::DOUBLE AS uy,
       round(rx * fy - ry * fx, 9) + 0.0::DOUBLE AS uz, round(-fx, 9) + 0.0::DOUBLE AS bx, round(-fy, 9) + 0.0::DOUBLE AS "by", round(-fz, 9) + 0.0::DOUBLE AS bz FROM r""")
def look_at_views(t):
    key = F.col("c_custkey")
    above = key % 10 == 0
    eye = G.vec(F.when(above, 0.0).otherwise(F.col("c_acctbal")), key % 50 + 1.0, F.when(above, 0.0).otherwise(F.col("c_nationkey") * 9.0 + 1))
    view = t("customer").select("c_custkey", G.look_at(eye, G.vec(0.0, 0.0, 0.0)).alias("m"))
    return view.select("c_custkey", *[(F.round(f"m.{row}.{c}", 9) + 0.0).alias(row[0] + c) for row in ("right", "up", "back") for c in "xyz"])


@query("luminances", "SELECT l_orderkey, l_linenumber, (l_quantity + l_partkey + l_suppkey) / 3.0::DOUBLE AS lum FROM lineitem")
def luminances(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", G.luminance(F.col("l_quantity"), F.col("l_partkey"), F.col("l_suppkey")).alias("lum"))


@query("auto_tour_shots", """
SELECT 0 AS ord, 'overview' AS name, 'orbit' AS kind, 14.0::DOUBLE AS seconds, 100.0::DOUBLE AS x, 0.0::DOUBLE AS z, 248.0::DOUBLE AS radius_m, 160.0::DOUBLE AS height_m, 0.3::DOUBLE AS turns, 0.0::DOUBLE AS start_deg, 8.0::DOUBLE AS look_height_m, 42.0::DOUBLE AS fov_deg UNION ALL
SELECT r_regionkey + 1, printf('landmark-%d', CAST(r_regionkey + 1 AS INTEGER)), 'orbit', 10.0, r_regionkey * 10.0::DOUBLE, r_regionkey * -5.0::DOUBLE, greatest(90.0::DOUBLE, h * 2.5::DOUBLE), greatest(60.0::DOUBLE, h * 2.0::DOUBLE), 0.3,
       (r_regionkey + 1) * 60.0::DOUBLE + 200.0::DOUBLE, round(h * 0.55::DOUBLE, 6), NULL FROM (SELECT *, r_regionkey * 20.0::DOUBLE + 10.0::DOUBLE AS h FROM region) UNION ALL
SELECT 1048576, 'spawn', 'reveal', 10.0, 0.0, 0.0, 112.0, 56.0, 0.22, 0.0, 8.0, NULL""")
def auto_tour_shots(t):
    key = F.col("r_regionkey")
    marks = t("region").select((key + 1).cast("int").alias("place"), (key * 10.0).alias("x"), (key * -5.0).alias("z"), (key * 20.0 + 10.0).alias("height"))
    shots = maps.auto_tour(t("region").sparkSession, (-100.0, 0.0, -200.0), (300.0, 80.0, 200.0), marks)
    return shots.select("ord", "name", "kind", "seconds", (F.col("target.x") + 0.0).alias("x"), (F.col("target.z") + 0.0).alias("z"), *[F.round(c, 6).alias(c) for c in ("radius_m", "height_m", "turns", "start_deg", "look_height_m", "fov_deg")])


@query("usable_photo_rows", """
WITH k AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS accuracy, o_orderkey % 5 <> 0 AS tiled, o_totalprice / 100 AS h, ['a7r3', 'a7r4', 'p1'][o_orderkey % 7 % 3 + 1] AS camera, CAST(2019 + o_orderkey % 8 AS VARCHAR) || '-06-01' AS day FROM orders)
SELECT o_orderkey FROM k WHERE accuracy = 2 AND tiled AND h > 400 AND h < 3000 AND camera IN ('a7r3', 'a7r4') AND day >= '2022'""")
def usable_photo_rows(t):
    key = F.col("o_orderkey")
    camera = F.element_at(F.array(F.lit("a7r3"), F.lit("a7r4"), F.lit("p1")), (key % 7 % 3 + 1).cast("int"))
    taken = t("orders").select(
        "o_orderkey", F.when(key % 3 == 0, 1).otherwise(2).alias("accuracy"), (key % 5 != 0).alias("tiled"), (F.col("o_totalprice") / 100).alias("korgus_m"),
        F.concat(F.lit("line/"), camera, F.lit("/1")).alias("rada"), F.concat((key % 8 + 2019).cast("string"), F.lit("-06-01")).alias("date"),
    )
    return facade.usable_photos(taken).select("o_orderkey")


@query("plausible_cameras", """
SELECT c_custkey, h > 0.4::DOUBLE * 5000 AND h < 1.05::DOUBLE * 5000 AND t > 5 AND t < 75 AND rms <= 0.01::DOUBLE * 4000 AS plausible
FROM (SELECT c_custkey, c_acctbal AS h, c_custkey % 90 AS t, c_nationkey * 2.5::DOUBLE AS rms FROM customer)""")
def plausible_cameras(t):
    lit = lambda v: F.lit(float(v))
    return t("customer").select("c_custkey", facade.plausible(F.col("c_acctbal"), lit(5000), F.col("c_custkey") % 90, F.col("c_nationkey") * 2.5, lit(4000)).alias("plausible"))


@query("sampled_pixels", f"""
WITH {SURFACE}, {CENTS}, p AS (SELECT c_custkey, c_custkey % 35 + 0.25::DOUBLE AS x, c_nationkey * 2 + 0.5::DOUBLE AS y FROM customer),
e AS (SELECT c_custkey, CAST(floor(y) + b.range AS INTEGER) AS r, CAST(floor(x) + a.range AS INTEGER) AS c, (CASE WHEN a.range = 1 THEN x - floor(x) ELSE 1.0::DOUBLE - (x - floor(x)) END) * (CASE WHEN b.range = 1 THEN y - floor(y) ELSE 1.0::DOUBLE - (y - floor(y)) END) AS w
  FROM p, range(2) a, range(2) b WHERE x >= 0 AND x < {COLS - 1} AND y >= 0 AND y < {ROWS - 1})
SELECT c_custkey, round(sum(w * h), 3) AS h, round(sum(w * cents.c), 6) AS g FROM e JOIN cents ON cents.r = e.r AND cents.c = e.c GROUP BY c_custkey""")
def sampled_pixels(t):
    points = t("customer").select("c_custkey", (F.col("c_custkey") % 35 + 0.25).alias("x"), (F.col("c_nationkey") * 2 + 0.5).alias("y"))
    cells = _cents(_surface(t)).withColumn("g", _num(F.col("col")))
    out = facade.sample_image(points, cells, ["c_custkey"], F.col("x"), F.col("y"), COLS, ROWS, ["h", "g"])
    return out.select("c_custkey", F.round("h", 3).alias("h"), F.round("g", 6).alias("g"))


@query("remote_names", """
WITH k AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'git@host:own' || c_nationkey || '/' || c_mktsegment || '.git' WHEN 1 THEN 'https://host/own/' || c_custkey || '/' WHEN 2 THEN 'ssh://git@host:22/a/b/' || c_custkey || '.git' ELSE c_name END AS remote FROM customer)
SELECT c_custkey, nullif(regexp_extract(remote, '[:/]([^:/]+/[^/]+?)(?:\\.git)?/?$', 1), '') AS name FROM k""")
def remote_names(t):
    key = F.col("c_custkey")
    by_kind = (
        F.when(key % 4 == 0, F.concat(F.lit("git@host:own"), "c_nationkey", F.lit("/"), "c_mktsegment", F.lit(".git"))).when(key % 4 == 1, F.concat(F.lit("https://host/own/"), "c_custkey", F.lit("/")))
        .when(key % 4 == 2, F.concat(F.lit("ssh://git@host:22/a/b/"), "c_custkey", F.lit(".git"))).otherwise(F.col("c_name"))
    )
    return t("customer").select("c_custkey", texts.owner_and_name(by_kind).alias("name"))


@query("picture_numbers", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR)) + 6 AS INTEGER) AS number FROM orders")
def picture_numbers(t):
    pictures = t("orders").select("o_orderkey", F.col("o_orderdate").alias("modificationTime"), F.col("o_orderkey").cast("string").alias("path"))
    return files.numbered(pictures, 7).select("o_orderkey", "number")


LINK = r'<a href="/([^"]*)">([^<]*)</a>'


@query("linked_records", f"""
SELECT page_id, regexp_extract(m, '{LINK}', 1) AS target, regexp_extract(m, '{LINK}', 2) AS shown FROM (SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 0)) AS m FROM pages)""")
def linked_records(t):
    return files.photo_records(t("pages").select("page_id", "html"), "html", LINK, ["target", "shown"])


@query("ground_heights", """
WITH v AS (SELECT CAST(l_partkey % 200 AS DOUBLE) AS x, l_linenumber * 10.0::DOUBLE AS z, l_quantity AS y FROM lineitem),
g AS (SELECT min(x) AS x0, min(z) AS z0, greatest(1, ceil((max(x) - min(x)) / 4.0::DOUBLE) + 1) AS cols, greatest(1, ceil((max(z) - min(z)) / 4.0::DOUBLE) + 1) AS "rows", median(y) AS m FROM v),
t AS (SELECT least("rows" - 1, round_even((z - z0) / 4.0::DOUBLE, 0)) AS r, least(cols - 1, round_even((x - x0) / 4.0::DOUBLE, 0)) AS c, max(y) AS h FROM v, g GROUP BY ALL)
SELECT CAST(a.range AS INTEGER) AS "row", CAST(b.range AS INTEGER) AS col, coalesce(h, m) AS h FROM g, range(64) a CROSS JOIN range(64) b LEFT JOIN t ON t.r = a.range AND t.c = b.range WHERE a.range < g."rows" AND b.range < g.cols""")
def ground_heights(t):
    vertices = t("lineitem").select(_num(F.col("l_partkey") % 200).alias("x"), F.col("l_quantity").alias("y"), (F.col("l_linenumber") * 10.0).alias("z"))
    return maps.ground_raster(vertices)[0].select("row", "col", "h")


_RAY = """
WITH r AS (SELECT c_custkey, c_custkey % 40 + 0.37::DOUBLE AS ox, c_nationkey + 0.41::DOUBLE AS oy, 0.25::DOUBLE AS oz, c_custkey % 17 * 3.0::DOUBLE AS cx, c_custkey % 13 * 2.0::DOUBLE AS cy, 50.0::DOUBLE AS cz FROM customer),
f AS (SELECT n_nationkey * 2.0::DOUBLE AS ax, n_regionkey * 6.0::DOUBLE AS ay, 20.0::DOUBLE AS az, 4.0::DOUBLE AS bx, 0.5::DOUBLE AS "by", 1.0::DOUBLE AS bz, 0.25::DOUBLE AS ex, 5.0::DOUBLE AS ey, -2.0::DOUBLE AS ez FROM nation),
d AS (SELECT *, sqrt((cx - ox) ** 2 + (cy - oy) ** 2 + (cz - oz) ** 2) AS far FROM r),
u AS (SELECT *, (cx - ox) / far AS dx, (cy - oy) / far AS dy, (cz - oz) / far AS dz FROM d),
p AS (SELECT *, dy * ez - dz * ey AS px, dz * ex - dx * ez AS py, dx * ey - dy * ex AS pz, ox - ax AS sx, oy - ay AS sy, oz - az AS sz FROM u, f),
q AS (SELECT *, bx * px + "by" * py + bz * pz AS det, sy * bz - sz * "by" AS qx, sz * bx - sx * bz AS qy, sx * "by" - sy * bx AS qz FROM p),
h AS (SELECT *, (sx * px + sy * py + sz * pz) / det AS a, (dx * qx + dy * qy + dz * qz) / det AS b, (ex * qx + ey * qy + ez * qz) / det AS t FROM q WHERE abs(det) >= 1e-12::DOUBLE)
"""


@query("occluded_rays", _RAY + "SELECT c_custkey, bool_or(coalesce(a >= 0 AND b >= 0 AND a + b <= 1 AND t > 1e-9::DOUBLE AND t < far, false)) AS occluded FROM r LEFT JOIN h USING (c_custkey) GROUP BY c_custkey")
def occluded_rays(t):
    key = F.col("c_custkey")
    rays = t("customer").select("c_custkey", G.vec(key % 40 + 0.37, F.col("c_nationkey") + 0.41, 0.0).alias("p"), G.vec(0.0, 0.0, 1.0).alias("normal"), G.vec(key % 17 * 3.0, key % 13 * 2.0, 50.0).alias("centre"))
    x, y = F.col("n_nationkey") * 2.0, F.col("n_regionkey") * 6.0
    triangles = t("nation").select(G.vec(x, y, 20.0).alias("pa"), G.vec(x + 4.0, y + 0.5, 21.0).alias("pb"), G.vec(x + 0.25, y + 5.0, 18.0).alias("pc"))
    return facade.occluded(rays, triangles, "c_custkey", 16.0)


@query("reading_scores", """
WITH m AS (SELECT CAST(r_regionkey AS INTEGER) AS photo, CAST(k.range AS INTEGER) AS rot, 1.0::DOUBLE + k.range * 0.25::DOUBLE AS sx, k.range * 2.0::DOUBLE AS tx, 1.0::DOUBLE - k.range * 0.125::DOUBLE AS sy FROM region, range(4) k),
c AS (SELECT c_nationkey % 5 AS photo, c_custkey % 59 - 29.0::DOUBLE AS x, c_custkey % 41 - 20.0::DOUBLE AS y, round_even(c_acctbal, 0) AS lum FROM customer),
s AS (SELECT m.photo, rot, lum, CAST(floor(sx * x + tx + 30) AS INTEGER) AS col, CAST(floor(sy * y + 20) AS INTEGER) AS r, sx * x + tx + 30 AS px, sy * y + 20 AS py FROM m JOIN c ON c.photo = m.photo),
g AS (SELECT photo, rot, lum, (r * 7 + col * 3 + photo * 11) % 50 AS gray FROM s WHERE px >= 0 AND px < 59 AND py >= 0 AND py < 39)
SELECT photo, rot, count(*) AS n, round(CASE WHEN count(*) < 10 THEN 0.0 ELSE coalesce(corr(gray, lum), 0.0) END, 6) AS corr FROM g GROUP BY ALL""")
def reading_scores(t):
    k, zero, key = F.col("rot"), F.lit(0.0), F.col("c_custkey")
    readings = t("region").select(F.col("r_regionkey").cast("int").alias("photo"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("rot")).select("photo", "rot", F.lit(False).alias("rev"), F.array(1.0 + k * 0.25, zero, k * 2.0, zero, 1.0 - k * 0.125, zero, zero, zero, F.lit(1.0)).alias("m"))
    control = t("customer").select((F.col("c_nationkey") % 5).alias("photo"), (key % 59 - 29.0).alias("x"), (key % 41 - 20.0).alias("y"), F.rint("c_acctbal").alias("lum"))
    spots = t("region").select(F.col("r_regionkey").cast("int").alias("photo"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.lit(59))).alias("col"))
    cells = spots.withColumn("gray", _num((F.col("row") * 7 + F.col("col") * 3 + F.col("photo") * 11) % 50))
    return facade.ordering_scores(readings, control, cells, "photo", (60, 40), least=10).select("photo", "rot", "n", F.round("corr", 6).alias("corr"))


@query("building_triangles", """
WITH k AS (SELECT l_orderkey * 8 + l_linenumber AS fid, l_quantity AS ax, CAST(l_linenumber AS DOUBLE) AS ay, l_tax * 100 AS az, l_quantity + 3.0::DOUBLE AS bx, l_linenumber + l_discount * 10 AS "by", l_partkey % 5 + 1.0::DOUBLE AS bz, l_quantity + l_discount AS ex, l_linenumber + 2.0::DOUBLE AS ey, l_suppkey % 4 + 0.5::DOUBLE AS ez FROM lineitem),
g AS (SELECT fid, ax - 10 AS ax, az - 2 AS ay, -(ay - 20) AS az, bx - 10 AS bx, bz - 2 AS "by", -("by" - 20) AS bz, ex - 10 AS ex, ez - 2 AS ey, -(ey - 20) AS ez FROM k),
c AS (SELECT *, ("by" - ay) * (ez - az) - (bz - az) * (ey - ay) AS cx, (bz - az) * (ex - ax) - (bx - ax) * (ez - az) AS cy, (bx - ax) * (ey - ay) - ("by" - ay) * (ex - ax) AS cz FROM g),
n AS (SELECT *, CASE WHEN len = 0 THEN 0 ELSE cx / len END AS nx, CASE WHEN len = 0 THEN 0 ELSE cy / len END AS ny FROM (SELECT *, sqrt(cx * cx + cy * cy + cz * cz) AS len FROM c)),
p AS (SELECT fid, nx, ny, CAST(i.range AS INTEGER) AS corner, [ax, bx, ex][i.range + 1] AS x, [ay, "by", ey][i.range + 1] AS y, [az, bz, ez][i.range + 1] AS z FROM n, range(3) i)
SELECT fid, corner, CASE WHEN ny > 0.5::DOUBLE THEN 'roofs' ELSE 'walls' END AS part, round(x, 6) + 0.0::DOUBLE AS x, round(y, 6) + 0.0::DOUBLE AS y, round(z, 6) + 0.0::DOUBLE AS z,
       round(CASE WHEN ny > 0.5::DOUBLE THEN (x + 10) / 60 WHEN abs(nx) > 0.5::DOUBLE THEN z / 4 ELSE x / 4 END, 6) + 0.0::DOUBLE AS u, round(CASE WHEN ny > 0.5::DOUBLE THEN (30 - (20 - z)) / 30 ELSE y / 4 END, 6) + 0.0::DOUBLE AS v FROM p""")
def building_triangles(t):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    cornered = t("lineitem").select(
        (F.col("l_orderkey") * 8 + n).alias("fid"), G.vec(q, _num(n), F.col("l_tax") * 100).alias("pa"), G.vec(q + 3.0, n + F.col("l_discount") * 10, F.col("l_partkey") % 5 + 1.0).alias("pb"),
        G.vec(q + F.col("l_discount"), n + 2.0, F.col("l_suppkey") % 4 + 0.5).alias("pc"),
    )
    made = maps.building_meshes(cornered, (10.0, 20.0, 2.0), roof_box=(0.0, 0.0, 60.0, 30.0))
    return made.select("fid", "corner", "part", *[(F.round(c, 6) + 0.0).alias(c[-1]) for c in ("p.x", "p.y", "p.z", "uv.u", "uv.v")])


@query("camera_starts", """
WITH k AS (SELECT s_suppkey, s_nationkey % 2 = 0 AS flat FROM supplier)
SELECT s_suppkey, CAST(r.range AS INTEGER) AS rot, b.range = 1 AS rev, CAST(s.range AS INTEGER) AS seed, CASE WHEN o.range = 1 THEN pi() ELSE 0.0 END AS roll,
       CASE WHEN flat THEN s.range * (pi() / 4) WHEN s.range = 0 THEN 0.5::DOUBLE ELSE 0.5::DOUBLE + pi() END AS azimuth, CAST(CASE WHEN b.range = 1 THEN (r.range + 3) % 4 ELSE r.range END AS DOUBLE) AS first
FROM k, range(4) r, range(2) b, range(8) s, range(2) o WHERE flat OR s.range < 2""")
def camera_starts(t):
    ring = F.array(*[F.struct(F.lit(float(i)).alias("e"), F.lit(0.0).alias("n"), F.lit(0.0).alias("z")) for i in range(4)])
    taken = t("supplier").select("s_suppkey", F.lit(10).alias("width"), F.lit(8).alias("height"), F.lit(900.0).alias("above"), ring.alias("corners"), (F.col("s_nationkey") % 2 == 0).alias("flat"))
    known = F.when(F.col("flat"), F.array().cast("array<double>")).otherwise(F.array(F.lit(0.5)))
    return facade.camera_starts(taken, known, "s_suppkey").select("s_suppkey", "rot", "rev", "seed", "roll", "azimuth", F.col("ground")[0]["e"].alias("first"))

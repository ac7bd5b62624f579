"""Meshes, normals, projections and scalar geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from isarithm.functions import geometry as G
from isarithm.functions import projection as P
from isarithm.functions import texts
from isarithm.operators import facade, mesh
from isarithm.plans.registry import query

#: Customers as a mesh: three neighbours in number make a face.
_VERTICES = "v AS (SELECT c_nationkey AS mesh, c_custkey AS vid, c_acctbal / 100.0::DOUBLE AS x, CAST(c_custkey % 97 AS DOUBLE) AS y, CAST(c_custkey % 31 AS DOUBLE) AS z FROM customer)"
_FACES = """o AS (SELECT mesh, vid, lead(vid, 1) OVER w AS b, lead(vid, 2) OVER w AS c FROM v WINDOW w AS (PARTITION BY mesh ORDER BY vid)),
f AS (SELECT mesh, vid AS fid, vid AS a, b, c FROM o WHERE c IS NOT NULL)"""
_CORNERS = """t AS (
  SELECT f.mesh, f.fid, f.a, f.b, f.c, p.x AS ax, p.y AS ay, p.z AS az, q.x - p.x AS ux, q.y - p.y AS uy, q.z - p.z AS uz, r.x - p.x AS wx, r.y - p.y AS wy, r.z - p.z AS wz
  FROM f JOIN v p ON p.mesh = f.mesh AND p.vid = f.a JOIN v q ON q.mesh = f.mesh AND q.vid = f.b JOIN v r ON r.mesh = f.mesh AND r.vid = f.c),
k AS (SELECT mesh, fid, a, b, c, uy * wz - uz * wy AS kx, uz * wx - ux * wz AS ky, ux * wy - uy * wx AS kz FROM t)"""


def _mesh(t):
    from pyspark.sql import Window

    v = t("customer").select(F.col("c_nationkey").alias("mesh"), F.col("c_custkey").alias("vid"), (F.col("c_acctbal") / 100.0).alias("x"), (F.col("c_custkey") % 97).cast("double").alias("y"), (F.col("c_custkey") % 31).cast("double").alias("z"))
    w = Window.partitionBy("mesh").orderBy("vid")
    f = v.select("mesh", F.col("vid").alias("fid"), F.col("vid").alias("a"), F.lead("vid", 1).over(w).alias("b"), F.lead("vid", 2).over(w).alias("c")).where("c IS NOT NULL")
    return v, f


def _rounded(df, column: str, *keep: str):
    return df.select(*keep, *[F.round(F.col(f"{column}.{c}"), 6).alias(f"n{c}") for c in "xyz"])


@query("face_normals", f"""
WITH {_VERTICES}, {_FACES}, {_CORNERS}
SELECT mesh, fid, round(kx / n, 6) AS nx, round(ky / n, 6) AS ny, round(kz / n, 6) AS nz FROM (SELECT *, CASE WHEN kx * kx + ky * ky + kz * kz = 0 THEN 1.0::DOUBLE ELSE sqrt(kx * kx + ky * ky + kz * kz) END AS n FROM k)""")
def face_normals(t):
    v, f = _mesh(t)
    return _rounded(mesh.with_normals(mesh.corners(f, v, ["mesh"])), "n", "mesh", "fid")


@query("vertex_normals", f"""
WITH {_VERTICES}, {_FACES}, {_CORNERS},
e AS (SELECT mesh, unnest([a, b, c]) AS vid, kx, ky, kz FROM k),
s AS (SELECT mesh, vid, sum(kx) AS x, sum(ky) AS y, sum(kz) AS z FROM e GROUP BY ALL),
d AS (SELECT *, CASE WHEN x * x + y * y + z * z = 0 THEN 1.0::DOUBLE ELSE sqrt(x * x + y * y + z * z) END AS n FROM s)
SELECT mesh, vid, round(x / n, 6) AS nx, round(y / n, 6) AS ny, round(z / n, 6) AS nz FROM d""")
def vertex_normals(t):
    v, f = _mesh(t)
    return _rounded(mesh.vertex_normals(f, v, ["mesh"]), "n", "mesh", "vid")


@query("roof_wall_split", f"""
WITH {_VERTICES}, {_FACES}, {_CORNERS}
SELECT mesh, CASE WHEN ky > 0.5 * sqrt(kx * kx + ky * ky + kz * kz) THEN 'roof' ELSE 'wall' END AS part, count(*) AS n FROM k GROUP BY ALL""")
def roof_wall_split(t):
    v, f = _mesh(t)
    return mesh.classify(mesh.corners(f, v, ["mesh"])).groupBy("mesh", "part").agg(F.count("*").alias("n"))


@query("mesh_centroids", f"""
WITH {_VERTICES}, {_FACES}, u AS (SELECT DISTINCT mesh, unnest([a, b, c]) AS vid FROM f)
SELECT u.mesh, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM u JOIN v ON v.mesh = u.mesh AND v.vid = u.vid GROUP BY u.mesh""")
def mesh_centroids(t):
    v, f = _mesh(t)
    return mesh.centroids(f, v, ["mesh"]).select("mesh", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("fan_triangulate", """
WITH r AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ring FROM lineitem GROUP BY l_orderkey),
i AS (SELECT l_orderkey, ring, unnest(range(2, len(ring))) AS i FROM r)
SELECT l_orderkey, i - 1 AS k, ring[1] AS a, ring[i] AS b, ring[i + 1] AS c FROM i""")
def fan_triangulate(t):
    ring = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))), lambda p: p["l_partkey"])
    rings = t("lineitem").groupBy("l_orderkey").agg(ring.alias("ring"))
    fans = rings.select("l_orderkey", F.posexplode(mesh.fan(F.col("ring"))).alias("k", "f"))
    return fans.select("l_orderkey", (F.col("k") + 1).cast("long").alias("k"), "f.*")


@query("lattice_points", """
SELECT CAST(i.range AS INTEGER) AS i, CAST(j.range AS INTEGER) AS j, round(10.0::DOUBLE + j.range / 40.0::DOUBLE * 400.0::DOUBLE, 6) AS x, round(500.0::DOUBLE - i.range / 20.0::DOUBLE * 200.0::DOUBLE, 6) AS y,
       round(j.range / 40.0::DOUBLE, 9) AS u, round(i.range / 20.0::DOUBLE, 9) AS v FROM range(21) i, range(41) j""")
def lattice_points(t):
    points = mesh.lattice(t("region").sparkSession, (10.0, 300.0, 410.0, 500.0), 10.0)
    return points.select("i", "j", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round("u", 9).alias("u"), F.round("v", 9).alias("v"))


@query("lattice_triangles", """
WITH p AS (SELECT i.range * 40 + j.range AS id, i.range * 41 + j.range AS p FROM range(20) i, range(40) j)
SELECT id AS fid, p AS a, p + 41 AS b, p + 1 AS c FROM p UNION ALL SELECT id + 800, p + 1, p + 41, p + 42 FROM p""")
def lattice_triangles(t):
    return mesh.lattice_faces(t("region").sparkSession, 21, 41)


@query("gate_corners", """
WITH b(bar, cx, cy, sx, sy) AS (VALUES ('left', -2.625::DOUBLE, 0.0::DOUBLE, 0.25::DOUBLE, 5.5::DOUBLE), ('right', 2.625, 0.0, 0.25, 5.5), ('top', 0.0, 2.625, 5.5, 0.25), ('bottom', 0.0, -2.625, 5.5, 0.25)),
k AS (
  SELECT n_nationkey AS ord, n_regionkey AS x, n_nationkey AS z, bar, CAST(corner.range AS INTEGER) AS corner, radians(n_nationkey * 15.0::DOUBLE) AS a,
         cx + (CASE WHEN corner.range & 1 > 0 THEN 0.5 ELSE -0.5 END) * sx AS side, cy + (CASE WHEN corner.range & 2 > 0 THEN 0.5 ELSE -0.5 END) * sy AS up, (CASE WHEN corner.range & 4 > 0 THEN 0.5 ELSE -0.5 END) * 0.25 AS deep
  FROM nation, b, range(8) corner)
SELECT ord, bar, corner, round(x + side * cos(a) + deep * sin(a), 6) AS x, round(6.0::DOUBLE + up, 6) AS y, round(z - side * sin(a) + deep * cos(a), 6) AS z FROM k""")
def gate_corners(t):
    gates = t("nation").select(F.col("n_nationkey").alias("ord"), F.col("n_regionkey").cast("double").alias("x"), F.lit(6.0).alias("y"), F.col("n_nationkey").cast("double").alias("z"), F.lit(5.0).alias("size"), F.lit(0.25).alias("bar"), (F.col("n_nationkey") * 15.0).alias("yaw_deg"))
    return mesh.gate_bars(gates).select("ord", "bar", "corner", *[F.round(c, 6).alias(c) for c in "xyz"])


@query("wall_planes", f"""
WITH {_VERTICES}, {_FACES}, {_CORNERS},
d AS (SELECT t.*, kx / n AS nx, ky / n AS ny, kz / n AS nz FROM (SELECT *, sqrt(kx * kx + ky * ky + kz * kz) AS n FROM k) k JOIN t USING (mesh, fid) WHERE n > 0),
h AS (SELECT *, nx / sqrt(nx * nx + ny * ny) AS hx, ny / sqrt(nx * nx + ny * ny) AS hy FROM d WHERE abs(nz) < 0.35::DOUBLE AND sqrt(nx * nx + ny * ny) > 1e-9::DOUBLE),
g AS (SELECT *, round_even(atan2(hy, hx) / 0.09::DOUBLE, 0) AS dir, round_even((hx * ax + hy * ay) / 0.6::DOUBLE, 0) AS place FROM h),
m AS (SELECT mesh, dir, place, avg(hx) AS ex, avg(hy) AS ey, min(fid) AS first_fid FROM g GROUP BY ALL),
e AS (SELECT mesh, dir, place, first_fid, ex / sqrt(ex * ex + ey * ey) AS mx, ey / sqrt(ex * ex + ey * ey) AS my FROM m WHERE sqrt(ex * ex + ey * ey) >= 1e-9::DOUBLE),
s AS (
  SELECT mesh, first_fid, count(*) AS n_faces,
         max(greatest(ay * mx - ax * my, (ay + uy) * mx - (ax + ux) * my, (ay + wy) * mx - (ax + wx) * my)) - min(least(ay * mx - ax * my, (ay + uy) * mx - (ax + ux) * my, (ay + wy) * mx - (ax + wx) * my)) AS width,
         max(greatest(az, az + uz, az + wz)) - min(least(az, az + uz, az + wz)) AS height
  FROM g JOIN e USING (mesh, dir, place) GROUP BY mesh, dir, place, first_fid)
SELECT mesh, first_fid, n_faces, round(width, 6) AS width, round(height, 6) AS height FROM s WHERE width * height >= 6.0 AND width >= 1.0 AND height >= 1.0""")
def wall_planes(t):
    v, f = _mesh(t)
    return facade.wall_panels(mesh.corners(f, v, ["mesh"]), "mesh").select("mesh", "first_fid", "n_faces", F.round("width", 6).alias("width"), F.round("height", 6).alias("height"))


@query("plane_bucket", """
SELECT p_partkey, CAST(round_even(atan2(CAST(p_size - 25 AS DOUBLE), p_retailprice - 1400.0::DOUBLE) / 0.09::DOUBLE, 0) AS BIGINT) AS direction, CAST(round_even(p_retailprice / 0.6::DOUBLE, 0) AS BIGINT) AS place FROM part""")
def plane_bucket(t):
    key = G.plane_key(F.col("p_retailprice") - 1400.0, (F.col("p_size") - 25).cast("double"), F.col("p_retailprice"))
    return t("part").select("p_partkey", key["direction"].alias("direction"), key["place"].alias("place"))


def _conic_sql() -> str:
    return f"""
    WITH g AS (SELECT c_custkey, 57.5::DOUBLE + CAST(c_custkey % 400 AS DOUBLE) / 200.0::DOUBLE AS lat, 22.0::DOUBLE + CAST(c_custkey % 577 AS DOUBLE) / 100.0::DOUBLE AS lon FROM customer),
    s AS (SELECT *, sin(radians(lat)) * {P._E!r}::DOUBLE AS s FROM g),
    r AS (SELECT *, pow(tan(pi() / 4 - radians(lat) / 2) / pow((1 - s) / (1 + s), {P._E / 2!r}::DOUBLE), {P._N!r}::DOUBLE) * {P._K!r}::DOUBLE AS r, (radians(lon) - radians(24.0::DOUBLE)) * {P._N!r}::DOUBLE AS theta FROM s)
    SELECT c_custkey, round(500000.0::DOUBLE + r * sin(theta), 3) AS east, round(6375000.0::DOUBLE + {P._R0!r}::DOUBLE - r * cos(theta), 3) AS north FROM r"""


def _degrees(t):
    return t("customer").select("c_custkey", (57.5 + (F.col("c_custkey") % 400) / 200.0).alias("lat"), (22.0 + (F.col("c_custkey") % 577) / 100.0).alias("lon"))


@query("project_lcc", _conic_sql())
def project_lcc(t):
    east, north = P.conic_forward(F.col("lat"), F.col("lon"))
    return _degrees(t).select("c_custkey", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


@query("project_roundtrips", "SELECT c_custkey, true AS conic, true AS transverse, true AS geocentric FROM customer")
def project_roundtrips(t):
    lat, lon = F.col("lat"), F.col("lon")
    near = lambda a, b: (F.abs(a[0] - lat) < b) & (F.abs(a[1] - lon) < b)
    conic = P.conic_inverse(*P.conic_forward(lat, lon))
    utm = P.transverse_inverse(*P.transverse_forward(lat, lon))
    ecef = P.geocentric_to_geodetic(*P.geodetic_to_geocentric(lat, lon, F.lit(120.0)))
    return _degrees(t).select("c_custkey", near(conic, 1e-8).alias("conic"), near(utm, 1e-8).alias("transverse"), (near(ecef, 1e-8) & (F.abs(ecef[2] - 120.0) < 1e-3)).alias("geocentric"))


@query("sheet_ids", """
WITH p AS (SELECT c_custkey, 400000.0::DOUBLE + CAST(c_custkey * 37 % 300000 AS DOUBLE) AS e, 6400000.0::DOUBLE + CAST(c_custkey * 53 % 200000 AS DOUBLE) AS n FROM customer)
SELECT c_custkey, printf('%03d%03d', CAST(floor(n / 1000) AS INTEGER) - 6000, CAST(floor(e / 1000) AS INTEGER)) AS small,
  printf('%d%d%d%d%d', CAST(floor(n / 100000) AS INTEGER) - 59, CAST(floor(e / 100000) AS INTEGER) - 2, CAST(floor(n / 10000) AS INTEGER) % 10, CAST(floor(e / 10000) AS INTEGER) % 10,
    1 + (CASE WHEN e % 10000 >= 5000 THEN 1 ELSE 0 END) + (CASE WHEN n % 10000 >= 5000 THEN 2 ELSE 0 END)) AS large FROM p""")
def sheet_ids(t):
    east, north = 400000.0 + (F.col("c_custkey") * 37 % 300000), 6400000.0 + (F.col("c_custkey") * 53 % 200000)
    return t("customer").select("c_custkey", texts.sheet_1km(east, north).alias("small"), texts.sheet_5km(east, north).alias("large"))


@query("game_axes", "SELECT s_suppkey, round(s_acctbal - 500.25::DOUBLE, 6) AS x, CAST(s_nationkey AS DOUBLE) - 3.0::DOUBLE AS y, -(CAST(s_suppkey AS DOUBLE) - 40.0::DOUBLE) AS z FROM supplier")
def game_axes(t):
    g = G.to_game(F.col("s_acctbal"), F.col("s_suppkey").cast("double"), F.col("s_nationkey").cast("double"), 500.25, 40.0, 3.0)
    return t("supplier").select("s_suppkey", F.round(g["x"], 6).alias("x"), g["y"].alias("y"), g["z"].alias("z"))


@query("scalar_curves", """
SELECT p_partkey, round(CASE WHEN p_size / 255.0::DOUBLE <= 0.04045 THEN p_size / 255.0::DOUBLE / 12.92::DOUBLE ELSE pow((p_size / 255.0::DOUBLE + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END, 9) AS linear,
  round(least(1.0::DOUBLE, p_size / 40.0::DOUBLE) * least(1.0::DOUBLE, p_size / 40.0::DOUBLE) * (3.0::DOUBLE - 2.0::DOUBLE * least(1.0::DOUBLE, p_size / 40.0::DOUBLE)), 9) AS eased,
  CASE WHEN (p_size * 37.0::DOUBLE) % 360 > 180 THEN 360 - (p_size * 37.0::DOUBLE) % 360 ELSE (p_size * 37.0::DOUBLE) % 360 END AS tilt FROM part""")
def scalar_curves(t):
    s = F.col("p_size").cast("double")
    return t("part").select("p_partkey", F.round(G.srgb_to_linear(s), 9).alias("linear"), F.round(G.smoothstep(s / 40.0), 9).alias("eased"), G.fold_tilt(s * 37.0).alias("tilt"))


@query("vector_dot", "SELECT vec_id, round(list_dot_product(embedding[1:32]::DOUBLE[], embedding[33:64]::DOUBLE[]), 5) AS dot FROM embeddings")
def vector_dot(t):
    pairs = F.zip_with(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32), lambda a, b: a.cast("double") * b.cast("double"))
    return t("embeddings").select("vec_id", F.round(F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v), 5).alias("dot"))


@query("matrix_points", """
SELECT s_suppkey, round(2.0::DOUBLE * s_acctbal + 10.0::DOUBLE, 6) AS x, CAST(s_nationkey AS DOUBLE) + 20.0::DOUBLE AS y, 3.0::DOUBLE * s_suppkey + 30.0::DOUBLE AS z FROM supplier""")
def matrix_points(t):
    m = F.array(*[F.lit(float(v)) for v in (2, 0, 0, 0, 0, 1, 0, 0, 0, 0, 3, 0, 10, 20, 30, 1)])
    p = G.apply_matrix(m, F.col("s_acctbal"), F.col("s_nationkey").cast("double"), F.col("s_suppkey").cast("double"))
    return t("supplier").select("s_suppkey", F.round(p["x"], 6).alias("x"), p["y"].alias("y"), p["z"].alias("z"))


@query("pinhole_pixels", """
SELECT c_custkey, round(13000.0::DOUBLE * c_acctbal / (5000.0::DOUBLE + c_custkey), 4) AS u, round(13000.0::DOUBLE * (50.0::DOUBLE - c_nationkey) / (5000.0::DOUBLE + c_custkey), 4) AS v, 5000.0::DOUBLE + c_custkey AS depth FROM customer""")
def pinhole_pixels(t):
    turn = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in ((1, 0, 0), (0, 0, -1), (0, 1, 0))])
    point = G.vec(F.col("c_acctbal"), 5000.0 + F.col("c_custkey").cast("double"), F.col("c_nationkey").cast("double"))
    p = G.project(point, G.vec(0.0, 0.0, 50.0), turn, F.lit(13000.0))
    return t("customer").select("c_custkey", F.round(p["u"], 4).alias("u"), F.round(p["v"], 4).alias("v"), p["depth"].alias("depth"))

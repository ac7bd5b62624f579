"""A whole map of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from isarithm.operators import build, scene
from isarithm.plans.geometry import _FACES, _VERTICES, _mesh
from isarithm.plans.registry import query

_BOX = (0.0, 0.0, 200.0, 100.0)


@query("whole_build", f"""
WITH {_VERTICES}, {_FACES},
e AS (SELECT CAST(range AS INTEGER) AS k, CAST(round_even(range * 10.0 / 2, 0) AS INTEGER) AS lo, CAST(round_even((range + 1) * 10.0 / 2, 0) AS INTEGER) AS hi FROM range(2)),
d AS (SELECT CAST(range AS INTEGER) AS k, CAST(round_even(range * 20.0 / 4, 0) AS INTEGER) AS lo, CAST(round_even((range + 1) * 20.0 / 4, 0) AS INTEGER) AS hi FROM range(4)),
g AS (SELECT printf('terrain_r%02dc%02d', e.k, d.k) AS mesh, (e.hi - e.lo + 1) * (d.hi - d.lo + 1) AS vertices, 2 * (e.hi - e.lo) * (d.hi - d.lo) AS triangles FROM e, d),
u AS (SELECT DISTINCT mesh, unnest([a, b, c]) AS vid FROM f),
m AS (SELECT u.mesh, avg(v.x) AS x, avg(v.y) AS y FROM u JOIN v ON v.mesh = u.mesh AND v.vid = u.vid GROUP BY ALL),
i AS (SELECT mesh, greatest(0, least(1, CAST(floor((100 - y) / 100.0::DOUBLE * 2) AS INTEGER))) AS r, greatest(0, least(3, CAST(floor(x / 200.0::DOUBLE * 4) AS INTEGER))) AS c FROM m WHERE x BETWEEN 0 AND 200 AND y BETWEEN 0 AND 100),
t AS (
  SELECT f.mesh, q.x - p.x AS ux, q.y - p.y AS uy, q.z - p.z AS uz, r.x - p.x AS wx, r.y - p.y AS wy, r.z - p.z AS wz
  FROM f JOIN v p ON p.mesh = f.mesh AND p.vid = f.a JOIN v q ON q.mesh = f.mesh AND q.vid = f.b JOIN v r ON r.mesh = f.mesh AND r.vid = f.c),
k AS (SELECT mesh, uy * wz - uz * wy AS kx, uz * wx - ux * wz AS ky, ux * wy - uy * wx AS kz FROM t),
b AS (SELECT printf('buildings_r%02dc%02d_%s', i.r, i.c, CASE WHEN kz > 0.5 * sqrt(kx * kx + ky * ky + kz * kz) THEN 'roofs' ELSE 'walls' END) AS mesh, count(*) * 3 AS vertices, count(*) AS triangles FROM k JOIN i ON i.mesh = k.mesh GROUP BY ALL),
c AS (SELECT printf('course_gate%02d_%s', CAST(r_regionkey + 1 AS INTEGER), bar) AS mesh, 8 AS vertices, 12 AS triangles FROM region, (VALUES ('left'), ('right'), ('top'), ('bottom')) AS s(bar))
SELECT * FROM g UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def whole_build(t):
    spark = t("region").sparkSession
    cells = t("lineitem").select(F.col("l_linenumber").alias("sheet"), (F.col("l_partkey") % 200 + 0.5).alias("x"), (F.col("l_quantity") * 2 - 0.5).alias("y"), (F.col("l_suppkey") % 7).cast("double").alias("h"))
    v, f = _mesh(t)
    gates = t("region").select((F.col("r_regionkey") + 1).alias("ord"), (F.col("r_regionkey") * 40.0 + 10.0).alias("east"), F.lit(50.0).alias("north"), F.lit(6.0).alias("height_m"), F.lit(5.0).alias("size_m"), F.lit(0.25).alias("bar_m"), F.lit(30.0).alias("yaw_deg"))
    field = build.heights(cells, _BOX, 5.0)
    vertices, faces, _ = build.build_map(spark, "test", _BOX, (100.0, 50.0), field, 10.0, 50.0, houses=(f, v, ["mesh"]), gates=gates)
    return scene.mesh_report(vertices, faces).select("mesh", "vertices", "triangles")

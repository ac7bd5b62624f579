"""Queries over whole map stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from isarithm.operators import maps
from isarithm.plans.registry import query


@query("elevation_mosaic", """
WITH p AS (SELECT l_linenumber AS sheet, CAST(floor((50.0::DOUBLE - (l_quantity - 0.5::DOUBLE)) / 0.5::DOUBLE) AS INTEGER) AS r, CAST(floor((l_partkey % 997 + 0.5::DOUBLE) / 0.5::DOUBLE) AS INTEGER) AS c, round_even(l_extendedprice * 100, 0) AS h FROM lineitem),
m AS (SELECT r, c, sheet, avg(h) AS h FROM p GROUP BY ALL), f AS (SELECT r, c, arg_min(h, sheet) AS h FROM m GROUP BY r, c),
g AS (SELECT CAST(a.range AS INTEGER) AS r, CAST(b.range AS INTEGER) AS c FROM range(100) a, range(1994) b), k AS (SELECT f.* FROM f JOIN g USING (r, c))
SELECT g.r AS "row", g.c AS col, round(coalesce(k.h, (SELECT median(h) FROM k)), 4) AS h FROM g LEFT JOIN k ON k.r = g.r AND k.c = g.c""")
def elevation_mosaic(t):
    cells = t("lineitem").select(F.col("l_linenumber").alias("sheet"), (F.col("l_partkey") % 997 + 0.5).alias("x"), (F.col("l_quantity") - 0.5).alias("y"), F.rint(F.col("l_extendedprice") * 100).alias("h"))
    return maps.elevation(cells, (0.0, 0.0, 997.0, 50.0), 0.5, 0.0).withColumn("h", F.round("h", 4))


@query("warp_last_wins", """
WITH p AS (SELECT l_linenumber AS sheet, CAST(floor((100.0::DOUBLE - l_quantity * 2.0::DOUBLE) / 5.0::DOUBLE) AS INTEGER) AS r, CAST(floor((l_partkey % 61) * 2.0::DOUBLE / 6.0::DOUBLE) AS INTEGER) AS c, round_even(l_extendedprice * 100, 0) AS h FROM lineitem),
m AS (SELECT r, c, sheet, avg(h) AS h FROM p WHERE r BETWEEN 0 AND 19 AND c BETWEEN 0 AND 19 GROUP BY ALL)
SELECT r AS "row", c AS col, round(arg_max(h, sheet), 4) AS h FROM m GROUP BY r, c""")
def warp_last_wins(t):
    cells = t("lineitem").select(F.col("l_linenumber").alias("sheet"), "l_partkey", "l_quantity", F.rint(F.col("l_extendedprice") * 100).alias("h"))
    place = ((F.col("l_partkey") % 61) * 2.0, F.col("l_quantity") * 2.0)
    return maps.warp(cells, place, (0.0, 0.0, 120.0, 100.0), 20, 20, ["h"]).withColumn("h", F.round("h", 4))


@query("terrain_chunk_points", """
WITH e AS (SELECT CAST(range AS INTEGER) AS k, CAST(round_even(range * 20.0 / 2, 0) AS INTEGER) AS lo, CAST(round_even((range + 1) * 20.0 / 2, 0) AS INTEGER) AS hi FROM range(2)),
d AS (SELECT CAST(range AS INTEGER) AS k, CAST(round_even(range * 40.0 / 4, 0) AS INTEGER) AS lo, CAST(round_even((range + 1) * 40.0 / 4, 0) AS INTEGER) AS hi FROM range(4))
SELECT printf('terrain_r%02dc%02d', e.k, d.k) AS chunk, CAST(i.range AS INTEGER) AS i, CAST(j.range AS INTEGER) AS j FROM range(21) i JOIN e ON i.range BETWEEN e.lo AND e.hi, range(41) j JOIN d ON j.range BETWEEN d.lo AND d.hi""")
def terrain_chunk_points(t):
    return maps.terrain_chunks(t("region").sparkSession, (10.0, 300.0, 410.0, 500.0), 10.0, 100.0)[0].select("chunk", "i", "j")


@query("pyramid_tiles", """
WITH p AS (SELECT p_partkey, p_size * 100 AS w, CAST(floor(p_retailprice) AS INTEGER) AS h FROM part),
l AS (SELECT *, CAST(ceil(log2(greatest(w, h))) AS INTEGER) AS full_ FROM p),
s AS (SELECT p_partkey, least(9, full_) AS level, greatest(1, CAST(ceil(w / pow(2, full_ - least(9, full_))) AS INTEGER)) AS sw, greatest(1, CAST(ceil(h / pow(2, full_ - least(9, full_))) AS INTEGER)) AS sh FROM l)
SELECT p_partkey, level, CAST(i.range AS INTEGER) AS i, CAST(j.range AS INTEGER) AS j FROM s, range(4) i, range(4) j WHERE i.range < ceil(sw / 256.0) AND j.range < ceil(sh / 256.0)""")
def pyramid_tiles(t):
    photos = t("part").select("p_partkey", (F.col("p_size") * 100).alias("width"), F.floor("p_retailprice").cast("int").alias("height"))
    return maps.pyramid_tiles(photos, "p_partkey", 9)


@query("next_picture_number", "SELECT coalesce(max(c_custkey % 300), 0) + 1 AS number FROM customer")
def next_picture_number(t):
    return maps.next_number(t("customer").select(F.concat(F.lit("map-ingame-"), F.col("c_custkey") % 300, F.lit(".jpg")).alias("path")), "path")


@query("sample_prefix", """
WITH k AS (SELECT l_linenumber AS f, l_orderkey AS p, floor(l_orderkey / 500) AS c FROM lineitem WHERE l_returnflag = 'A'),
n AS (SELECT f, c, count(*) AS n FROM k GROUP BY ALL), b AS (SELECT f, c, coalesce(sum(n) OVER (ORDER BY f, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT k.f, k.c::BIGINT AS c, count(*) AS n FROM k JOIN b ON b.f = k.f AND b.c = k.c AND before < 3000 GROUP BY ALL""")
def sample_prefix(t):
    points = t("lineitem").select(F.col("l_linenumber").alias("f"), F.col("l_orderkey").alias("p"), "l_returnflag")
    taken = maps.height_prefix(points, "f", "p", 500, 3000, F.col("l_returnflag") == "A")
    return taken.groupBy("f", F.floor(F.col("p") / 500).alias("c")).agg(F.count("*").alias("n"))


@query("baked_panels", """
WITH l AS (SELECT l_partkey % 200 AS panel, CAST(l_quantity - 1 AS INTEGER) AS texel, l_linenumber AS source, CASE WHEN l_partkey % 200 >= 20 THEN l_extendedprice END AS v FROM lineitem),
x AS (SELECT panel, texel, source, max(v) AS v FROM l GROUP BY ALL), s AS (SELECT DISTINCT panel, source, 1.0::DOUBLE / source AS score FROM l),
w AS (SELECT panel, source, w FROM (SELECT *, pow(score / max(score) OVER (PARTITION BY panel), 4) AS w FROM s) WHERE w >= 0.02::DOUBLE),
colour AS (SELECT panel, texel, sum(w * v) / sum(w) AS v FROM x JOIN w USING (panel, source) WHERE v IS NOT NULL GROUP BY ALL),
every_ AS (SELECT DISTINCT panel, texel FROM x), total AS (SELECT panel, count(*) AS n FROM every_ GROUP BY panel), m AS (SELECT panel, avg(v) AS mean, count(*) AS filled FROM colour GROUP BY panel),
c AS (SELECT total.panel, total.panel % 25 AS building, mean, coalesce(filled / total.n, 0.0::DOUBLE) AS coverage FROM total LEFT JOIN m USING (panel)),
own AS (SELECT building, arg_min(panel, {'s': -9.0::DOUBLE * coverage, 'p': panel}) AS donor FROM c WHERE coverage > 0 GROUP BY building),
near AS (SELECT e.panel, arg_min(o.panel, {'d': abs(e.panel - o.panel), 'p': o.panel}) AS near FROM c e, c o WHERE e.coverage = 0 AND o.coverage > 0 GROUP BY e.panel),
lent AS (SELECT c.panel, d.mean AS borrowed FROM c LEFT JOIN own USING (building) LEFT JOIN near ON near.panel = c.panel JOIN c d ON d.panel = coalesce(own.donor, near.near) WHERE c.coverage = 0)
SELECT e.panel, e.texel, round(coalesce(colour.v, c.mean, lent.borrowed, (SELECT avg(v) FROM colour)), 6) AS value, round(c.coverage, 6) AS coverage
FROM every_ e JOIN c ON c.panel = e.panel LEFT JOIN colour ON colour.panel = e.panel AND colour.texel = e.texel LEFT JOIN lent ON lent.panel = e.panel""")
def baked_panels(t):
    lines = t("lineitem").select((F.col("l_partkey") % 200).alias("panel"), (F.col("l_quantity") - 1).cast("int").alias("texel"), F.col("l_linenumber").alias("source"), F.when(F.col("l_partkey") % 200 >= 20, F.col("l_extendedprice")).alias("value"))
    texels = lines.groupBy("panel", "texel", "source").agg(F.max("value").alias("value"))
    scores = lines.select("panel", "source").distinct().withColumn("score", 1.0 / F.col("source"))
    panels = lines.select("panel").distinct().select("panel", (F.col("panel") % 25).alias("building"), F.lit(9.0).alias("area"), F.struct((F.col("panel") * 10.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z")).alias("origin"))
    return maps.bake(texels, scores, panels).select("panel", "texel", F.round("value", 6).alias("value"), F.round("coverage", 6).alias("coverage"))

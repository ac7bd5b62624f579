"""Ordered selection, windows over sequences, greedy picks."""

from __future__ import annotations

from pyspark.sql import functions as F

from isarithm.operators import facade, grid, select, sequence
from isarithm.plans.rasters import SURFACE, cloud
from isarithm.plans.registry import query


@query("round_robin_topk", """
WITH r AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS turn FROM events),
p AS (SELECT *, row_number() OVER (ORDER BY turn, value DESC, event_id) AS place FROM r)
SELECT event_id, event_type, value, CAST(turn AS INTEGER) AS turn, CAST(place AS INTEGER) AS place FROM p WHERE place <= 22""")
def round_robin_topk(t):
    rows = t("events").select("event_id", "event_type", "value")
    return select.round_robin(rows, "event_type", [F.desc("value"), F.col("event_id")], 22)


def _picks_sql(k: int, radius: int) -> str:
    parts = []
    for i in range(1, k + 1):
        away = " AND ".join(f"NOT (r BETWEEN (SELECT r FROM k{j}) - {radius} AND (SELECT r FROM k{j}) + {radius} AND c BETWEEN (SELECT c FROM k{j}) - {radius} AND (SELECT c FROM k{j}) + {radius})" for j in range(1, i)) or "true"
        parts.append(f"k{i} AS (SELECT * FROM s WHERE {away} ORDER BY h DESC, r, c LIMIT 1)")
    picks = " UNION ALL ".join(f"SELECT {i} AS place, r AS \"row\", c AS col, h FROM k{i}" for i in range(1, k + 1))
    return f"WITH {SURFACE}, {', '.join(parts)} {picks}"


@query("greedy_spaced_topk", _picks_sql(4, 6))
def greedy_spaced_topk(t):
    return select.spaced_maxima(grid.cell_max(cloud(t), "z", noise=["R"]), 4, 6)


@query("shelf_pack", """
WITH RECURSIVE p AS (
  SELECT p_partkey, least(512, greatest(2, CAST(ceil(p_size / 0.5::DOUBLE) AS INTEGER) + 2)) AS w, least(512, greatest(2, CAST(ceil((p_retailprice / 50.0::DOUBLE) / 0.5::DOUBLE) AS INTEGER) + 2)) AS h,
         row_number() OVER (ORDER BY p_retailprice / 50.0::DOUBLE DESC, p_partkey) AS n FROM part),
f AS (
  SELECT n, p_partkey, w, h, 0 AS x, CAST(0 AS BIGINT) AS y, h AS shelf FROM p WHERE n = 1
  UNION ALL
  SELECT p.n, p.p_partkey, p.w, p.h, CASE WHEN f.x + f.w + p.w > 512 THEN 0 ELSE f.x + f.w END, CASE WHEN f.x + f.w + p.w > 512 THEN f.y + f.shelf ELSE f.y END,
         CASE WHEN f.x + f.w + p.w > 512 THEN p.h ELSE greatest(f.shelf, p.h) END
  FROM f JOIN p ON p.n = f.n + 1)
SELECT p_partkey, x, y, w, h FROM f""")
def shelf_pack(t):
    return select.shelf_pack(t("part"), "p_partkey", F.col("p_size").cast("double"), F.col("p_retailprice") / 50.0, 0.5, 512, "p_partkey")


@query("first_wins_dedupe", "SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def first_wins_dedupe(t):
    return select.first_wins(t("documents").select(F.md5("text").alias("digest"), "doc_id"), ["digest"], ["doc_id"])


@query("keyed_union_overwrite", """
WITH u AS (SELECT user_id, event_type, event_id, value FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT user_id, event_type, event_id, -value FROM events WHERE event_type NOT IN ('click', 'view'))
SELECT user_id, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM u GROUP BY user_id""")
def keyed_union_overwrite(t):
    e = t("events").select("user_id", "event_type", "event_id", "value")
    early = F.col("event_type").isin("click", "view")
    both = e.where(early).unionByName(e.where(~early).withColumn("value", -F.col("value")))
    return select.last_wins(both.drop("event_type"), ["user_id"], ["event_id"])


@query("block_islands", """
WITH b AS (SELECT user_id, event_id, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS block FROM events)
SELECT user_id, block::BIGINT AS block, count(*) AS n, min(event_id) AS first_event FROM b WHERE block > 0 GROUP BY ALL""")
def block_islands(t):
    b = sequence.blocks(t("events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase")
    return b.where("block > 0").groupBy("user_id", "block").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("prefix_offsets", """
SELECT conv_id, turn, length(text) AS size, (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) - length(text))::BIGINT AS start FROM conversations""")
def prefix_offsets(t):
    rows = t("conversations").withColumn("size", F.length("text").cast("long"))
    return sequence.offsets(rows, ["conv_id"], ["turn", "role", "text"], "size").select("conv_id", "turn", "size", "start")


@query("lap_length", """
WITH p AS (SELECT o_custkey, o_orderkey, CAST(o_orderkey % 1000 AS DOUBLE) AS x, CAST(CAST(o_totalprice AS BIGINT) % 1000 AS DOUBLE) AS y FROM orders),
s AS (SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM p WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, count(*) AS n, round(sum(sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y))), 4) AS length FROM s GROUP BY o_custkey""".replace("CAST(CAST(o_totalprice AS BIGINT) % 1000 AS DOUBLE)", "CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DOUBLE)"))
def lap_length(t):
    p = t("orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 1000).cast("double").alias("x"), (F.floor("o_totalprice") % 1000).cast("double").alias("y"))
    return sequence.ring_length(p, ["o_custkey"], ["o_orderkey"], "x", "y").withColumn("length", F.round("length", 4))


@query("frame_sequence", """
WITH s AS (SELECT o_orderkey, greatest(1, CAST(round_even((1.0::DOUBLE + CAST(o_orderkey % 7 AS DOUBLE) / 2) * 3, 0) AS INTEGER)) AS frames FROM orders),
f AS (SELECT o_orderkey, frames, CAST(unnest(range(frames)) AS INTEGER) AS frame FROM s),
t AS (SELECT *, CAST(frame AS DOUBLE) / greatest(1, frames - 1) AS u FROM f)
SELECT o_orderkey, frames, frame, round(u * u * (3.0::DOUBLE - 2.0::DOUBLE * u), 9) AS t FROM t""")
def frame_sequence(t):
    shots = t("orders").select("o_orderkey", (1.0 + (F.col("o_orderkey") % 7) / 2.0).alias("seconds"))
    return sequence.frames(shots, ["o_orderkey"], "seconds", 3).withColumn("t", F.round("t", 9))


@query("still_indices", """
WITH s AS (SELECT o_custkey, o_orderkey, CAST(greatest(1, round_even((1.0::DOUBLE + CAST(o_orderkey % 7 AS DOUBLE) / 2) * 30, 0)) AS BIGINT) AS n, CAST(o_orderkey % 11 AS DOUBLE) / 10.0::DOUBLE AS share FROM orders)
SELECT o_orderkey, (sum(n) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) - n + least(n - 1, CAST(round_even((n - 1) * share, 0) AS BIGINT)))::BIGINT AS still FROM s""")
def still_indices(t):
    shots = t("orders").select("o_custkey", "o_orderkey", (1.0 + (F.col("o_orderkey") % 7) / 2.0).alias("seconds"), ((F.col("o_orderkey") % 11) / 10.0).alias("at"))
    counted = shots.withColumn("n", F.greatest(F.lit(1), F.rint(F.col("seconds") * 30).cast("long")))
    placed = sequence.offsets(counted, ["o_custkey"], ["o_orderkey"], "n", "before")
    return placed.select("o_orderkey", sequence.still_index(F.col("seconds"), F.col("at"), F.col("before"), 30).alias("still"))


@query("orbit_poses", """
WITH f AS (SELECT n_nationkey AS n, n_regionkey AS r, n_nationkey % 3 AS kind, CAST(range AS INTEGER) AS frame, range / 59.0::DOUBLE AS s FROM nation, range(60)),
t AS (SELECT *, s * s * (3.0::DOUBLE - 2.0::DOUBLE * s) AS t FROM f),
p AS (SELECT *, radians(360.0::DOUBLE * t) AS a, CASE WHEN kind = 1 THEN 50.0::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * t) ELSE 50.0::DOUBLE END AS radius FROM t)
SELECT n AS n_nationkey, frame, round(CASE WHEN kind = 2 THEN r + (n - r) * t ELSE n + radius * cos(a) END, 6) AS x, round(CASE WHEN kind = 2 THEN n + (n - n) * t ELSE r + radius * sin(a) END, 6) AS z,
       round(CASE WHEN kind = 1 THEN 20.0::DOUBLE * (0.15::DOUBLE + 0.85::DOUBLE * t) ELSE 20.0::DOUBLE END, 6) AS above
FROM p""")
def orbit_poses(t):
    place = lambda x, z: F.struct(F.col(x).cast("double").alias("x"), F.col(z).cast("double").alias("z"))
    shots = t("nation").select(
        "n_nationkey", F.element_at(F.array(F.lit("orbit"), F.lit("reveal"), F.lit("fly")), (F.col("n_nationkey") % 3 + 1).cast("int")).alias("kind"), place("n_nationkey", "n_regionkey").alias("target"),
        place("n_regionkey", "n_nationkey").alias("start"), place("n_nationkey", "n_nationkey").alias("end"), F.lit(50.0).alias("radius_m"), F.lit(20.0).alias("height_m"), F.lit(1.0).alias("turns"), F.lit(0.0).alias("start_deg"), F.lit(2.0).alias("seconds"),
    )
    rest = [c for c in shots.columns if c != "seconds"]
    return sequence.poses(sequence.frames(shots, rest, "seconds", 30)).select("n_nationkey", "frame", F.round("x", 6).alias("x"), F.round("z", 6).alias("z"), F.round("above", 6).alias("above"))


@query("corr_gate", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(CASE WHEN count(*) < 400 THEN 0.0 ELSE coalesce(corr(l_extendedprice, l_quantity), 0.0) END, 6) AS corr FROM lineitem GROUP BY ALL""")
def corr_gate(t):
    return facade.gated_correlation(t("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "l_quantity").withColumn("corr", F.round("corr", 6))


@query("pose_best_of_k", """
WITH k AS (SELECT vec_id, label, i.range AS pose, list_cosine_similarity(embedding[1:32], list_concat(embedding[33 + i.range * 4:64], embedding[33:32 + i.range * 4])) AS s FROM embeddings, range(8) i)
SELECT vec_id, CAST(arg_min(pose, {'s': -round(s, 5), 'p': pose}) AS INTEGER) AS pose FROM k GROUP BY vec_id""")
def pose_best_of_k(t):
    half, turned = F.slice("embedding", 1, 32), F.concat(F.slice("embedding", 33 + F.col("pose") * 4, 32 - F.col("pose") * 4), F.slice("embedding", F.lit(33), F.col("pose") * 4))
    poses = t("embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("pose"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    scored = poses.select("vec_id", "pose", half.alias("a"), turned.alias("b")).select("vec_id", "pose", F.round(dot(F.col("a"), F.col("b")) / F.sqrt(dot(F.col("a"), F.col("a")) * dot(F.col("b"), F.col("b"))), 5).alias("score"))
    return facade.best_of(scored, ["vec_id"], "score", ["pose"]).select("vec_id", "pose")


@query("visibility_score", """
WITH v AS (SELECT p_partkey % 40 AS panel, s_nationkey AS source, CASE WHEN (p_size + s_suppkey) % 3 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS vis FROM part JOIN supplier ON p_size = 1 + s_suppkey % 50),
g AS (SELECT panel, source, avg(vis) AS fraction FROM v GROUP BY ALL)
SELECT panel, source, round(fraction, 9) AS fraction, round(fraction * (0.4::DOUBLE + source / 100.0::DOUBLE) / greatest(CAST(panel AS DOUBLE), 1.0::DOUBLE), 9) AS score FROM g WHERE fraction > 0""")
def visibility_score(t):
    v = t("part").join(t("supplier"), F.col("p_size") == 1 + F.col("s_suppkey") % 50).select((F.col("p_partkey") % 40).alias("panel"), F.col("s_nationkey").alias("source"), ((F.col("p_size") + F.col("s_suppkey")) % 3 > 0).alias("vis"))
    scored = facade.visibility_scores(v.withColumns({"inc": 0.4 + F.col("source") / 100.0, "dist": F.col("panel").cast("double")}), "panel", "source", "vis", "inc", "dist")
    return scored.select("panel", "source", F.round("fraction", 9).alias("fraction"), F.round("score", 9).alias("score"))


@query("weighted_blend", """
WITH s AS (SELECT l_orderkey % 500 AS panel, l_suppkey AS source, 1.0::DOUBLE + CAST(l_quantity AS DOUBLE) AS score, l_tax AS v FROM lineitem),
w AS (SELECT *, pow(score / max(score) OVER (PARTITION BY panel), 4) AS weight FROM s)
SELECT panel, round(sum(weight * v) / sum(weight), 6) AS v FROM w WHERE weight >= 0.02::DOUBLE GROUP BY panel""")
def weighted_blend(t):
    s = t("lineitem").select((F.col("l_orderkey") % 500).alias("panel"), F.col("l_suppkey").alias("source"), (1.0 + F.col("l_quantity")).alias("score"), F.col("l_tax").alias("v"))
    return facade.blend(facade.blend_weights(s, "panel"), ["panel"], "v").withColumn("v", F.round("v", 6))


@query("fill_from_group", """
WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 20 THEN CAST(p_size AS DOUBLE) END AS v FROM part)
SELECT p_partkey, round(coalesce(v, avg(v) OVER (PARTITION BY p_brand)), 6) AS v FROM p""")
def fill_from_group(t):
    p = t("part").select("p_partkey", "p_brand", F.when(F.col("p_size") > 20, F.col("p_size").cast("double")).alias("v"))
    return facade.fill_from_group(p, ["p_brand"], "v").select("p_partkey", F.round("v", 6).alias("v"))


@query("building_donors", """
SELECT p_brand, arg_min(p_partkey, {'s': -p_retailprice * (p_size % 5), 'k': p_partkey}) AS donor FROM part WHERE p_size % 5 > 0 GROUP BY p_brand""")
def building_donors(t):
    return facade.donors(t("part").withColumn("cover", F.col("p_size") % 5), "p_brand", "p_partkey", "p_retailprice", "cover")


@query("area_weighted_cover", "SELECT p_brand, round(sum(CAST(p_size AS DOUBLE) * p_retailprice) / sum(p_retailprice), 6) AS cover FROM part GROUP BY p_brand")
def area_weighted_cover(t):
    return facade.area_weighted(t("part").withColumn("cover", F.col("p_size").cast("double")), ["p_brand"], "cover", "p_retailprice").withColumn("cover", F.round("cover", 6))

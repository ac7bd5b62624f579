"""Reports: counters, joined tables, texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from isarithm.functions import texts
from isarithm.operators import report
from isarithm.plans.registry import query


@query("href_list", r"""
SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(replace(html, '&amp;', '&'), 'href="([^"]+)"', 1))), ' ') AS names FROM pages""")
def href_list(t):
    return t("pages").select("page_id", F.array_join(texts.listed(F.col("html"), r'href="([^"]+)"'), " ").alias("names"))


@query("url_build", "SELECT page_id, 'https://example.org/get?lang=1&u=' || url_encode(url) || '&id=' || page_id AS address FROM pages")
def url_build(t):
    return t("pages").select("page_id", texts.query_url("https://example.org/get", [("lang", F.lit("1")), ("u", F.col("url")), ("id", F.col("page_id").cast("string"))]).alias("address"))


@query("slug", r"""
SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(lower(url), '[^\p{L}\p{N}]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'shot') AS slug FROM pages""")
def slug(t):
    return t("pages").select("page_id", texts.slug(F.col("url")).alias("slug"))


@query("picture_titles", r"""
WITH p AS (SELECT p_partkey, p_brand || '-tour-' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-' || replace(p_type, ' ', '-') || '.jpg' AS path, p_brand || '-tour-' AS pre FROM part),
w AS (SELECT p_partkey, p_partkey IS NOT NULL AS ok, replace(regexp_replace(replace(regexp_replace(path, '\.[^.]*$', ''), pre, ''), '^[^-]*-', ''), '-', ' ') AS w FROM p)
SELECT p_partkey, upper(w[1]) || w[2:] AS title FROM w""")
def picture_titles(t):
    prefix = F.concat("p_brand", F.lit("-tour-"))
    path = F.concat(prefix, F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("-"), F.replace("p_type", F.lit(" "), F.lit("-")), F.lit(".jpg"))
    return t("part").select("p_partkey", texts.title(path, prefix).alias("title"))


@query("natural_sort", r"""
WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'shots/map-ingame-x.jpg' ELSE 'shots/map-ingame-' || c_custkey % 300 || '.jpg' END AS path FROM customer),
n AS (SELECT c_custkey, coalesce(TRY_CAST(regexp_extract(path, '-([0-9]+)\.jpg$', 1) AS BIGINT), 0) AS number FROM p)
SELECT c_custkey, number, rank() OVER (ORDER BY number) AS place FROM n""")
def natural_sort(t):
    path = F.when(F.col("c_custkey") % 5 == 0, "shots/map-ingame-x.jpg").otherwise(F.concat(F.lit("shots/map-ingame-"), F.col("c_custkey") % 300, F.lit(".jpg")))
    numbered = t("customer").select("c_custkey", texts.natural_number(path).alias("number"))
    # Places from counts per number, so no task needs all rows in one order.
    counts = numbered.groupBy("number").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    before = counts.select("number", (F.sum("n").over(Window.orderBy("number")) - F.col("n") + 1).alias("place"))
    return numbered.join(before, "number").select("c_custkey", "number", "place")


@query("json_report", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), '-') AS missing FROM events")
def json_report(t):
    props = F.from_json("props", "struct<k: bigint, missing: string>")
    return t("events").select("event_id", props["k"].alias("k"), F.coalesce(props["missing"], F.lit("-")).alias("missing"))


@query("suffix_counter", "SELECT right(text, 1) AS kind, count(*) AS n FROM documents GROUP BY 1")
def suffix_counter(t):
    return report.counter(t("documents"), F.right("text", F.lit(1)))


@query("counter_map", "SELECT '{' || string_agg('\"' || kind || '\":' || n, ',' ORDER BY kind) || '}' AS counts FROM (SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1)")
def counter_map(t):
    return report.as_map(report.counter(t("events"), F.col("event_type"))).select(F.to_json("counts").alias("counts"))


@query("report_left_join", """
WITH s AS (SELECT s_nationkey AS n_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1), c AS (SELECT c_nationkey AS n_nationkey, count(*) AS n FROM customer GROUP BY 1)
SELECT n_name, coalesce(s.n, 0) AS suppliers, coalesce(c.n, 0) AS customers, CASE WHEN coalesce(s.n, 0) = 0 THEN '-' ELSE format('{:,}', s.n) END AS shown
FROM nation LEFT JOIN s USING (n_nationkey) LEFT JOIN c USING (n_nationkey)""")
def report_left_join(t):
    count = lambda df, k: df.groupBy(F.col(k).alias("n_nationkey")).agg(F.count("*").alias("n"))
    rows = report.left_report(t("nation"), "n_nationkey", suppliers=(count(t("supplier").where("s_acctbal > 5000"), "s_nationkey"), "n"), customers=(count(t("customer"), "c_nationkey"), "n"))
    return rows.select("n_name", "suppliers", "customers", report.thousands(F.col("suppliers")).alias("shown"))


@query("ordered_names", """SELECT CAST(pos AS INTEGER) AS pos, r_name, r_regionkey FROM (VALUES (0, 'EUROPE'), (1, 'NOWHERE'), (2, 'ASIA'), (3, 'AFRICA')) w(pos, r_name) JOIN region USING (r_name)""")
def ordered_names(t):
    return report.in_order(["EUROPE", "NOWHERE", "ASIA", "AFRICA"], t("region"), "r_name").select("pos", "r_name", "r_regionkey")


@query("newest_by_text_max", "SELECT o_custkey, max(strftime(o_orderdate, '%Y-%m-%d')) AS newest FROM orders GROUP BY 1")
def newest_by_text_max(t):
    return t("orders").groupBy("o_custkey").agg(F.max(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("newest"))


@query("stale_pages", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def stale_pages(t):
    return report.stale(t("part"), t("lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey")


@query("texture_memory", "SELECT p_partkey, round(CAST(p_size AS DOUBLE) * 1000000.0::DOUBLE * 16.0::DOUBLE / 3.0::DOUBLE / 1073741824.0::DOUBLE, 9) AS gb FROM part")
def texture_memory(t):
    return t("part").select("p_partkey", F.round(report.vram_gb(F.col("p_size").cast("double") * 1000000.0), 9).alias("gb"))


@query("markdown_page", """
WITH c AS (SELECT r_name, r_regionkey, count(n_nationkey) AS nations FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT '| r_name | nations |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_name || ' | ' || nations || ' |', chr(10) ORDER BY r_name) AS page FROM c""")
def markdown_page(t):
    counts = t("nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count("*").alias("nations"))
    return report.markdown(t("region").join(counts, "r_regionkey", "left").fillna({"nations": 0}), ["r_name", "nations"], [F.col("r_name")])


@query("page_order", "SELECT n_name, rank() OVER (ORDER BY n_name LIKE '%A', n_name) AS place FROM nation")
def page_order(t):
    from pyspark.sql import Window

    name = F.regexp_replace("n_name", "A$", "-test")
    keys = [k for k in report.page_order(name)]
    return t("nation").select("n_name", F.rank().over(Window.orderBy(keys[0], F.col("n_name"))).cast("long").alias("place"))


@query("valid_names", r"SELECT page_id, regexp_full_match(url, '[\p{L}\p{N}_-]+') AS ok FROM pages")
def valid_names(t):
    return t("pages").select("page_id", texts.valid_name(F.col("url")).alias("ok"))


@query("area_sheets", """
WITH k AS (SELECT printf('%03d%03d', CAST(j.range - 6000 AS INTEGER), CAST(i.range AS INTEGER)) AS s FROM range(656, 665) i, range(6468, 6478) j),
q AS (
  SELECT printf('%d%d%d%d%d', CAST(n // 100000 - 59 AS INTEGER), CAST(e // 100000 - 2 AS INTEGER), CAST(n // 10000 % 10 AS INTEGER), CAST(e // 10000 % 10 AS INTEGER),
                CAST(1 + (CASE WHEN e % 10000 >= 5000 THEN 1 ELSE 0 END) + (CASE WHEN n % 10000 >= 5000 THEN 2 ELSE 0 END) AS INTEGER)) AS s
  FROM (SELECT i.range * 5000 AS e, j.range * 5000 AS n FROM range(131, 133) i, range(1293, 1296) j))
SELECT 'base' AS map, 1296 AS chunks, (SELECT string_agg(s, ',' ORDER BY s) FROM k) AS sheets_1km, (SELECT string_agg(s, ',' ORDER BY s) FROM q) AS sheets_5km""")
def area_sheets(t):
    return report.area_report(t("region").sparkSession, "base", (656000.0, 6468500.0, 665000.0, 6477500.0)).select("map", "chunks", *[F.array_join(c, ",").alias(c) for c in ("sheets_1km", "sheets_5km")])


@query("keyword_values", """
SELECT p_partkey, CASE WHEN contains(p_type, 'STEEL') THEN 'grey' WHEN contains(p_type, 'BRASS') THEN 'yellow' WHEN contains(p_type, 'PROMO') THEN 'red' ELSE '-' END AS colour FROM part""")
def keyword_values(t):
    return t("part").select("p_partkey", texts.first_keyword(F.col("p_type"), {"STEEL": "grey", "BRASS": "yellow", "PROMO": "red"}, "-").alias("colour"))


@query("redacted_rows", "SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_nationkey % 2 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def redacted_rows(t):
    rows = t("customer").withColumn("private", F.col("c_nationkey") % 2 == 0)
    return report.redacted(rows, "private", ["c_name", "c_acctbal"]).select("c_custkey", "c_name", "c_acctbal")


@query("vram_totals", "SELECT p_brand, sum(CAST(p_size AS BIGINT) * p_size + CASE WHEN p_size > 10 THEN p_size * 64 * 64 ELSE 0 END)::BIGINT AS pixels FROM part GROUP BY 1")
def vram_totals(t):
    side, tiles = F.col("p_size").cast("long"), F.when(F.col("p_size") > 10, F.col("p_size").cast("long"))
    return t("part").groupBy("p_brand").agg(F.sum(report.texture_pixels(side, tiles, F.lit(64))).alias("pixels"))

"""Grid queries: order lines as a point cloud, quantity by part number, heights from prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isarithm.operators import grid, sequence, stencil, surface
from isarithm.operators.quantile import exact_median
from isarithm.plans.registry import query

ROWS, COLS = 50, 32
WIDE = 61
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def cloud(t, cols: int = COLS) -> DataFrame:
    return t("lineitem").select(
        (F.col("l_quantity") - 1).cast("int").alias("row"), (F.col("l_partkey") % cols).cast("int").alias("col"), F.col("l_extendedprice").alias("z"),
        F.col("l_returnflag").alias("class"), *ORDER, "l_discount", "l_linestatus", "l_tax",
    )


def _cloud_sql(cols: int = COLS) -> str:
    return f"cloud AS (SELECT CAST(l_quantity AS INTEGER) - 1 AS r, CAST(l_partkey % {cols} AS INTEGER) AS c, l_extendedprice AS z, * FROM lineitem)"


SURFACE = f"{_cloud_sql()}, s AS (SELECT r, c, max(z) AS h FROM cloud WHERE l_returnflag <> 'R' GROUP BY r, c)"
#: A sparse cloud on a wider grid: only lines with the highest discount.
SPARSE = f"{_cloud_sql(WIDE)}, s AS (SELECT r, c, max(z) AS h FROM cloud WHERE round(l_discount * 100) = 10 GROUP BY r, c)"


#: Heights in whole cents: their sums are exact in any order.
CENTS = "cents AS (SELECT r, c, round_even(h * 100, 0) AS h FROM s)"


def _cents(raster: DataFrame) -> DataFrame:
    return raster.withColumn("h", F.rint(F.col("h") * 100))


def _surface(t) -> DataFrame:
    return grid.cell_max(cloud(t), "z", noise=["R"])


def _sparse(t) -> DataFrame:
    return grid.cell_max(cloud(t, WIDE).withColumn("class", F.round(F.col("l_discount") * 100).cast("int")), "z", classes=[10])


@query("surface_cell_max", f"""
WITH {_cloud_sql()}
SELECT r AS "row", c AS col, max(z) AS h,
       arg_max(l_suppkey, {{'z': z, 'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_suppkey, 'e': l_quantity, 'f': l_shipdate}}) AS l_suppkey
FROM cloud WHERE l_returnflag <> 'R' GROUP BY r, c""")
def surface_cell_max(t):
    return grid.cell_max(cloud(t), "z", ["l_suppkey"], ORDER, noise=["R"])


@query("surface_class_filter", f"""WITH {_cloud_sql()} SELECT r AS "row", c AS col, max(z) AS h FROM cloud WHERE l_returnflag IN ('A', 'N') AND r BETWEEN 0 AND 39 AND c BETWEEN 0 AND 19 GROUP BY r, c""")
def surface_class_filter(t):
    return grid.cell_max(cloud(t).where(grid.inside(40, 20)), "z", classes=["A", "N"])


@query("surface_dense_fill", f"""
WITH {SPARSE}, m AS (SELECT median(h) AS h FROM s),
g AS (SELECT CAST(a.range AS INTEGER) AS r, CAST(b.range AS INTEGER) AS c FROM range({ROWS}) a, range({WIDE}) b)
SELECT g.r AS "row", g.c AS col, coalesce(s.h, (SELECT h FROM m)) AS h FROM g LEFT JOIN s ON s.r = g.r AND s.c = g.c""")
def surface_dense_fill(t):
    s = _sparse(t)
    return grid.dense(s, ROWS, WIDE, exact_median(s, F.col("h")))


def _win(source: str, axis: str, n: int, r: int, agg: str) -> str:
    other = "c" if axis == "r" else "r"
    return f"SELECT {other}, CAST((({axis} + d.range - {r}) % {n} + {n}) % {n} AS INTEGER) AS {axis}, {agg}(h) AS h FROM {source}, range({2 * r + 1}) d GROUP BY ALL"


@query("stencil_closing", f"""
WITH {SURFACE}, a AS ({_win('s', 'r', ROWS, 2, 'max')}), b AS ({_win('a', 'c', COLS, 2, 'max')}),
d AS ({_win('b', 'r', ROWS, 2, 'min')}), e AS ({_win('d', 'c', COLS, 2, 'min')})
SELECT r AS "row", c AS col, h FROM e""")
def stencil_closing(t):
    return stencil.close_gaps(_surface(t), ROWS, COLS, 2)


@query("stencil_mean", f"""
WITH {SURFACE}, {CENTS}, a AS ({_win('cents', 'r', ROWS, 1, 'sum')}), b AS ({_win('a', 'c', COLS, 1, 'sum')})
SELECT r AS "row", c AS col, round(h / 9, 4) AS h FROM b""")
def stencil_mean(t):
    return stencil.smooth(_cents(_surface(t)), ROWS, COLS, 1).withColumn("h", F.round("h", 4))


def _fill_sql() -> str:
    parts, n = [f"p0 AS (SELECT r, c, h AS v, 1.0::DOUBLE AS w, CAST((SELECT count(*) FROM s) = {ROWS * WIDE} AS BOOLEAN) AS full_ FROM cents s)"], 0
    for k in range(stencil.fill_passes(ROWS, WIDE)):
        q = f"""q{k} AS (SELECT CAST((r + a.range - 1 + {ROWS}) % {ROWS} AS INTEGER) AS r, CAST((c + b.range - 1 + {WIDE}) % {WIDE} AS INTEGER) AS c, sum(v) AS v, sum(w) AS w
          FROM p{k}, range(3) a, range(3) b WHERE NOT full_ GROUP BY ALL)"""
        u = f"p{k + 1} AS (SELECT r, c, v, w, (SELECT count(*) FROM q{k}) = {ROWS * WIDE} AS full_ FROM q{k} UNION ALL SELECT * FROM p{k} WHERE full_)"
        parts += [q, u]
        n = k + 1
    return f"""WITH {SPARSE}, {CENTS}, {', '.join(parts)},
    g AS (SELECT CAST(a.range AS INTEGER) AS r, CAST(b.range AS INTEGER) AS c FROM range({ROWS}) a, range({WIDE}) b)
    SELECT g.r AS "row", g.c AS col, round(coalesce(s.h, p.v / greatest(p.w, 1e-9), 0.0), 4) AS h
    FROM g LEFT JOIN cents s ON s.r = g.r AND s.c = g.c LEFT JOIN p{n} p ON p.r = g.r AND p.c = g.c"""


@query("hole_fill_iterated", _fill_sql())
def hole_fill_iterated(t):
    s = _cents(_sparse(t))
    return stencil.fill_holes(s, grid.spine(s, ROWS, WIDE), ROWS, WIDE).withColumn("h", F.round("h", 4))


@query("surface_pipeline")
def surface_pipeline(t):
    rows = cloud(t, WIDE).withColumn("class", F.round(F.col("l_discount") * 100).cast("int"))
    return surface.read_surface(rows, ROWS, WIDE, classes=[10], noise=None).withColumn("h", F.round("h", 4))


@query("raster_decimate_avg", f"""WITH {SURFACE}, {CENTS} SELECT CAST(r // 5 AS INTEGER) AS "row", CAST(c // 5 AS INTEGER) AS col, round(avg(h), 4) AS h FROM cents GROUP BY ALL""")
def raster_decimate_avg(t):
    return grid.decimate(_cents(_surface(t)), 5).withColumn("h", F.round("h", 4))


_SHEETS = f"{_cloud_sql()}, sheets AS (SELECT r, c, l_linestatus AS sheet, max(z) AS h FROM cloud GROUP BY r, c, l_linestatus)"


def _sheets(t) -> DataFrame:
    return cloud(t).groupBy("row", "col", F.col("l_linestatus").alias("sheet")).agg(F.max("z").alias("h"))


@query("mosaic_first_wins", f"""WITH {_SHEETS} SELECT r AS "row", c AS col, arg_min(h, sheet) AS h FROM sheets GROUP BY r, c""")
def mosaic_first_wins(t):
    return grid.mosaic_first(_sheets(t), ["sheet"])


@query("overlay_last_wins", f"""WITH {_SHEETS} SELECT r AS "row", c AS col, arg_max(h, sheet) AS h FROM sheets GROUP BY r, c""")
def overlay_last_wins(t):
    return grid.overlay_last(_sheets(t), ["sheet"])


@query("footprint_paint", f"""
WITH {SURFACE}, u AS (SELECT r, c, min(z) AS h FROM cloud WHERE l_returnflag = 'R' AND l_discount > 0.095::DOUBLE GROUP BY r, c)
SELECT s.r AS "row", s.c AS col, CASE WHEN u.r IS NULL THEN s.h ELSE u.h END AS h FROM s LEFT JOIN u ON u.r = s.r AND u.c = s.c""")
def footprint_paint(t):
    survey = cloud(t).where("class = 'R' AND l_discount > 0.095D").groupBy("row", "col").agg(F.min("z").alias("h"))
    return grid.paint(_surface(t), survey)


@query("raster_zip_diff", f"""
WITH {_SHEETS} SELECT a.r AS "row", a.c AS col, round(a.h - b.h, 4) AS diff FROM sheets a JOIN sheets b ON a.r = b.r AND a.c = b.c AND a.sheet = 'F' AND b.sheet = 'O'""")
def raster_zip_diff(t):
    s = _sheets(t)
    pick = lambda k: s.where(F.col("sheet") == k).select("row", "col", "h")
    return grid.zip_diff(pick("F"), pick("O")).withColumn("diff", F.round("diff", 4))


_PLACES = "p AS (SELECT s_suppkey, (s_acctbal + 1000.0::DOUBLE) / 230.0::DOUBLE AS fr, CAST(s_suppkey % 311 AS DOUBLE) / 10.0::DOUBLE AS fc FROM supplier)"


def _places(t) -> DataFrame:
    return t("supplier").select("s_suppkey", ((F.col("s_acctbal") + 1000.0) / 230.0).alias("fr"), ((F.col("s_suppkey") % 311).cast("double") / 10.0).alias("fc"))


@query("bilinear_sample", f"""
WITH {SURFACE}, {_PLACES},
q AS (SELECT s_suppkey, greatest(0.0::DOUBLE, least({ROWS - 1}.0::DOUBLE, fr)) AS fr, greatest(0.0::DOUBLE, least({COLS - 1}.0::DOUBLE, fc)) AS fc FROM p),
k AS (SELECT *, CAST(least(floor(fr), {ROWS - 2}) AS INTEGER) AS r0, CAST(least(floor(fc), {COLS - 2}) AS INTEGER) AS c0 FROM q),
e AS (SELECT s_suppkey, r0 + a.range AS r, c0 + b.range AS c,
        (CASE WHEN a.range = 1 THEN fr - r0 ELSE 1.0::DOUBLE - (fr - r0) END) * (CASE WHEN b.range = 1 THEN fc - c0 ELSE 1.0::DOUBLE - (fc - c0) END) AS w FROM k, range(2) a, range(2) b)
SELECT s_suppkey, round(sum(w * h), 4) AS h FROM e JOIN s ON s.r = e.r AND s.c = e.c GROUP BY s_suppkey""")
def bilinear_sample(t):
    return grid.bilinear(_places(t), _surface(t), ["s_suppkey"], F.col("fr"), F.col("fc"), ROWS, COLS).withColumn("h", F.round("h", 4))


@query("nearest_cell_sample", f"""
WITH {SURFACE}, {_PLACES},
q AS (SELECT s_suppkey, CAST(greatest(0, least({ROWS - 1}, round_even(fr, 0))) AS INTEGER) AS r, CAST(greatest(0, least({COLS - 1}, round_even(fc, 0))) AS INTEGER) AS c FROM p)
SELECT s_suppkey, q.r AS "row", q.c AS col, h FROM q LEFT JOIN s ON s.r = q.r AND s.c = q.c""")
def nearest_cell_sample(t):
    return grid.sample_nearest(_places(t), _surface(t), F.col("fr"), F.col("fc"), ROWS, COLS).select("s_suppkey", "row", "col", "h")


@query("cell_snaps", """
SELECT s_suppkey, CAST(floor(s_acctbal / 700.0::DOUBLE) AS INTEGER) AS floored, CAST(round_even(s_acctbal / 700.0::DOUBLE, 0) AS INTEGER) AS nearest, CAST(trunc(s_acctbal / 700.0::DOUBLE) AS INTEGER) AS truncated FROM supplier""")
def cell_snaps(t):
    zero, x = F.lit(0.0), F.col("s_acctbal")
    return t("supplier").select(
        "s_suppkey", grid.floor_cell(x, zero, 0.0, 0.0, 700.0)[1].alias("floored"), grid.nearest_cell(x, zero, 0.0, 0.0, 700.0)[1].alias("nearest"),
        grid.truncated_cell(x, zero, 0.0, 0.0, 700.0)[1].alias("truncated"),
    )


_PEAK = """
b AS (SELECT *, greatest(0, CAST(ceil((hi + 25.0::DOUBLE - lo) / 25.0::DOUBLE) AS BIGINT) - 1) AS bins FROM (SELECT min(d) AS lo, max(d) AS hi FROM d)),
f AS (SELECT least(CAST(floor((d - lo) / 25.0::DOUBLE) AS BIGINT), bins - 1) AS k, count(*) AS n FROM d, b GROUP BY ALL),
p AS (SELECT lo + k * 25.0::DOUBLE + 12.5::DOUBLE AS peak FROM (SELECT k FROM f ORDER BY n DESC, k LIMIT 1), b)"""


@query("datum_shift_peak", f"""WITH d AS (SELECT l_extendedprice / l_quantity AS d FROM lineitem), {_PEAK} SELECT round(median(d), 6) AS shift FROM d, p WHERE abs(d - peak) <= 25""")
def datum_shift_peak(t):
    lines = t("lineitem")
    shift = surface.datum_shift(lines, F.col("l_extendedprice") / F.col("l_quantity"), 25.0)
    return lines.sparkSession.range(1).select(F.round(F.lit(shift), 6).alias("shift"))


@query("ground_shift_median", "SELECT round(coalesce(median(1000.0::DOUBLE * l_quantity - l_extendedprice), 0.0), 6) AS shift FROM lineitem WHERE l_returnflag = 'A'")
def ground_shift_median(t):
    lines = t("lineitem")
    shift = surface.height_shift(lines, F.col("l_quantity") * 1000.0, "l_extendedprice", ["A"], "l_returnflag")
    return lines.sparkSession.range(1).select(F.round(F.lit(shift), 6).alias("shift"))


@query("split_shared_edges", f"""
WITH {SURFACE}, e AS (SELECT CAST(range AS INTEGER) AS part, CAST(round_even(range * 49.0 / 7, 0) AS INTEGER) AS lo, CAST(round_even((range + 1) * 49.0 / 7, 0) AS INTEGER) AS hi FROM range(7))
SELECT part, r AS "row", c AS col, h FROM s JOIN e ON r BETWEEN lo AND hi""")
def split_shared_edges(t):
    return sequence.split_shared(_surface(t), "row", ROWS - 1, 7)

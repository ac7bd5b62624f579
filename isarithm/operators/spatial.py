"""Spatial predicates as equi-joins on grid cells with an exact check behind them.

A theta join over coordinates plans as a nested loop; here each side gets the cells that it can
touch, so the join is on equal cells. Cells are as wide as the reach, so a row has few copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a line that one block of them holds.
BINS = 4096


def inside_box(df: DataFrame, x: str, y: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows inside a box, borders included."""
    xmin, ymin, xmax, ymax = box
    return df.where(F.col(x).between(xmin, xmax) & F.col(y).between(ymin, ymax))


def boxes_overlap(a: Column, b: Column) -> Column:
    """Whether two structs xmin, ymin, xmax, ymax touch."""
    return (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])


def range_counts(left: DataFrame, right: DataFrame, key: list[str], x: str, other: str, reach: float) -> DataFrame:
    """(key, n): for each key how many right values lie from x - reach to x + reach, both ends as computed; 0 is kept.

    The right side is first reduced to a count per value, then both sides meet on bins as wide as `reach`: a left
    row looks into those that its two ends and what is between them fall into. Rows of one key add up, and rows
    without a key are one key.
    """
    values = right.where(F.col(other).isNotNull()).groupBy(F.col(other).alias("_v")).agg(F.count("*").alias("_n"))
    binned = values.withColumn("_bin", F.floor(F.col("_v") / reach))
    low, high = F.col(x) - reach, F.col(x) + reach
    near = F.explode(F.sequence(F.floor(low / reach), F.floor(high / reach)))
    hits = left.where(F.col(x).isNotNull()).select(*key, low.alias("_low"), high.alias("_high"), near.alias("_bin")).join(binned, "_bin").where(F.col("_v").between(F.col("_low"), F.col("_high")))
    every = hits.select(*key, "_n").unionByName(left.select(*key, F.lit(0).cast("long").alias("_n")))
    return every.groupBy(*key).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n"))


def _cells(x: Column, y: Column, size: float) -> Column:
    around = [F.struct((F.floor(x / size) + i).alias("cx"), (F.floor(y / size) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return F.explode(F.array(*around))


def far_from(points: DataFrame, others: DataFrame, x: str, y: str, ox: str, oy: str, reach: float) -> DataFrame:
    """The points that no other point lies within `reach` of (a spatial anti-join)."""
    spots = others.where(F.col(ox).isNotNull() & F.col(oy).isNotNull()).select(F.col(ox).alias("_x"), F.col(oy).alias("_y")).distinct()
    tiles = spots.select("_x", "_y", _cells(F.col("_x"), F.col("_y"), reach).alias("_c")).select("_x", "_y", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"))
    near = (F.floor(F.col(x) / reach) == F.col("_cx")) & (F.floor(F.col(y) / reach) == F.col("_cy"))
    close = (F.col("_x") - F.col(x)) * (F.col("_x") - F.col(x)) + (F.col("_y") - F.col(y)) * (F.col("_y") - F.col(y)) <= reach * reach
    return points.join(tiles, near & close, "left_anti")


def hulls(points: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """(key, hull): the convex hull of each group's points, counter-clockwise; groups are single objects."""
    import numpy as np
    import pandas as pd

    def hull(pdf: pd.DataFrame) -> pd.DataFrame:
        p = np.unique(pdf[[x, y]].dropna().to_numpy(float), axis=0)
        if len(p) > 2:
            def half(q):
                out: list = []
                for r in q:
                    while len(out) > 1 and (out[-1][0] - out[-2][0]) * (r[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (r[0] - out[-2][0]) <= 0:
                        out.pop()
                    out.append(r)
                return out[:-1]

            p = np.array(half(p.tolist()) + half(p[::-1].tolist()))
        return pd.DataFrame({key: [pdf[key].iloc[0]], "hull": [[{"x": float(a), "y": float(b)} for a, b in p]]})

    kind = points.schema[key].dataType.simpleString()
    return points.select(key, x, y).groupBy(key).applyInPandas(hull, f"{key} {kind}, hull array<struct<x: double, y: double>>")


def outside_hulls(points: DataFrame, hull_rows: DataFrame, x: str, y: str, buffer: float, cell: float) -> DataFrame:
    """The points farther than `buffer` from every hull and inside none: boxes by cell, then the exact distance."""
    h = hull_rows.select("hull", F.transform("hull", lambda p: p["x"]).alias("_vx"), F.transform("hull", lambda p: p["y"]).alias("_vy"))
    span = lambda v: F.sequence(F.floor((F.array_min(v) - buffer) / cell), F.floor((F.array_max(v) + buffer) / cell))
    tiled = h.select("hull", F.explode(span(F.col("_vx"))).alias("_cx"), "_vy").select("hull", "_cx", F.explode(span(F.col("_vy"))).alias("_cy"))
    px, py = F.col(x), F.col(y)
    n = F.size("hull")
    edge = F.transform("hull", lambda p, i: F.struct(p.alias("a"), F.get("hull", F.pmod(i + 1, n)).alias("b")))

    def gap(e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((px - e["a"]["x"]) * dx + (py - e["a"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))))
        return F.hypot(px - e["a"]["x"] - t * dx, py - e["a"]["y"] - t * dy)

    within = F.forall(edge, lambda e: (e["b"]["x"] - e["a"]["x"]) * (py - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (px - e["a"]["x"]) >= 0) & (n >= 3)
    hit = (F.floor(px / cell) == F.col("_cx")) & (F.floor(py / cell) == F.col("_cy")) & (within | F.exists(edge, lambda e: gap(e) <= buffer))
    return points.join(tiled, hit, "left_anti")


def nearest_on_line(points: DataFrame, donors: DataFrame, key: list[str], x: str, donor: str, at: str, width: float, group: str | None = None) -> DataFrame:
    """(key, donor, distance): the donor nearest on one axis, the smallest donor of equally near ones.

    Donors are reduced to the lowest and the highest one of each bin of `width` (with their places);
    only the bins that hold donors, in order, form the table that a point's own bin is looked up in,
    so points meet by equality at most three summary rows and the donors of their own bin.
    """
    from pyspark.sql import Window

    by = [group] if group else []
    d = donors.where(F.col(at).isNotNull()).groupBy(*by, F.col(at).alias("_at")).agg(F.min(donor).alias("_d")).withColumn("_bin", F.floor(F.col("_at") / width))
    spot = F.struct("_at", "_d")
    bins = d.groupBy(*by, "_bin").agg(F.min_by(spot, F.col("_at")).alias("_first"), F.max_by(spot, F.col("_at")).alias("_last"))
    asked = points.where(F.col(x).isNotNull()).select(*by, F.floor(F.col(x) / width).alias("_bin")).distinct()
    # Bins are carried within blocks of them, and block to block through one summary row each.
    table = bins.join(asked, [*by, "_bin"], "full").withColumn("_block", F.floor(F.col("_bin") / BINS))
    ends = table.groupBy(*by, "_block").agg(*[pick(c, F.when(F.col(c).isNotNull(), F.col("_bin"))).alias(c) for pick, c in ((F.max_by, "_last"), (F.min_by, "_first"))])

    def carried(rows: DataFrame, within: list[str], order: str, names: tuple[str, str]) -> DataFrame:
        w = Window.partitionBy(*within).orderBy(order)
        before = F.last("_last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return rows.select(*within, order, before.alias(names[0]), F.first("_first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias(names[1]))

    inner = carried(table, [*by, "_block"], "_bin", ("_before", "_behind"))
    outer = carried(ends, by, "_block", ("_far_before", "_far_behind"))
    table = inner.join(outer, [*by, "_block"]).select(*by, "_bin", F.coalesce("_before", "_far_before").alias("_before"), F.coalesce("_behind", "_far_behind").alias("_behind"))
    p = points.select(*key, *[g for g in by if g not in key], F.col(x).alias("_x"), F.floor(F.col(x) / width).alias("_bin"))
    option = lambda place, who: F.when(place.isNotNull(), F.struct(F.abs(place - F.col("_x")).alias("distance"), who.alias("donor")))
    own = p.join(d, [*by, "_bin"], "left").groupBy(*key, *[g for g in by if g not in key], "_x", "_bin").agg(F.min(option(F.col("_at"), F.col("_d"))).alias("_own"))
    seen = own.join(table, [*by, "_bin"], "left")
    best = F.least(F.col("_own"), option(F.col("_before._at"), F.col("_before._d")), option(F.col("_behind._at"), F.col("_behind._d")))
    return seen.select(*key, best["donor"].alias("donor"), best["distance"].alias("distance"))


def box_counts(gates: DataFrame, vertices: DataFrame, key: str, cell: float, opening: tuple[float, float] = (0.5, 1.5), tube: tuple[float, float] = (0.3, 8.0)) -> DataFrame:
    """(key, in_opening, in_approach, clear): vertices in two upright oriented boxes of each gate; zeros are kept.

    A gate has x, y, z, size and yaw_deg, a vertex x, y, z (y up). The opening reaches, borders
    excluded, `size * opening[0]` across and up and `opening[1]` along the way through, to either side; the
    approach likewise. Gates meet
    vertices, equal ones counted first, on the cells of space that their longer box can reach; both
    sides are shuffled by cell, so the driver holds none of them.
    """
    from isarithm.functions.geometry import rotate_yaw

    half = max(opening[0], tube[0])
    reach = F.hypot(F.lit(max(opening[1], tube[1])), F.col("size") * half)
    span = lambda c, r: F.explode(F.sequence(F.floor((F.col(c) - r) / cell), F.floor((F.col(c) + r) / cell)))
    g = gates.withColumn("_r", reach).select("*", span("x", F.col("_r")).alias("_cx")).select("*", span("z", F.col("_r")).alias("_cz")).select("*", span("y", F.col("size") * half).alias("_cy"))
    v = vertices.groupBy(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("z").alias("_z")).agg(F.count("*").alias("_n"))
    v = v.select("*", *[F.floor(F.col(f"_{c}") / cell).alias(f"_c{c}") for c in "xyz"])
    dx, dy, dz = F.col("_x") - F.col("x"), F.col("_y") - F.col("y"), F.col("_z") - F.col("z")
    through, across = rotate_yaw(F.col("yaw_deg"))
    along, side = F.abs(dx * through["x"] + dz * through["z"]), F.abs(dx * across["x"] + dz * across["z"])
    within = lambda half, depth: (along < depth) & (side < F.col("size") * half) & (F.abs(dy) < F.col("size") * half)
    # The planner takes a gate's copies for no larger than the gate, and would send them all to the driver to broadcast them.
    counted = g.hint("merge").join(v, ["_cx", "_cy", "_cz"]).groupBy(key).agg(*[F.sum(F.when(within(*box), F.col("_n")).otherwise(0)).alias(n) for n, box in (("_o", opening), ("_t", tube))])
    out = gates.select(key).join(counted, key, "left").select(key, F.coalesce("_o", F.lit(0)).cast("long").alias("in_opening"), F.coalesce("_t", F.lit(0)).cast("long").alias("in_approach"))
    return out.withColumn("clear", (F.col("in_opening") == 0) & (F.col("in_approach") == 0))

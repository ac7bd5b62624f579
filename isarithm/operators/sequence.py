"""Ordered rows: rings, running sums, islands, frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isarithm.functions.geometry import smoothstep


def ring_length(rows: DataFrame, group: list[str], order: list[str], x: str, y: str) -> DataFrame:
    """(group, n, length): length of each closed way through its points in order; one point has length 0."""
    w = Window.partitionBy(*group).orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    here = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    step = rows.select(*group, here.alias("a"), F.coalesce(F.lead(here).over(w), F.first(here).over(whole)).alias("b"))
    return step.groupBy(*group).agg(F.count("*").alias("n"), F.sum(F.hypot(F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y"))).alias("length"))


def offsets(rows: DataFrame, group: list[str], order: list[str], size: str, out: str = "start") -> DataFrame:
    """Adds the sum of the sizes before each row of its group."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(out, F.sum(size).over(w) - F.col(size))


def blocks(rows: DataFrame, group: list[str], order: list[str], opens: Column, out: str = "block") -> DataFrame:
    """Adds the number of the block that a row lies in; a row that opens one belongs to it; 0 is before the first."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(out, F.sum(F.when(opens, 1).otherwise(0)).over(w))


def frames(shots: DataFrame, key: list[str], seconds: str, fps: int) -> DataFrame:
    """One row per frame: index and eased time t of max(1, round(seconds * fps)) frames, halves to even."""
    count = F.greatest(F.lit(1), F.rint(F.col(seconds) * fps).cast("int"))
    rows = shots.select(*key, count.alias("frames"), F.explode(F.sequence(F.lit(0), count - 1)).alias("frame"))
    return rows.withColumn("t", smoothstep(F.col("frame").cast("double") / F.greatest(F.lit(1), F.col("frames") - 1)))


def still_index(seconds: Column, still_at: Column, before: Column, fps: int) -> Column:
    """The frame of a shot's still, counted from the tour's first frame."""
    count = F.greatest(F.lit(1), F.rint(seconds * fps).cast("long"))
    return before + F.least(count - 1, F.rint((count - 1) * still_at).cast("long"))


def poses(frames_: DataFrame) -> DataFrame:
    """Camera ground place and height of frames with kind, t, target/start/end structs (x, z), radius, height, turns, start_deg."""
    t = F.col("t")
    angle = F.radians(F.col("start_deg") + 360.0 * F.col("turns") * t)
    radius = F.when(F.col("kind") == "reveal", F.col("radius_m") * (0.25 + 0.75 * t)).otherwise(F.col("radius_m"))
    fly = F.col("kind") == "fly"
    x = F.when(fly, F.col("start.x") + (F.col("end.x") - F.col("start.x")) * t).otherwise(F.col("target.x") + radius * F.cos(angle))
    z = F.when(fly, F.col("start.z") + (F.col("end.z") - F.col("start.z")) * t).otherwise(F.col("target.z") + radius * F.sin(angle))
    height = F.when(F.col("kind") == "reveal", F.col("height_m") * (0.15 + 0.85 * t)).otherwise(F.col("height_m"))
    return frames_.withColumns({"x": x, "z": z, "above": height})


def look_ahead(t: Column, metres: Column, start: Column, end: Column) -> Column:
    """Ground place (x, z) that a flight looks at: that far before it on its own way, at most its end."""
    length = F.hypot(end["x"] - start["x"], end["z"] - start["z"])
    at = F.least(F.lit(1.0), t + metres / F.greatest(length, F.lit(1.0)))
    return F.struct((start["x"] + (end["x"] - start["x"]) * at).alias("x"), (start["z"] + (end["z"] - start["z"]) * at).alias("z"))


def even_runs(cells: int, parts: int) -> list[tuple[int, int]]:
    """First and last point of at most `parts` runs over the cells; neighbours share a point."""
    parts = max(1, min(parts, cells))
    edges = [round(i * cells / parts) for i in range(parts + 1)]
    return list(zip(edges, edges[1:], strict=False))


def split_shared(rows: DataFrame, index: str, cells: int, parts: int, out: str = "part") -> DataFrame:
    """Rows dealt to runs of an index; a row on a shared edge goes to both runs."""
    n = max(1, min(parts, cells))
    low = F.lit(0)
    edges = F.array(*[F.lit(e) for e in [round(i * cells / n) for i in range(n + 1)]])
    hit = F.filter(F.sequence(low, F.lit(n - 1)), lambda p: (F.col(index) >= F.get(edges, p)) & (F.col(index) <= F.get(edges, p + 1)))
    return rows.withColumn(out, F.explode(hit))

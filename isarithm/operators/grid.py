"""Rasters as long tables (row, col, value): reduction of points, mosaics, resampling.

A raster's row 0 is its north edge. Missing cells are absent rows; nothing here invents a sentinel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = ("row", "col")


def floor_cell(x: Column, y: Column, west: float, north: float, res: float) -> tuple[Column, Column]:
    """(row, col) of the half-open cell that holds a point."""
    return F.floor((north - y) / res).cast("int"), F.floor((x - west) / res).cast("int")


def nearest_cell(x: Column, y: Column, x0: float, y0: float, step: float) -> tuple[Column, Column]:
    """(row, col) of the nearest cell centre, halves to even."""
    return F.rint((y - y0) / step).cast("int"), F.rint((x - x0) / step).cast("int")


def truncated_cell(x: Column, y: Column, x0: float, y0: float, step: float) -> tuple[Column, Column]:
    """(row, col) by truncation toward zero."""
    return ((y - y0) / step).cast("int"), ((x - x0) / step).cast("int")


def inside(rows: int, cols: int) -> Column:
    return (F.col("row") >= 0) & (F.col("row") < rows) & (F.col("col") >= 0) & (F.col("col") < cols)


def cell_max(points: DataFrame, z: str, payload: list[str] = (), order: list[str] = (), classes: list | None = None, class_col: str = "class", noise: list | None = None) -> DataFrame:
    """Highest z of each cell (row, col) and the payload of the point that has it.

    `classes` keeps only these classes, `noise` drops these. Of equal heights the last in `order` wins.
    NaN heights are dropped before the maximum. Partial aggregation runs before the one shuffle, by cell.
    """
    rows = points.where(F.col(z).isNotNull() & ~F.isnan(F.col(z).cast("double")))
    if classes is not None:
        rows = rows.where(F.col(class_col).isin(*classes))
    if noise is not None:
        rows = rows.where(~F.col(class_col).isin(*noise))
    rank = F.struct(F.col(z), *[F.col(c) for c in order])
    return rows.groupBy(*CELL).agg(F.max(z).alias("h"), *[F.max_by(F.col(c), rank).alias(c) for c in payload])


def spine(df: DataFrame, rows: int, cols: int) -> DataFrame:
    """All cells of a grid."""
    return df.sparkSession.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))


def dense(raster: DataFrame, rows: int, cols: int, fill: float | None = None, value: str = "h") -> DataFrame:
    """Every cell of the grid; missing ones are null or take the fill."""
    out = spine(raster, rows, cols).join(raster, list(CELL), "left")
    return out.fillna({value: fill}) if fill is not None else out


def decimate(raster: DataFrame, k: int, value: str = "h") -> DataFrame:
    """Mean of the present cells of every k x k block."""
    block = lambda c: F.floor(F.col(c) / k).cast("int").alias(c)
    return raster.groupBy(block("row"), block("col")).agg(F.avg(value).alias(value))


def mosaic_first(sheets: DataFrame, order: list[str], value: str = "h") -> DataFrame:
    """Of several sheets over one grid, the value of the first that covers a cell."""
    return sheets.where(F.col(value).isNotNull()).groupBy(*CELL).agg(F.min_by(value, F.struct(*order)).alias(value))


def overlay_last(sheets: DataFrame, order: list[str], value: str = "h") -> DataFrame:
    """The value of the last sheet that covers a cell."""
    return sheets.where(F.col(value).isNotNull()).groupBy(*CELL).agg(F.max_by(value, F.struct(*order)).alias(value))


def paint(base: DataFrame, survey: DataFrame, value: str = "h") -> DataFrame:
    """The base with the survey's cells over it; the survey's footprint decides, not its values."""
    top = survey.select(*CELL, F.col(value).alias("_top"), F.lit(True).alias("_there"))
    joined = base.join(top, list(CELL), "left")
    return joined.withColumn(value, F.when(F.col("_there"), F.col("_top")).otherwise(F.col(value))).drop("_top", "_there")


def zip_diff(a: DataFrame, b: DataFrame, value: str = "h") -> DataFrame:
    """a - b where both have a finite value."""
    finite = lambda df, name: df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*CELL, F.col(value).alias(name))
    return finite(a, "_a").join(finite(b, "_b"), list(CELL)).select(*CELL, (F.col("_a") - F.col("_b")).alias("diff"))


def bilinear(points: DataFrame, raster: DataFrame, key: list[str], fr: Column, fc: Column, rows: int, cols: int, value: str = "h") -> DataFrame:
    """(key, value): each point's mean of the four cells around its fractional row and column, clamped to the edge.

    One join on the cell: a point becomes four weighted cells, whose products are summed. Use
    `row - 0.5` and `col - 0.5` for values at cell centres.
    """
    clamp = lambda c, n: F.greatest(F.lit(0.0), F.least(F.lit(float(n - 1)), c))
    placed = points.select(*key, clamp(fr, rows).alias("_r"), clamp(fc, cols).alias("_c"))
    low = placed.select("*", F.least(F.floor("_r"), F.lit(max(rows - 2, 0))).cast("int").alias("_r0"), F.least(F.floor("_c"), F.lit(max(cols - 2, 0))).cast("int").alias("_c0"))
    corner = lambda dr, dc: F.struct(
        F.least(F.col("_r0") + dr, F.lit(rows - 1)).alias("row"),
        F.least(F.col("_c0") + dc, F.lit(cols - 1)).alias("col"),
        ((F.col("_r") - F.col("_r0") if dr else 1.0 - (F.col("_r") - F.col("_r0"))) * (F.col("_c") - F.col("_c0") if dc else 1.0 - (F.col("_c") - F.col("_c0")))).alias("w"),
    )
    cells = low.select(*key, F.explode(F.array(*[corner(dr, dc) for dr in (0, 1) for dc in (0, 1)])).alias("k")).select(*key, "k.*")
    return cells.join(raster.select(*CELL, value), list(CELL)).groupBy(*key).agg(F.sum(F.col("w") * F.col(value)).alias(value))


def sample_nearest(points: DataFrame, raster: DataFrame, fr: Column, fc: Column, rows: int, cols: int, value: str = "h") -> DataFrame:
    """The points with the value of their nearest cell, clamped to the grid."""
    clamp = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.rint(c).cast("int")))
    placed = points.withColumns({"row": clamp(fr, rows), "col": clamp(fc, cols)})
    return placed.join(raster.select(*CELL, value), list(CELL), "left")

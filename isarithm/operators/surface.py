"""Height surfaces of point clouds, and the offsets between two height references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isarithm.lineage import settle
from isarithm.operators import grid, stencil
from isarithm.operators.quantile import exact_median


def read_surface(points: DataFrame, rows: int, cols: int, z: str = "z", classes: list | None = None, noise: list | None = (7, 18), close: int = 2, mean: int = 1, payload: list[str] = (), order: list[str] = ()) -> DataFrame:
    """Points (row, col, z, class) to a whole surface: highest point, holes filled, gaps closed, smoothed.

    The payload of the highest point goes along; it is null where no point fell.
    """
    top = settle(grid.cell_max(points.where(grid.inside(rows, cols)), z, list(payload), list(order), classes, noise=list(noise) if noise else None))
    whole = stencil.fill_holes(top.select("row", "col", F.col("h").cast("double").alias("h")), grid.spine(points, rows, cols), rows, cols)
    out = stencil.smooth(stencil.close_gaps(settle(whole), rows, cols, close), rows, cols, mean)
    return out.join(top.drop("h"), ["row", "col"], "left") if payload else out


def datum_shift(diffs: DataFrame, diff: Column, bin_size: float = 0.1, least: int = 256) -> float:
    """The offset at which differences pile up: the fullest bin, then the median within a bin of its middle.

    Bins start at the smallest difference; the last one is closed; the first of equally full ones
    wins; with fewer than two bins it is the plain median. Fewer than `least` differences are an error.
    """
    d = diffs.select(diff.cast("double").alias("d")).where("d IS NOT NULL AND NOT isnan(d)")
    n, low, high = d.agg(F.count("*"), F.min("d"), F.max("d")).first()
    if n < least:
        raise ValueError("the two height references do not overlap")
    # As many edges as fit in steps from the smallest value up to, without, the largest plus one bin.
    bins = max(0, int(-(-(high + bin_size - low) // bin_size)) - 1)
    if bins < 2:
        return exact_median(d, F.col("d"))
    place = F.least(F.floor((F.col("d") - low) / bin_size), F.lit(bins - 1))
    fullest = d.groupBy(place.alias("b")).count().orderBy(F.desc("count"), "b").first()["b"]
    peak = low + fullest * bin_size + bin_size / 2
    return exact_median(d.where(F.abs(F.col("d") - peak) <= bin_size), F.col("d"))


def height_shift(points: DataFrame, terrain: Column, z: str = "z", ground: list = (2,), class_col: str = "class") -> float:
    """Median of terrain minus z over the ground class; 0 without ground points."""
    shift = exact_median(points.where(F.col(class_col).isin(*ground)), terrain - F.col(z))
    return 0.0 if shift is None else shift

"""Highest point per cell of a stream of points. Maxima may arrive in any order; medians and winners by order cannot stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_cell_max(points: DataFrame, z: str = "z") -> DataFrame:
    """Highest z of each (row, col) so far; write it in update or complete mode. State is one number a cell."""
    return points.where(F.col(z).isNotNull()).groupBy("row", "col").agg(F.max(z).alias("h"))


def windowed_counts(events: DataFrame, ts: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per kind and time window; rows later than the watermark are left out and closed windows are forgotten."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n")).select("w.start", by, "n")

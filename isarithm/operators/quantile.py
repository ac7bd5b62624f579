"""Exact medians of columns that fit no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that one percentile aggregation may hold.
FEW = 200_000
BINS = 4096


def exact_median(df: DataFrame, value: Column) -> float | None:
    """The median (mean of the middle two) of a numeric expression; None without values; nulls and NaN are left out.

    Ranges are narrowed by histograms, of which the driver sees at most BINS counts a round, until the
    middle lies among few values; only those meet in one task. Memory is bounded whatever the input.
    """
    v = df.select(value.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    n, low, high = v.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if n == 0:
        return None
    return (_at(v, (n - 1) // 2, n, low, high) + _at(v, n // 2, n, low, high)) / 2


def _at(v: DataFrame, k: int, n: int, low: float, high: float) -> float:
    """The value of rank k, counted from 0, of n values from low to high."""
    part = v
    while n > FEW and high > low:
        width = (high - low) / BINS
        bins = part.groupBy(F.least(F.floor((F.col("v") - low) / width), F.lit(BINS - 1)).alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for row in bins.orderBy("b").collect():
            if k < row["n"]:
                if row["n"] == n:  # one bin holds all: nothing is gained
                    width = 0.0
                n, low, high = row["n"], row["lo"], row["hi"]
                break
            k -= row["n"]
        part = v.where(F.col("v").between(low, high))
        if width == 0.0:
            break
    if low == high:
        return low
    return part.orderBy("v").offset(k).limit(1).first()["v"]

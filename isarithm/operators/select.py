"""Selection in order: first wins, round robin, spaced maxima, shelves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first in order, by partial aggregation instead of a window."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, *[F.col(f"_r.`{c}`") for c in rest]).select(*df.columns)


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Keyed union: of rows with equal keys the last in order."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, *[F.col(f"_r.`{c}`") for c in rest]).select(*df.columns)


def round_robin(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """k rows: the best of every group in order, then the second best, and so on, with `turn` and `place`.

    A group can give at most k rows, which the window's limit cuts before its shuffle.
    """
    turn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    ranked = df.withColumn("turn", turn).where(F.col("turn") <= k).orderBy("turn", *order).limit(k)
    return ranked.withColumn("place", F.row_number().over(Window.orderBy("turn", *order)))


def spaced_maxima(raster: DataFrame, k: int, radius: int, value: str = "h", above: float = 3.0) -> DataFrame:
    """(place, row, col, value): up to k highest cells, each outside the square of +-radius cells of those before.

    Equal heights go to the first cell by row, then column; it ends at `above`. Every pick is one
    aggregation, and the driver holds the k picks only.
    """
    left, picks = raster, []
    for place in range(1, k + 1):
        best = left.agg(F.max_by(F.struct("row", "col", value), F.struct(F.col(value), -F.col("row"), -F.col("col"))).alias("b")).first()["b"]
        if best is None or best[value] <= above:
            break
        picks.append((place, best["row"], best["col"], float(best[value])))
        left = left.where(~(F.col("row").between(best["row"] - radius, best["row"] + radius) & F.col("col").between(best["col"] - radius, best["col"] + radius)))
    return raster.sparkSession.createDataFrame(picks, f"place int, row int, col int, {value} double")


def shelf_pack(panels: DataFrame, key: str, width: Column, height: Column, texel: float, most: int, order: str) -> DataFrame:
    """(key, x, y, w, h): next-fit shelves from the tallest panel down, in texels with a border of one.

    Packing is a fold over one order. It reads sizes only, one atlas at a time; the fold's state is three numbers.
    """
    from collections.abc import Iterator

    import pandas as pd

    px = lambda c: F.least(F.lit(most), F.greatest(F.lit(2), F.ceil(c / texel) + 2)).cast("int")
    sized = panels.select(F.col(key).alias("key"), px(width).alias("w"), px(height).alias("h"), height.cast("double").alias("_tall"), F.col(order).alias("_order"))
    lined = sized.repartition(1).sortWithinPartitions(F.desc("_tall"), "_order").select("key", "w", "h")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = y = shelf = 0
        for part in batches:
            spots = []
            for w, h in zip(part["w"], part["h"], strict=True):
                if x + w > most:
                    x, y, shelf = 0, y + shelf, 0
                spots.append((x, y))
                x, shelf = x + w, max(shelf, h)
            yield part.assign(x=[s[0] for s in spots], y=[s[1] for s in spots])[["key", "x", "y", "w", "h"]]

    kind = panels.schema[key].dataType.simpleString()
    return lined.mapInPandas(fold, f"key {kind}, x int, y long, w int, h int").withColumnRenamed("key", key)

"""Golden values of grids, stencils and surfaces."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isarithm.operators import grid, sequence, stencil, surface
from isarithm.operators.quantile import exact_median


def raster(spark, a):
    rows = [(int(r), int(c), float(v)) for (r, c), v in np.ndenumerate(np.asarray(a, float)) if not math.isnan(v)]
    return spark.createDataFrame(rows, "row int, col int, h double")


def array(df, rows, cols):
    out = np.full((rows, cols), np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = r["h"]
    return out


def test_bilinear(spark):
    r = raster(spark, [[0, 10], [20, 30]])
    points = [(0.5, 1.5, 0.0), (1.5, 1.5, 10.0), (0.5, 0.5, 20.0), (1.0, 1.0, 15.0), (-5.0, 9.0, 0.0), (9.0, -9.0, 30.0)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(points)], "id int, x double, y double")
    out = grid.bilinear(df, r, ["id"], (2.0 - F.col("y")) - 0.5, F.col("x") - 0.5, 2, 2)
    assert {row["id"]: row["h"] for row in out.collect()} == {i: v for i, (_, _, v) in enumerate(points)}


def test_median_fill(spark):
    r = raster(spark, [[1, math.nan], [3, math.nan]])
    out = array(grid.dense(r, 2, 2, exact_median(r, F.col("h"))), 2, 2)
    assert out.tolist() == [[1, 2], [3, 2]]


def test_exact_median_narrows(spark, monkeypatch):
    from isarithm.operators import quantile

    values = np.random.default_rng(0).normal(size=5001)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "v double")
    monkeypatch.setattr(quantile, "FEW", 50)
    assert exact_median(df, F.col("v")) == np.median(values)
    assert exact_median(df.where("v > 100 AND NOT isnan(v)"), F.col("v")) is None
    same = spark.range(300).select(F.lit(7.0).alias("v"))
    assert exact_median(same, F.col("v")) == 7.0


def test_cell_max_classes_and_winner(spark):
    rows = [(0, 0, 3.0, 1, 1), (0, 0, 11.0, 1, 2), (0, 0, 40.0, 7, 3), (0, 0, 11.0, 2, 4), (1, 0, 4.0, 6, 5)]
    df = spark.createDataFrame(rows, "row int, col int, z double, class int, ord int")
    top = {(r["row"], r["col"]): (r["h"], r["ord"]) for r in grid.cell_max(df, "z", ["ord"], ["ord"], noise=[7, 18]).collect()}
    assert top == {(0, 0): (11.0, 4), (1, 0): (4.0, 5)}
    only = grid.cell_max(df, "z", classes=[1]).collect()
    assert [r["h"] for r in only] == [11.0]


def test_closing_fills_a_hole_and_keeps_the_edge(spark):
    a = np.zeros((21, 21))
    a[5:16, 5:16] = 12.0
    a[10, 10] = 0.0
    out = array(stencil.close_gaps(raster(spark, a), 21, 21, 2), 21, 21)
    assert out[10, 10] == 12 and out[5, 5] == 12 and out[2, 2] == 0


def test_smoothing_keeps_the_mean_and_wraps(spark):
    a = np.random.default_rng(1).normal(10, 2, (16, 16))
    out = array(stencil.smooth(raster(spark, a), 16, 16, 1), 16, 16)
    want = sum(np.roll(np.roll(a, i, 0), j, 1) for i in (-1, 0, 1) for j in (-1, 0, 1)) / 9
    assert np.allclose(out, want) and np.isclose(out.mean(), a.mean())


@pytest.mark.parametrize(("rows", "cols", "radius"), [(3, 4, 5), (130, 70, 2), (75, 150, 9)])
def test_windows_over_many_tiles(spark, rows, cols, radius):
    rng = np.random.default_rng(rows)
    a = np.where(rng.random((rows, cols)) < 0.3, rng.random((rows, cols)), np.nan)
    want = np.full((rows, cols), np.nan)
    for i in range(-radius, radius + 1):
        for j in range(-radius, radius + 1):
            want = np.fmax(want, np.roll(a, (i, j), (0, 1)))
    got = stencil.window(raster(spark, a), rows, cols, radius, F.max)
    assert got.count() == got.select("row", "col").distinct().count()
    assert np.array_equal(array(got, rows, cols), want, equal_nan=True)


@pytest.mark.parametrize("holes", [0, 1, 60, 255, 256])
def test_hole_fill(spark, holes):
    rng = np.random.default_rng(holes)
    a = rng.integers(1, 50, (16, 16)).astype(float)
    a.ravel()[rng.permutation(256)[:holes]] = np.nan
    hole = np.isnan(a)
    want = a.copy()
    if hole.all():
        want = np.zeros_like(a)
    elif hole.any():
        v, w = np.where(hole, 0, a), (~hole).astype(float)
        for _ in range(5):
            if w.min() > 0:
                break
            v, w = (sum(np.roll(np.roll(x, i, 0), j, 1) for i in (-1, 0, 1) for j in (-1, 0, 1)) for x in (v, w))
        want = np.where(hole, v / np.maximum(w, 1e-9), a)
    r = raster(spark, a) if holes < 256 else spark.createDataFrame([], "row int, col int, h double")
    out = array(stencil.fill_holes(r, grid.spine(r, 16, 16), 16, 16), 16, 16)
    assert np.allclose(out, want)


def test_datum_peak_beats_the_median(spark):
    rng = np.random.default_rng(0)
    clutter = np.where(rng.random(40000) < 0.65, -rng.uniform(3, 12, 40000), 0.0)
    d = -19.0 + clutter + rng.normal(0, 0.02, 40000)
    df = spark.createDataFrame([(float(v),) for v in d], "d double")
    assert abs(surface.datum_shift(df, F.col("d")) + 19.0) < 0.1
    assert abs(np.median(d) + 19.0) > 1
    with pytest.raises(ValueError):
        surface.datum_shift(df.limit(100), F.col("d"))


def test_height_shift(spark):
    df = spark.createDataFrame([(31.0, 2, 12.0), (31.0, 2, 12.0), (46.0, 5, 12.0)], "z double, class int, t double")
    assert surface.height_shift(df, F.col("t")) == -19.0
    assert surface.height_shift(df.where("class = 5"), F.col("t")) == 0.0


def test_split_shared_points(spark):
    assert sequence.even_runs(10, 3) == [(0, 3), (3, 7), (7, 10)]
    assert len(sequence.even_runs(3, 10)) == 3
    rows = sequence.split_shared(spark.range(11), "id", 10, 3).groupBy("part").agg(F.min("id"), F.max("id")).orderBy("part").collect()
    assert [tuple(r) for r in rows] == [(0, 0, 3), (1, 3, 7), (2, 7, 10)]


def test_surface_of_a_cloud_runs_whole(spark):
    rng = np.random.default_rng(3)
    rows = [(int(r), int(c), float(z), 1) for r, c, z in zip(rng.integers(0, 12, 90), rng.integers(0, 12, 90), rng.normal(5, 1, 90), strict=True)]
    df = spark.createDataFrame(rows, "row int, col int, z double, class int")
    assert surface.read_surface(df, 12, 12, classes=[1]).count() == 144


def test_stream_matches_batch(spark, tmp_path):
    from isarithm.streaming.cells import stream_cell_max

    rows = [(i % 3, i % 2, float(i * 7 % 11)) for i in range(50)]
    df = spark.createDataFrame(rows, "row int, col int, z double")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream_cell_max(stream).writeStream.outputMode("complete").format("memory").queryName("cells").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("cells").collect())) == sorted(map(tuple, grid.cell_max(df, "z").collect()))

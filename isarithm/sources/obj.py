"""Building text files: vertices, faces and one building for each material block."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isarithm.operators import sequence
from isarithm.operators.mesh import fan


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): numbered lines of the text files under a path; a file is one row until it is split."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return whole


def read_offset(spark: SparkSession, path: str) -> DataFrame:
    """(file, east, north, height) of sidecars with a 3 x 4 matrix or three numbers; others give nulls."""
    number = F.lit(r"([-+]?\d+(?:\.\d+)?)")
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.filter(F.split("value", r"\r?\n"), lambda s: F.trim(s) != "").alias("l"))
    found = rows.select("file", F.transform("l", lambda s: F.regexp_extract_all(s, number, F.lit(1))).alias("n"))
    matrix = (F.size("n") == 3) & F.forall("n", lambda r: F.size(r) == 4)
    flat = F.flatten("n")
    part = lambda k: F.when(matrix, F.get(F.get("n", F.lit(k)), F.lit(3))).when(F.size(flat) == 3, F.get(flat, F.lit(k))).cast("double")
    return found.select("file", part(0).alias("east"), part(1).alias("north"), part(2).alias("height"))


def read_obj(spark: SparkSession, path: str, offset: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) of all buildings.

    vertices: file, block, name, vid, x, y, z, only those that the block's faces use; faces: file,
    block, name, fid, a, b, c. A block lasts until the next material line; faces before the first one
    are dropped, and blocks without faces give nothing. Polygons are cut into fans.
    """
    rows = lines(spark, path)
    marked = rows.withColumns({"is_v": F.col("line").startswith("v "), "is_f": F.col("line").startswith("f "), "is_m": F.col("line").startswith("usemtl ")}).where("is_v OR is_f OR is_m")
    blocked = sequence.blocks(marked, ["file"], ["line_no"], F.col("is_m"))
    names = blocked.where("is_m").select("file", "block", F.trim(F.substr("line", F.lit(8))).alias("name"))
    word = F.split(F.trim("line"), r"\s+")
    numbered = sequence.offsets(blocked.where("is_v").withColumn("one", F.lit(1)), ["file"], ["line_no"], "one", "vid")
    points = numbered.select("file", "vid", *[(F.get(word, F.lit(k + 1)).cast("double") + offset[k]).alias(c) for k, c in enumerate("xyz")])
    ring = F.transform(F.slice(word, 2, F.size(word)), lambda p: F.split(p, "/")[0].cast("long") - 1)
    triangles = blocked.where("is_f AND block > 0").select("file", "block", "line_no", F.posexplode(fan(ring)).alias("k", "t"))
    faces = triangles.join(names, ["file", "block"]).select("file", "block", "name", F.struct("line_no", "k").alias("fid"), "t.a", "t.b", "t.c")
    used = faces.select("file", "block", "name", F.explode(F.array("a", "b", "c")).alias("vid")).distinct()
    return used.join(points, ["file", "vid"]).select("file", "block", "name", "vid", "x", "y", "z"), faces

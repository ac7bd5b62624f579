"""Where operators cut lineage: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one only where that is unset and all tasks run on this machine, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="isarithm-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new path under the shared folder, as a URI that executors can open."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, computed now and kept in the shared folder, so that a lost executor costs no recomputing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by fresh_dir, through the file system that it is on."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

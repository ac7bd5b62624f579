"""Cutting the lineage of iterative operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settle(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the folder that spark.checkpoint.dir names.

    Where that is unset a local folder serves, but only if all tasks run on this machine; else it is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="isarithm-"))
    return df.checkpoint(eager=True)

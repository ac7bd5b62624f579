"""Cuts through trees of tiles whose nodes carry an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isarithm.lineage import settle


def tree_cut(nodes: DataFrame, max_error: float, most_rounds: int = 64) -> DataFrame:
    """(block, node, level): the first nodes on every way down that are good enough, or leaves, if they have content.

    `nodes` has block, node, parent (null at the root), error, uri and n_children. A node is good
    enough if its error is at most max_error, which must be positive: else only leaves count. One without
    content is passed through; a childless one without content gives nothing; a node that no root
    leads to is never taken. A node is in the cut if it would stop the walk and no ancestor would:
    every node looks one ancestor up, then two, four and so on, so the number of joins is the
    logarithm of the depth, and the driver reads one flag a round.
    """
    has = F.coalesce(F.col("uri").endswith(".b3dm"), F.lit(False))
    good = (F.lit(max_error > 0) & (F.coalesce("error", F.lit(0.0)) <= max_error)) | (F.col("n_children") == 0)
    own = nodes.select("block", "node", "parent", (has & good).alias("take"))
    up = own.select("block", F.col("node").alias("parent"), F.col("take").alias("_above"))
    first = own.join(up, ["block", "parent"], "left")
    state = settle(first.select(
        "block", "node", "take", F.when(F.col("_above").isNotNull(), F.col("parent")).alias("up"), (F.col("parent").isNotNull()).cast("int").alias("level"),
        F.when(F.col("parent").isNull(), F.lit(False)).otherwise(F.coalesce("_above", F.lit(True))).alias("shut"),
    ))
    for _ in range(most_rounds):
        if state.where("up IS NOT NULL").isEmpty():
            break
        above = state.select("block", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("level").alias("_level"), F.col("shut").alias("_shut"))
        state = settle(state.join(above, ["block", "up"], "left").select("block", "node", "take", F.col("_up").alias("up"), (F.col("level") + F.coalesce("_level", F.lit(0))).alias("level"), (F.col("shut") | F.coalesce("_shut", F.lit(False))).alias("shut")))
    return state.where("take AND NOT shut AND up IS NULL").select("block", "node", "level")


def levels(names: DataFrame, name: str) -> DataFrame:
    """(level, n): tiles per level, from names that end in _L<level>_<number>.b3dm."""
    from isarithm.functions.texts import tile_level

    return names.select(tile_level(F.col(name)).alias("level")).where("level IS NOT NULL").groupBy("level").agg(F.count("*").alias("n"))

"""Connected components as DataFrame iterations over an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isarithm.llm.storage import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, class_id): the smallest id of each vertex's component, for edges (a, b).

    Each round gives a vertex the smallest label around it and then that label's own label, which
    halves paths; it ends when no label changes. Labels stay in the cluster: the driver reads one
    count a round. Edges with a null end are ignored; an empty edge list gives no rows.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = cut(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("class_id")))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("class_id").alias("low"))
        next_up = labels.join(near, labels["id"] == near["a"], "left").select("id", F.col("class_id").alias("old"), F.least("class_id", "low").alias("class_id"))
        jump = labels.select(F.col("id").alias("class_id"), F.col("class_id").alias("up"))
        after = cut(next_up.join(jump, "class_id", "left").select("id", "old", F.least("class_id", "up").alias("class_id")))
        if after.where("old <> class_id").isEmpty():
            return after.select("id", "class_id")
        labels = after.select("id", "class_id")

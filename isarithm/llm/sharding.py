"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Keys and the virtual nodes of every shard are hashed onto a ring of CELLS places. A key belongs to
the shard of the next virtual node clockwise; where that shard is full, the key continues clockwise
to the next one that has room. No shard is filled beyond `1 + slack` times the mean load as long as
some place fits, so balance is guaranteed, and only the overflow of full shards moves when a shard is
added or sizes change.

The unit that moves is a ring cell: all keys of one cell share their way. Cells' loads are summed in
the cluster, and only that summary, of at most CELLS rows whatever the input, reaches the driver,
where the ring is walked, heavy cells first. A cell that fits nowhere goes to the shard with the most
room on its way, so the most that a shard exceeds its bound by is one cell: with n equal keys that is
about 1/CELLS of all bytes, with one key that has more than a shard's share it is that key. Heavy cells
go first, so a change of sizes can also move cells of other sizes.

Slots need an order within a cell. A cell with over 1/HOT of all rows, such as that of one hot key, is
cut in SPLIT parts by size and checksum, each a task's; only equal texts of such a key stay together.

Defined cases: a null text has no bytes and size 1; a null key is a key of its own; equal keys share a
shard (rows of one key are never parted, so a key with most of the bytes makes a heavy shard); slots
order a shard's rows by ring place, part of a hot cell, key, size and text checksum, and repeated rows get slots in any
order; very long texts count with their bytes and are not moved; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 1 << 16
VIRTUAL = 64
SLACK = 0.001
HOT = 256
SPLIT = 64


def ring(shards: int, virtual: int = VIRTUAL, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Places and shards of the virtual nodes, clockwise; a node's place depends on its shard and number only."""
    points = sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % cells, s) for s in range(shards) for v in range(virtual))
    return np.array([p for p, _ in points]), np.array([s for _, s in points])


def walk(cell: np.ndarray, load: np.ndarray, shards: int, slack: float = SLACK, virtual: int = VIRTUAL, cells: int = CELLS) -> np.ndarray:
    """The shard of each cell, given the cells' loads."""
    places, owner = ring(shards, virtual, cells)
    # Each node's shards in clockwise order of first meeting.
    route = []
    for k in range(len(owner)):
        seen: list[int] = []
        for s in np.roll(owner, -k):
            if s not in seen:
                seen.append(int(s))
                if len(seen) == shards:
                    break
        route.append(seen)
    home = np.searchsorted(places, cell) % len(places)
    bound = (1 + slack) * float(load.sum()) / shards
    held = [0.0] * shards
    out = np.zeros(len(cell), np.int32)
    for i in np.lexsort((cell, -load)):
        way = route[home[i]]
        size = float(load[i])
        to = next((s for s in way if held[s] + size <= bound), None)
        if to is None:
            to = min(way, key=lambda s: held[s])
        held[to] += size
        out[i] = to
    return out


def cell_of(key: Column, cells: int = CELLS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells)).cast("int")


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK, virtual: int = VIRTUAL, cells: int = CELLS) -> DataFrame:
    """(id, size, text_crc32, shard, slot): sizes are UTF-8 bytes plus 1; slots count from 0 in every shard."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)).cast("long").alias("_bytes"),
        F.crc32(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
        cell_of(F.col(f"`{id_col}`"), cells).alias("_cell"),
    ).withColumn("size", F.col("_bytes") + 1)
    summary = rows.groupBy("_cell").agg(F.sum("size").alias("load"), F.count("*").alias("n")).toPandas().sort_values("_cell", ignore_index=True)
    summary["shard"] = walk(summary["_cell"].to_numpy(), summary["load"].to_numpy(), shards, slack, virtual, cells)
    summary["offset"] = summary.groupby("shard")["n"].cumsum() - summary["n"]
    hot = summary[summary["n"] > summary["n"].sum() / HOT]
    part = F.pmod(F.xxhash64("text_crc32", "size"), F.lit(SPLIT)).cast("int")
    cut = rows.withColumn("_part", F.when(F.col("_cell").isin(hot["_cell"].tolist()), part).otherwise(0) if len(hot) else F.lit(0))
    plan = summary[["_cell", "shard", "offset"]].assign(_part=0)
    if len(hot):
        parts = cut.where(F.col("_cell").isin(hot["_cell"].tolist())).groupBy("_cell", "_part").agg(F.count("*").alias("m")).toPandas().sort_values(["_cell", "_part"])
        parts = parts.merge(plan[["_cell", "shard", "offset"]], on="_cell")
        parts["offset"] += parts.groupby("_cell")["m"].cumsum() - parts["m"]
        plan = pd.concat([plan[~plan["_cell"].isin(hot["_cell"])], parts[["_cell", "shard", "offset", "_part"]]])
    layout = T.StructType().add("_cell", "integer").add("_part", "integer").add("shard", "integer").add("offset", "long")
    plan = docs.sparkSession.createDataFrame(pd.DataFrame(plan[["_cell", "_part", "shard", "offset"]]), layout)
    # At most CELLS + HOT * SPLIT rows, so always broadcast.
    within = Window.partitionBy("_cell", "_part").orderBy(id_col, "size", "text_crc32")
    placed = cut.withColumn("_rank", F.row_number().over(within)).join(F.broadcast(plan), ["_cell", "_part"])
    return placed.select(id_col, "size", "text_crc32", "shard", (F.col("offset") + F.col("_rank") - 1).alias("slot"))


def write(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", **params) -> None:
    """The rows as Parquet, one folder `shard=<n>` for each shard; a shard is written by many tasks."""
    placed = shard(docs, shards, id_col, text_col, **params).select(F.col(id_col).alias("_id"), "text_crc32", "shard").distinct()
    crc = F.crc32(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"))
    joined = docs.join(placed, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (crc == F.col("text_crc32")))
    joined.drop("_id", "text_crc32").write.partitionBy("shard").parquet(path)

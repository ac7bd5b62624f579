"""Arrow kernels beside columns of any name: the columns travel under numbers and get their names back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_kernel(
    docs: DataFrame, given: list[Column], kernel: Callable[[list[pa.Array]], list[pa.Array]], new: list[tuple[str, T.DataType]], keep: list[str], pieces: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """The kept columns and those that the kernel makes of the given expressions.

    `pieces` cuts a batch, whose first columns are the given ones, into slices; the kernel gets the
    given columns of a slice and returns one array per new column. Kept columns that are named like
    a new one are left out.
    """
    names = [c for c in keep if c not in {n for n, _ in new}]
    rows = docs.select(*[g.alias(f"g{i}") for i, g in enumerate(given)], *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)])
    layout = T.StructType([*[T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(names)], *[T.StructField(f"n{i}", t) for i, (_, t) in enumerate(new)]])
    n = len(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield pa.RecordBatch.from_arrays([*piece.columns[n:], *kernel(piece.columns[:n])], names=layout.names)

    return rows.mapInArrow(run, layout).toDF(*names, *[name for name, _ in new])

"""All queries of the library's own operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isarithm.plans import builds, geometry, rasters, reports, scenes, selection, spatial, stages, walls  # noqa: F401
from isarithm.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

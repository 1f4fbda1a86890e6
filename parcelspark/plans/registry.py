"""Every registered query and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelspark.plans import blocks, catalog, cells, files, guards, merging, rasters, release, seams, shapes  # noqa: F401  (each registers its queries)
from parcelspark.plans.base import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.merge_summary(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

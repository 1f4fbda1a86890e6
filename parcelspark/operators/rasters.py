"""Raster operators on pixel tables (tile, row, col, value) as DataFrame plans, and on block tables by kernel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.operators.aggregates import exact_quantiles


def zonal_means(pixels: DataFrame, layers: list[str], *by: str, more: Sequence[Column] = ()) -> DataFrame:
    """Count and mean of each layer for each label, and `more` of the same pass; NaN makes a mean NaN, and null is left out."""
    return pixels.groupBy(*by).agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in layers), *more)


def reduce_any(pixels: DataFrame, size: int, flag: Column, *by: str) -> DataFrame:
    cell = lambda c: F.floor(F.col(c) / size).cast("long")
    return pixels.groupBy(*by, cell("row").alias("row"), cell("col").alias("col")).agg(F.bool_or(F.coalesce(flag, F.lit(False))).alias("hit"))


def reduce_mean(pixels: DataFrame, size: int, value: str, *by: str) -> DataFrame:
    """Coarser pixels: the mean of those there, halves rounded up."""
    cell = lambda c: F.floor(F.col(c) / size).cast("long")
    return pixels.groupBy(*by, cell("row").alias("row"), cell("col").alias("col")).agg(F.floor(F.avg(value) + 0.5).cast("long").alias("value"))


def share_above(pixels: DataFrame, value: str, threshold: float, *by: str) -> DataFrame:
    return pixels.groupBy(*by).agg(F.avg((F.col(value) > threshold).cast("double")).alias("share"))


def moving_mean(df: DataFrame, by: list[str], order: list[str], value: str, half: int, least: int) -> DataFrame:
    """`mean` of the values within `half` rows either side, null where fewer than `least` are not null."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-half, half)
    n = F.count(value).over(w)
    return df.withColumn("n_valid", n).withColumn("sum_valid", F.sum(value).over(w)).withColumn("mean", F.when(F.col("n_valid") >= least, F.col("sum_valid") / F.col("n_valid")))


def step_profile(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Absolute difference to the row before."""
    return df.withColumn("step", F.abs(F.col(value) - F.lag(value).over(Window.partitionBy(*by).orderBy(*order))))


def difference(a: DataFrame, b: DataFrame, on: list[str], value: str) -> DataFrame:
    """One row: pixels compared, the largest and mean absolute difference, shares over 1 and over 4."""
    d = a.select(*on, F.col(value).alias("_a")).join(b.select(*on, F.col(value).alias("_b")), on).select(F.abs(F.col("_a") - F.col("_b")).alias("d"))
    return d.agg(F.count("*").alias("n"), F.max("d").alias("largest"), F.avg("d").alias("mean"), F.avg((F.col("d") > 1).cast("double")).alias("over1"), F.avg((F.col("d") > 4).cast("double")).alias("over4"))


def mosaic(pixels: DataFrame, how: str, *by: str) -> DataFrame:
    """Overlapping tiles to one value a pixel: the first by tile key, the largest, or the mean."""
    value = {"first": F.min_by("value", "tile_key"), "max": F.max("value"), "mean": F.avg("value")}[how]
    return pixels.groupBy(*by).agg(value.alias("value"))


def histogram_percentiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """`(share, value)` from the histogram (one row a value), by running counts."""
    return exact_quantiles(df, value, shares)


def sample_layer(pixels: DataFrame, layer: DataFrame, factor: int, value: str, by: list[str]) -> DataFrame:
    """`pixels` with the value of a coarser layer's cell (row, col) that each lies in; null where there is none."""
    cells = layer.select(*by, F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("value").alias(value))
    cell = lambda c: F.floor(F.col(c) / factor).cast("long")
    return pixels.withColumn("_r", cell("row")).withColumn("_c", cell("col")).join(cells, [*by, "_r", "_c"], "left").drop("_r", "_c")


def class_areas(pixels: DataFrame, classes: dict[str, list[int]], cell_area: float, *by: str) -> DataFrame:
    """Area of each named set of classes."""
    return pixels.groupBy(*by).agg(*(F.count_if(F.col("value").isin(*v)).cast("double").alias(k) for k, v in classes.items())).withColumns({k: F.col(k) * cell_area for k in classes})


def band_stats(pixels: DataFrame, value: str, *by: str) -> DataFrame:
    """Minimum, maximum, mean, deviation of the population, and percent of values that are valid."""
    return pixels.groupBy(*by).agg(F.min(value).alias("minimum"), F.max(value).alias("maximum"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("stddev"), (F.count(value) * 100.0 / F.count("*")).alias("valid_percent"))


def world_mosaic(points: DataFrame, zoom: int, value: str, expected: DataFrame | None = None) -> DataFrame:
    """`(x, y, value)`: the mean of points (lon, lat) in each pixel of the web map at `zoom`. With `expected` (x, y), a
    pixel of it that no point reaches is an error: an image with holes is refused."""
    from parcelspark.functions.keys import map_tile

    x, y = map_tile(F.col("lon"), F.col("lat"), zoom)
    out = points.groupBy(x.alias("x"), y.alias("y")).agg(F.avg(value).alias("value"))
    if expected is not None and (hole := expected.select("x", "y").join(out, ["x", "y"], "left_anti").take(1)):
        raise ValueError(f"no value at pixel {hole[0]['x']}, {hole[0]['y']}")
    return out

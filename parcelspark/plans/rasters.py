"""Pixel tables: zonal statistics, reductions, runs, profiles. `lineitem` rows stand for pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import aggregates, rasters
from parcelspark.plans.base import query
from parcelspark.plans.view import table

_PIXELS = """(SELECT l_linenumber AS tile, l_orderkey % 256 AS row, l_partkey % 256 AS col, l_suppkey AS label,
cast(l_quantity as bigint) AS value, cast(round(l_tax * 100) as bigint) AS tax FROM lineitem)"""


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        c("l_linenumber").alias("tile"), (c("l_orderkey") % 256).alias("row"), (c("l_partkey") % 256).alias("col"), c("l_suppkey").alias("label"),
        c("l_quantity").cast("long").alias("value"), F.round(c("l_tax") * 100).cast("long").alias("tax"),
    )


@query(f"SELECT tile, label, count(*) AS n, cast(floor(avg(value) * 1000) as bigint) AS value_milli, cast(sum(tax) as bigint) AS tax FROM {_PIXELS} GROUP BY tile, label")
def label_zonal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = rasters.zonal_means(_pixels(spark, sf_dir), ["value"], "tile", "label", more=[F.sum("tax").alias("tax")])
    return means.select("tile", "label", "n", F.floor(F.col("value") * 1000).cast("long").alias("value_milli"), "tax")


@query(f"SELECT tile, row // 4 AS row, col // 4 AS col, bool_or(value > 48) AS hit FROM {_PIXELS} GROUP BY ALL")
def block_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.reduce_any(_pixels(spark, sf_dir), 4, F.col("value") > 48, "tile")


@query(f"SELECT tile, row // 8 AS row, col // 8 AS col, cast(floor(avg(value) + 0.5) as bigint) AS value FROM {_PIXELS} GROUP BY ALL")
def pyramid_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.reduce_mean(_pixels(spark, sf_dir), 8, "value", "tile")


@query(f"SELECT tile, cast(round(avg(CASE WHEN value > 25 THEN 1 ELSE 0 END) * 1000000) as bigint) AS share_ppm FROM {_PIXELS} GROUP BY tile")
def threshold_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.share_above(_pixels(spark, sf_dir), "value", 25, "tile").select("tile", F.round(F.col("share") * 1_000_000).cast("long").alias("share_ppm"))


@query(f"SELECT row, col, max(value) AS value FROM {_PIXELS} GROUP BY row, col")
def mosaic_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.mosaic(_pixels(spark, sf_dir), "max", "row", "col")


_DEDUP = f"(SELECT tile, row, col, max(value) AS value FROM {_PIXELS} GROUP BY ALL)"


@query(f"""SELECT count(*) AS n, max(d) AS largest, cast(round(avg(d) * 10000) as bigint) AS mean_e4, cast(round(avg(CASE WHEN d > 1 THEN 1 ELSE 0 END) * 1000000) as bigint) AS over1_ppm,
cast(round(avg(CASE WHEN d > 4 THEN 1 ELSE 0 END) * 1000000) as bigint) AS over4_ppm FROM (SELECT abs(a.value - b.value) AS d FROM {_DEDUP} a JOIN {_DEDUP} b ON a.row = b.row AND a.col = b.col WHERE a.tile = 1 AND b.tile = 2)""")
def raster_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = _pixels(spark, sf_dir).groupBy("tile", "row", "col").agg(F.max("value").alias("value"))
    d = rasters.difference(px.where("tile = 1"), px.where("tile = 2"), ["row", "col"], "value")
    ppm = lambda c, k: F.round(F.col(c) * k).cast("long")
    return d.select("n", "largest", ppm("mean", 10_000).alias("mean_e4"), ppm("over1", 1_000_000).alias("over1_ppm"), ppm("over4", 1_000_000).alias("over4_ppm"))


@query("""SELECT user_id, coalesce(max(n), 0) AS longest FROM (SELECT user_id, count(*) FILTER (WHERE f) AS n FROM (SELECT user_id, f, sum(CASE WHEN f THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island
FROM (SELECT user_id, event_id, event_type IN ('click', 'view') AS f FROM events)) GROUP BY user_id, island) GROUP BY user_id""")
def longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.longest_run(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], F.col("event_type").isin("click", "view"))


_VALUES = "(SELECT user_id, event_id, event_type, cast(round(value * 100) as bigint) AS v FROM events)"


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("v"))


@query(f"SELECT user_id, event_id, abs(v - lag(v) OVER (PARTITION BY user_id ORDER BY event_id)) AS step FROM {_VALUES}")
def step_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.step_profile(_values(spark, sf_dir), ["user_id"], ["event_id"], "v").select("user_id", "event_id", "step")


@query(f"""SELECT user_id, event_id, n_valid, CASE WHEN n_valid >= 8 THEN cast(floor(s / n_valid) as bigint) END AS mean FROM (SELECT user_id, event_id, count(v) OVER w AS n_valid, sum(v) OVER w AS s
FROM (SELECT user_id, event_id, CASE WHEN event_type <> 'view' THEN v END AS v FROM {_VALUES}) WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING))""")
def moving_mean_min_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = _values(spark, sf_dir).withColumn("v", F.when(F.col("event_type") != "view", F.col("v")))
    return rasters.moving_mean(gaps, ["user_id"], ["event_id"], "v", 15, 8).select("user_id", "event_id", "n_valid", F.floor("mean").cast("long").alias("mean"))


@query(f"SELECT user_id, event_id, v - lag(v, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AS delta FROM {_VALUES}")
def delta_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    before = F.lag("v", 1, 0).over(Window.partitionBy("user_id").orderBy("event_id"))
    return _values(spark, sf_dir).select("user_id", "event_id", (F.col("v") - before).alias("delta"))


@query(f"SELECT user_id, event_id, v FROM {_VALUES}")
def delta_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded to steps and decoded by a running sum: the values again."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    return delta_encode(spark, sf_dir).select("user_id", "event_id", F.sum("delta").over(w).alias("v"))


@query("""SELECT share, min(v) AS value FROM (SELECT v, sum(n) OVER (ORDER BY v) AS upto, sum(n) OVER () AS total FROM (SELECT p_size AS v, count(*) AS n FROM part GROUP BY p_size)),
(VALUES (cast(0.5 as double)), (cast(0.9 as double)), (cast(0.99 as double))) q(share) WHERE upto >= share * total GROUP BY share""")
def histogram_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.histogram_percentiles(table(spark, sf_dir, "part"), "p_size", [0.5, 0.9, 0.99])

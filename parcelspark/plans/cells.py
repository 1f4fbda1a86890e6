"""Grid cells, map tiles, keys and other derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions import keys
from parcelspark.operators import aggregates, predicates
from parcelspark.plans.base import query
from parcelspark.plans.view import SQL, parcels, table

FINE, COARSE = 40, 160
_CELLS = f"(SELECT cast(floor((x0 + x1) / 2 / {FINE}) as bigint) AS cell_x, cast(floor((y0 + y1) / 2 / {FINE}) as bigint) AS cell_y, count(*) AS n, cast(sum(area) as bigint) AS area, cast(sum(score) as bigint) AS score_sum FROM {SQL} GROUP BY ALL)"
_UP = f"(SELECT cast(floor((cell_x * {FINE} + {FINE // 2}) / {COARSE}) as bigint) AS cell_x, cast(floor((cell_y * {FINE} + {FINE // 2}) / {COARSE}) as bigint) AS cell_y, cast(sum(n) as bigint) AS n, cast(sum(area) as bigint) AS area, cast(sum(score_sum) as bigint) AS score_sum FROM {_CELLS} GROUP BY ALL)"


def _cells(spark: SparkSession, sf_dir: str, rows: str = "true") -> DataFrame:
    df = parcels(spark, sf_dir).where(rows).withColumn("cx", (F.col("x0") + F.col("x1")) / 2).withColumn("cy", (F.col("y0") + F.col("y1")) / 2)
    return aggregates.cell_aggregate(df, FINE)


@query(f"SELECT * FROM {_CELLS}")
def cell_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir)


@query(f"SELECT * FROM {_UP}")
def cell_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.cell_rollup(_cells(spark, sf_dir), FINE, COARSE)


@query(f"SELECT cell_x, cell_y, n, cast(n * 1000 // 1600 as bigint) AS density_milli, cast(floor(score_sum * 100 / n) as bigint) AS score_centi, cast(least(100, floor(area * 100 / 3000000000.0)) as bigint) AS pct FROM {_CELLS}")
def cell_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = aggregates.cell_metrics(_cells(spark, sf_dir), 1600.0, area_unit=1600.0 / 3_000_000_000.0)
    floor = lambda c, k: F.floor(F.col(c) * k + 1e-9).cast("long")
    return m.select("cell_x", "cell_y", "n", floor("density", 1000).alias("density_milli"), floor("avg_score", 100).alias("score_centi"), floor("pct_covered", 1).alias("pct"))


_OLD = _CELLS.replace(f"FROM {SQL} GROUP", f"FROM {SQL} WHERE status <> 'P' GROUP")


@query(f"""WITH old AS (SELECT cell_x, cell_y, n FROM {_OLD})
SELECT count(*) AS cells, count(*) FILTER (WHERE o.n IS NULL) AS unmatched, count(*) FILTER (WHERE o.n <> g.n) AS differing, cast(max(abs(o.n - g.n)) as bigint) AS largest FROM {_CELLS} g LEFT JOIN old o USING (cell_x, cell_y)""")
def cell_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new aggregation against an earlier one (of the rows that were there then)."""
    old = _cells(spark, sf_dir, "status <> 'P'").select("cell_x", "cell_y", F.col("n").alias("o"))
    j = _cells(spark, sf_dir).join(old, ["cell_x", "cell_y"], "left")
    return j.agg(F.count("*").alias("cells"), F.count_if(F.col("o").isNull()).alias("unmatched"), F.count_if(F.col("o") != F.col("n")).alias("differing"), F.max(F.abs(F.col("o") - F.col("n"))).alias("largest"))


@query(f"SELECT id, cast(floor(((id % 36000) / 100.0 - 180 + 180) / 360 * 1024) as int) AS tx, id % 36000 AS lon_centi FROM {SQL}")
def webmercator_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, _ = keys.map_tile((F.col("id") % 36000) / F.lit(100.0) - 180, F.lit(0.0), 10)
    return parcels(spark, sf_dir).select("id", x.alias("tx"), (F.col("id") % 36000).alias("lon_centi"))


@query(f"SELECT id, cast(floor((1 - asinh(tan(radians((id % 1600) / 10.0 - 80.05))) / pi()) / 2 * 1024) as int) AS ty FROM {SQL}")
def webmercator_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, y = keys.map_tile(F.lit(0.0), (F.col("id") % 1600) / F.lit(10.0) - 80.05, 10)
    return parcels(spark, sf_dir).select("id", y.alias("ty"))


@query(f"SELECT id, substr(tile_key, 1, 2) AS zone, substr(tile_key, 3, 1) >= 'N' AS north, 32600 + cast(substr(tile_key, 1, 2) as int) AS epsg, regexp_matches(tile_key, '^[0-9]{{2}}[A-Z]{{3}}_[0-9]+_[0-9]+$') AS valid FROM {SQL}")
def tile_key_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("tile_key")
    return parcels(spark, sf_dir).select("id", keys.zone_of(k).alias("zone"), keys.is_north(k).alias("north"), keys.utm_epsg(k).alias("epsg"), keys.is_tile_key(k).alias("valid"))


_XY = "(SELECT o_orderkey AS id, o_orderkey % 64 AS x, cast(floor(o_orderkey / 64) as bigint) % 64 AS y FROM orders)"


def _hilbert_sql(order: int) -> str:
    """The same walk, one nested select for each level."""
    inner = f"SELECT id, x, y, cast(0 as bigint) AS d, x AS hx, y AS hy FROM {_XY}"
    for i in reversed(range(order)):
        s = 1 << i
        bits = f"SELECT id, x, y, d, hx % {s} AS lx, hy % {s} AS ly, CASE WHEN (hx & {s}) > 0 THEN 1 ELSE 0 END AS rx, CASE WHEN (hy & {s}) > 0 THEN 1 ELSE 0 END AS ry FROM ({inner})"
        inner = f"""SELECT id, x, y, d + {s * s} * xor(3 * rx, ry) AS d, CASE WHEN ry = 1 THEN lx WHEN rx = 1 THEN {s - 1} - ly ELSE ly END AS hx,
CASE WHEN ry = 1 THEN ly WHEN rx = 1 THEN {s - 1} - lx ELSE lx END AS hy FROM ({bits})"""
    return f"SELECT id, x, y, cast(d as bigint) AS d FROM ({inner})"


@query(_hilbert_sql(6))
def hilbert_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    xy = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 64).alias("x"), (F.floor(F.col("o_orderkey") / 64) % 64).alias("y"))
    return xy.select("id", "x", "y", keys.hilbert(F.col("x"), F.col("y"), 6).alias("d"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'a' WHEN p_size < 25 THEN 'b' WHEN p_size < 40 THEN 'c' ELSE 'd' END AS class FROM part")
def step_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", predicates.step_class(F.col("p_size"), [10, 25, 40], ["a", "b", "c", "d"]).alias("class"))


@query("SELECT p_partkey, CASE WHEN p_size * 40000 > 1200000 THEN 'large' WHEN p_size * 40000 > 400000 THEN 'medium' ELSE 'small' END AS tier FROM part")
def tier_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.col("p_size") * 40_000
    return table(spark, sf_dir, "part").select("p_partkey", F.when(rows > 1_200_000, "large").when(rows > 400_000, "medium").otherwise("small").alias("tier"))


_CRC = "(SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) x(i)))"


@query(f"""SELECT cast(xor(crc, 4294967295) % 8 as int) AS shard, count(DISTINCT tile_key) AS tiles, count(*) AS rows FROM (SELECT tile_key,
list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(tile_key, ''), lambda x: ascii(x)::bigint)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)) AS crc FROM {SQL}, {_CRC}) GROUP BY shard""")
def hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shard = predicates.hash_shard(F.col("tile_key"), 8)
    return parcels(spark, sf_dir).groupBy(shard.alias("shard")).agg(F.count_distinct("tile_key").alias("tiles"), F.count("*").alias("rows"))


@query(f"SELECT tile_key, count(*) AS n, cast(sum(area) as bigint) AS area FROM {SQL} GROUP BY tile_key ORDER BY area DESC, tile_key LIMIT 10")
def topk_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parcels(spark, sf_dir).groupBy("tile_key").agg(F.count("*").alias("n"), F.sum("area").alias("area")).orderBy(F.desc("area"), "tile_key").limit(10)


@query(f"SELECT id, zone FROM (SELECT id, zone, row_number() OVER (PARTITION BY zone ORDER BY id) AS r FROM {SQL}) WHERE r % 10 = 1")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    r = F.row_number().over(Window.partitionBy("zone").orderBy("id"))
    return parcels(spark, sf_dir).withColumn("r", r).where("r % 10 = 1").select("id", "zone")


@query("SELECT o_orderkey AS id, cast(make_timestamp(year(o_orderdate), quarter(o_orderdate) * 3 - 2, 1, 0, 0, 0) as timestamp) AS starts FROM orders")
def quarter_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), keys.quarter_start(F.year(d), F.quarter(d)).alias("starts"))

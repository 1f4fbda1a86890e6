"""Merging tiles into zones: retention, attributes, totals, completeness, incremental state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import aggregates, incremental, joins, predicates
from parcelspark.plans.base import query
from parcelspark.plans.view import SQL, parcels, table

MAX_AREA, MAX_WATER = 20_000_000, 70
_KEEP = f"in_utm_zone AND in_mgrs_square AND area <= {MAX_AREA} AND coalesce(frac_water, 0) < {MAX_WATER}"
_AUX = "(SELECT o_orderkey AS id, cast(o_orderkey % 17 as bigint) AS patch_mean FROM orders WHERE o_orderstatus = 'F')"


def _aux(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.expr("cast(o_orderkey % 17 as bigint)").alias("patch_mean"))


@query(f"SELECT id, zone, tile_key, area, frac_water FROM {SQL} WHERE {_KEEP}")
def keep_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parcels(spark, sf_dir).where(predicates.retention(MAX_AREA, MAX_WATER)).select("id", "zone", "tile_key", "area", "frac_water")


@query(f"""SELECT count(*) AS n_in, count(*) FILTER (WHERE {_KEEP}) AS n_out, cast(sum(area) as bigint) AS area_in,
cast(sum(CASE WHEN {_KEEP} THEN area END) as bigint) AS area_out FROM {SQL}""")
def keep_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.totals(parcels(spark, sf_dir), predicates.retention(MAX_AREA, MAX_WATER), "area")


@query(f"""SELECT zone, count(*) AS n_in, count(*) FILTER (WHERE {_KEEP}) AS n_out, cast(sum(area) as bigint) AS area_in,
cast(sum(CASE WHEN {_KEEP} THEN area END) as bigint) AS area_out, max(area) AS largest,
count(*) FILTER (WHERE area > 30000000) AS over_cap FROM {SQL} GROUP BY zone""")
def zone_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = [F.max("area").alias("largest"), F.count_if(F.col("area") > 30_000_000).alias("over_cap")]
    return aggregates.totals(parcels(spark, sf_dir), predicates.retention(MAX_AREA, MAX_WATER), "area", "zone", more=more)


@query(f"""SELECT zone, count(*) AS parcels, cast(sum(area) as bigint) AS area, count(patch_mean) AS with_patch,
cast(sum(patch_mean) as bigint) AS patch_sum FROM (SELECT * FROM {SQL} WHERE {_KEEP}) LEFT JOIN {_AUX} USING (id) GROUP BY zone""")
def merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = parcels(spark, sf_dir).where(predicates.retention(MAX_AREA, MAX_WATER))
    joined = joins.join_attributes(kept, _aux(spark, sf_dir), ["id"])
    return joined.groupBy("zone").agg(F.count("*").alias("parcels"), F.sum("area").alias("area"), F.count("patch_mean").alias("with_patch"), F.sum("patch_mean").alias("patch_sum"))


@query(f"SELECT p.id, p.tile_key, a.patch_mean FROM {SQL} p LEFT JOIN {_AUX} a USING (id)")
def left_join_aux_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_attributes(parcels(spark, sf_dir).select("id", "tile_key"), _aux(spark, sf_dir), ["id"])


@query("SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS is_unique FROM lineitem")
def aux_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.unique_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("""SELECT (SELECT count(*) FROM orders) AS before, count(*) AS after, count(*) > (SELECT count(*) FROM orders) AS grew
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def fanout_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    after = orders.select("o_orderkey").join(items.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left").agg(F.count("*").alias("after"))
    before = orders.agg(F.count("*").alias("before"))
    return before.crossJoin(F.broadcast(after)).withColumn("grew", F.col("after") > F.col("before"))


@query(f"""SELECT tile_key, status FROM (SELECT DISTINCT tile_key, 'missing' AS status FROM {SQL} WHERE year = 1996 AND tile_key NOT IN (SELECT tile_key FROM {SQL} WHERE year = 1995)
UNION ALL SELECT DISTINCT tile_key, 'unexpected' AS status FROM {SQL} WHERE year = 1995 AND tile_key NOT IN (SELECT tile_key FROM {SQL} WHERE year = 1996))""")
def set_diff_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir)
    return joins.set_difference(df.where("year = 1995"), df.where("year = 1996"), "tile_key")


@query(f"SELECT id, zone, CASE WHEN zone = '07' THEN area + 1 ELSE area END AS area FROM {SQL}")
def partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = parcels(spark, sf_dir).select("id", "zone", "area")
    return joins.upsert_partition(main, main.where("zone = '07'").withColumn("area", F.col("area") + 1), "zone")


@query(f"SELECT p.id, coalesce(a.patch_mean, p.score) AS score FROM {SQL} p LEFT JOIN {_AUX} a USING (id)")
def join_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = _aux(spark, sf_dir).withColumnRenamed("patch_mean", "score")
    return joins.override(parcels(spark, sf_dir).select("id", "score"), by, "id", ["score"])


@query(f"""SELECT zone, count(*) AS n, cast(sum(size) as bigint) AS size FROM (SELECT zone, o_n, size FROM (SELECT zone, id AS o_n, area % 1000 AS size FROM {SQL})) GROUP BY zone""")
def footer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parcels(spark, sf_dir).groupBy("zone").agg(F.count("*").alias("n"), F.sum(F.expr("area % 1000")).alias("size"))


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parcels(spark, sf_dir).groupBy("zone", "tile_key").agg(F.count("*").alias("size"), F.max("id").alias("modified")).withColumnRenamed("tile_key", "name")


_PRINT = f"""(SELECT zone, sha256('area <= 5' || chr(10) || string_agg(line, chr(10) ORDER BY line)) AS fingerprint FROM
(SELECT zone, concat_ws(';', tile_key, cast(count(*) as string), cast(max(id) as string)) AS line FROM {SQL} GROUP BY zone, tile_key) GROUP BY zone)"""


@query(f"SELECT * FROM {_PRINT}")
def zone_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.fingerprints(_inputs(spark, sf_dir), "zone", "area <= 5")


@query(f"SELECT zone, fingerprint FROM {_PRINT} WHERE zone < '16'")
def stale_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = incremental.fingerprints(_inputs(spark, sf_dir), "zone", "area <= 5")
    state = now.withColumn("fingerprint", F.when(F.col("zone") < "16", F.lit("old")).otherwise(F.col("fingerprint")))
    return incremental.stale(now, state, "zone")


@query(f"""SELECT zone, CASE WHEN zone < '16' THEN n ELSE n + 1 END AS n, zone >= '16' AS skipped FROM (SELECT zone, count(*) AS n FROM {SQL} GROUP BY zone)""")
def carried_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = parcels(spark, sf_dir).groupBy("zone").agg(F.count("*").alias("n"))
    state = counts.withColumn("n", F.col("n") + 1)
    return incremental.carried(counts, state, counts.where("zone < '16'"), "zone", ["n"])


@query(f"""WITH z AS (SELECT DISTINCT zone, cast(zone as int) AS n FROM {SQL}) SELECT a.zone, b.n AS beside FROM z a JOIN z b
ON (b.n = a.n % 60 + 1 OR b.n = (a.n + 58) % 60 + 1) WHERE a.n >= 16 AND b.n < 16""")
def mixed_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = parcels(spark, sf_dir).select("zone").distinct()
    return incremental.mixed_neighbours(zones.withColumn("skipped", F.col("zone").cast("int") >= 16))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.latest(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), "user_id", "event_id")


@query("SELECT o_orderkey AS id, cast(least(100, greatest(0, o_orderkey % 250 - 50)) as smallint) AS score FROM orders")
def score_quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = (F.col("o_orderkey") % 250 - 50).cast("decimal(10,2)") / F.lit(100)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), predicates.quantised_score(share).alias("score"))

"""Indexes, manifests, catalogue documents, quality gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import aggregates
from parcelspark.plans.base import query
from parcelspark.plans.view import SQL, parcels, table

_QUARTERS = ["Q1", "Q2", "Q3", "Q4"]


@query(f"""SELECT year, tile_key, array_to_string(list_sort(list(DISTINCT quarter)), ',') AS members, count(DISTINCT quarter) = 4 AS complete FROM {SQL} GROUP BY year, tile_key""")
def complete_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.complete_sets(parcels(spark, sf_dir), ["year", "tile_key"], "quarter", _QUARTERS)


@query(f"SELECT tile_key, {', '.join(f'max(CASE WHEN quarter = {q!r} THEN area END) AS {q}' for q in _QUARTERS)} FROM {SQL} GROUP BY tile_key")
def band_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.pivot_values(parcels(spark, sf_dir), ["tile_key"], "quarter", _QUARTERS, F.col("area"))


@query(f"""SELECT year, count(*) AS n, cast(sum(area) as bigint) AS area, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1,
array_to_string(list_sort(list(DISTINCT zone)), ',') AS zones, min(tile_key) AS first_tile FROM {SQL} GROUP BY year""")
def year_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parcels(spark, sf_dir).groupBy("year").agg(
        F.count("*").alias("n"), F.sum("area").alias("area"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.array_join(F.array_sort(F.collect_set("zone")), ",").alias("zones"), F.min("tile_key").alias("first_tile"),
    )


@query(f"SELECT year, zone, count(*) AS n_parcels, cast(sum(area) as bigint) AS area, min(x0) AS xmin, min(y0) AS ymin, max(x1) AS xmax, max(y1) AS ymax, 'data/year=' || year || '/zone=' || zone AS href FROM {SQL} GROUP BY year, zone")
def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parcelspark.functions.keys import hive_path

    out = parcels(spark, sf_dir).groupBy("year", "zone").agg(F.count("*").alias("n_parcels"), F.sum("area").alias("area"), F.min("x0").alias("xmin"), F.min("y0").alias("ymin"), F.max("x1").alias("xmax"), F.max("y1").alias("ymax"))
    return out.withColumn("href", hive_path("data", F.col("year"), F.col("zone")))


@query(f"SELECT DISTINCT tile_key, zone FROM {SQL} WHERE year = 1995 AND x0 <= 2000 AND x1 >= 500 AND y0 <= 300 AND y1 >= 20")
def tiles_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir).where("year = 1995 AND x0 <= 2000 AND x1 >= 500 AND y0 <= 300 AND y1 >= 20")
    return df.select("tile_key", "zone").distinct()


@query(f"""SELECT zone, string_agg(square || '=' || tiles, ';' ORDER BY square) AS groups FROM (SELECT zone, square, string_agg(tile_key, ',' ORDER BY tile_key) AS tiles FROM (SELECT DISTINCT zone, square, tile_key FROM {SQL}) GROUP BY zone, square) GROUP BY zone""")
def browse_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = parcels(spark, sf_dir).groupBy("zone", "square").agg(F.array_join(F.array_sort(F.collect_set("tile_key")), ",").alias("tiles"))
    groups = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("square", "tiles"))), lambda g: F.concat(g["square"], F.lit("="), g["tiles"])), ";")
    return level.groupBy("zone").agg(groups.alias("groups"))


@query("SELECT page_id, regexp_replace(url, '^https?://([^/]+)/', 's3://store/\\1/') AS href FROM pages")
def href_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^https?://([^/]+)/", "s3://store/$1/").alias("href"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE regexp_matches(url, '^https?://[^/]+/')) AS matching FROM pages")
def regex_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").agg(F.count("*").alias("n"), F.count_if(F.col("url").rlike("^https?://[^/]+/")).alias("matching"))


@query("""SELECT event_type, count(*) AS n FROM events WHERE regexp_extract(props, '"([a-z_]+)"', 1) <> '' GROUP BY event_type""")
def extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "events").where(F.regexp_extract("props", '"([a-z_]+)"', 1) != "")
    return found.groupBy("event_type").agg(F.count("*").alias("n"))


_FLAGGED = """(SELECT event_id, concat_ws(',', CASE WHEN value > 90 THEN 'high' END, CASE WHEN event_type = 'error' THEN 'error' END, CASE WHEN event_id % 10 = 0 THEN 'tenth' END, CASE WHEN user_id % 2 = 0 THEN 'even' END) AS flags FROM events)"""


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "events").select("event_id", aggregates.flags(high=c("value") > 90, error=c("event_type") == "error", tenth=c("event_id") % 10 == 0, even=c("user_id") % 2 == 0).alias("flags"))


@query(f"SELECT event_id, flags FROM {_FLAGGED}")
def gate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir)


@query(f"SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM {_FLAGGED} WHERE length(flags) > 0) GROUP BY flag")
def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.flag_counts(_flagged(spark, sf_dir), "flags")


@query("""SELECT p_partkey, CASE WHEN r < 0.05 OR r > 10 THEN 'size' WHEN r < 0.2 OR r > 1.8 THEN 'size_warn' END AS size_flag FROM (SELECT p_partkey, p_size / (SELECT median(p_size) FROM part) AS r FROM part)""")
def size_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.size_outliers(table(spark, sf_dir, "part"), "p_size", warn=(0.2, 1.8)).select("p_partkey", "size_flag")


@query("SELECT p_type, cast(floor(quantile_cont(p_size, 0.5) * 100) as bigint) AS p50, cast(floor(quantile_cont(p_size, 0.9) * 100 + 0.001) as bigint) AS p90 FROM part GROUP BY p_type")
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = aggregates.exact_quantiles(table(spark, sf_dir, "part"), "p_size", [0.5, 0.9], ("p_type",), continuous=True)
    at = lambda s, e: F.max(F.when(F.col("share") == s, F.floor(F.col("value") * 100 + e))).cast("long")
    return q.groupBy("p_type").agg(at(0.5, 0.0).alias("p50"), at(0.9, 0.001).alias("p90"))


@query("SELECT p_type, cast(median(p_size) * 2 as bigint) AS twice_median, quantile_disc(p_size, 0.5) AS lower_median FROM part GROUP BY p_type")
def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    middle = aggregates.exact_quantiles(part, "p_size", [0.5], ("p_type",), continuous=True).select("p_type", (F.col("value") * 2).cast("long").alias("twice_median"))
    lower = aggregates.exact_quantiles(part, "p_size", [0.5], ("p_type",)).select("p_type", F.col("value").cast("int").alias("lower_median"))
    return middle.join(lower, "p_type")


@query("""SELECT p_type, p_brand AS mode_brand, n FROM (SELECT p_type, p_brand, count(*) AS n, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS r FROM part GROUP BY p_type, p_brand) WHERE r = 1""")
def mode_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))
    best = F.min_by(F.struct("p_brand", "n"), F.struct(-F.col("n"), "p_brand")).alias("b")
    return counts.groupBy("p_type").agg(best).select("p_type", F.col("b.p_brand").alias("mode_brand"), F.col("b.n").alias("n"))


@query(f"""WITH o AS (SELECT zone, count(*) AS n FROM {SQL} WHERE year = 1995 GROUP BY zone), w AS (SELECT zone, count(*) AS n FROM {SQL} WHERE year = 1996 GROUP BY zone)
SELECT zone, w.n AS new, o.n AS old, CASE WHEN o.n IS NULL THEN 'added' WHEN w.n IS NULL THEN 'gone' WHEN abs(w.n - o.n) / o.n > 0.15 THEN 'moved' ELSE 'same' END AS status FROM w FULL JOIN o USING (zone)""")
def zones_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir)
    count = lambda y: df.where(F.col("year") == y).groupBy("zone").agg(F.count("*").alias("n"))
    return aggregates.relative_change(count(1996), count(1995), "zone", "n", 0.15)


@query(f"""SELECT tile_key, near, far, near * 3 < far AS cut FROM (SELECT tile_key, count(*) FILTER (WHERE y1 > 4000) AS near, count(*) FILTER (WHERE y1 BETWEEN 1000 AND 3000) AS far FROM {SQL} GROUP BY tile_key)""")
def north_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.col("y1")
    out = parcels(spark, sf_dir).groupBy("tile_key").agg(F.count_if(y > 4000).alias("near"), F.count_if(y.between(1000, 3000)).alias("far"))
    return out.withColumn("cut", F.col("near") * 3 < F.col("far"))


@query(f"""SELECT count(*) AS n, count(*) - count(DISTINCT id) AS dup_ids, count(*) FILTER (WHERE area > 30000000) AS over_cap, bool_and(area > 0) AS all_positive,
count(*) FILTER (WHERE score < 0 OR score > 100) AS bad_score, count(*) FILTER (WHERE id IS NULL) AS null_ids FROM {SQL}""")
def qa_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of a release in one pass."""
    from parcelspark.operators.predicates import all_positive

    c = F.col
    return parcels(spark, sf_dir).agg(
        F.count("*").alias("n"), (F.count("*") - F.count_distinct("id")).alias("dup_ids"), F.count_if(c("area") > 30_000_000).alias("over_cap"), all_positive(c("area")).alias("all_positive"),
        F.count_if((c("score") < 0) | (c("score") > 100)).alias("bad_score"), F.count_if(c("id").isNull()).alias("null_ids"),
    )


_ITEM = "'{{\"id\":\"' || {id} || '\",\"bbox\":[' || x0 || ',' || y0 || ',' || x1 || ',' || y1 || '],\"properties\":{{\"n\":' || n || '}}}}'"


@query(f"SELECT zone, {_ITEM.format(id='zone')} AS item FROM (SELECT zone, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n FROM {SQL} GROUP BY zone)")
def catalogue_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = aggregates.extents(parcels(spark, sf_dir), "zone", more=[F.count("*").alias("n")])
    return e.select("zone", F.to_json(F.struct(F.col("zone").alias("id"), F.array("x0", "y0", "x1", "y1").alias("bbox"), F.struct("n").alias("properties"))).alias("item"))


@query(f"""SELECT year, count(*) AS tiles, cast(floor(avg(n) * 1000) as bigint) AS mean_milli, quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.99) AS p99, max(n) AS largest
FROM (SELECT year, tile_key, count(*) AS n FROM {SQL} GROUP BY year, tile_key) GROUP BY year""")
def tile_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = parcels(spark, sf_dir).groupBy("year", "tile_key").agg(F.count("*").alias("n"))
    disc = lambda q: F.expr(f"cast(percentile_disc({q}) WITHIN GROUP (ORDER BY n) as bigint)")
    return n.groupBy("year").agg(F.count("*").alias("tiles"), F.floor(F.avg("n") * 1000).cast("long").alias("mean_milli"), disc(0.5).alias("p50"), disc(0.99).alias("p99"), F.max("n").alias("largest"))


@query(f"""SELECT year, count(*) AS rows, count(DISTINCT status) AS specs, array_to_string(list_sort(list(DISTINCT status)), ',') AS spec_list, count(*) FILTER (WHERE frac_water IS NULL) AS unrecorded,
count(DISTINCT status) = 1 AND count(*) FILTER (WHERE frac_water IS NULL) = 0 AS uniform FROM {SQL} GROUP BY year""")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which methods a year's rows come from, and how many do not say."""
    out = parcels(spark, sf_dir).groupBy("year").agg(F.count("*").alias("rows"), F.array_sort(F.collect_set("status")).alias("s"), F.count_if(F.col("frac_water").isNull()).alias("unrecorded"))
    specs = F.size("s").cast("long")
    return out.select("year", "rows", specs.alias("specs"), F.array_join("s", ",").alias("spec_list"), "unrecorded", ((specs == 1) & (F.col("unrecorded") == 0)).alias("uniform"))


@query(f"""SELECT n.tile_key, n.score, h.twice_median, h.twice_median > 10 AND 4 * n.score < h.twice_median AS dropped FROM (SELECT tile_key, max(score) AS score FROM {SQL} WHERE year = 1998 GROUP BY tile_key) n
LEFT JOIN (SELECT tile_key, cast(median(score) * 2 as bigint) AS twice_median FROM {SQL} WHERE year < 1998 GROUP BY tile_key) h USING (tile_key)""")
def history_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles whose figure fell below half their median of earlier years."""
    df = parcels(spark, sf_dir)
    now = df.where("year = 1998").groupBy("tile_key").agg(F.max("score").alias("score"))
    before = df.where("year < 1998").groupBy("tile_key").agg((F.median("score") * 2).cast("long").alias("twice_median"))
    return now.join(before, "tile_key", "left").withColumn("dropped", (F.col("twice_median") > 10) & (4 * F.col("score") < F.col("twice_median")))


@query(f"""SELECT count(*) FILTER (WHERE f <> '') AS flagged, count(DISTINCT k) AS fingerprints, count(*) AS files, count(*) FILTER (WHERE f <> '') = 0 AND count(DISTINCT k) = 1 AS passes
FROM (SELECT CASE WHEN n < 2 THEN 'small' ELSE '' END AS f, zone AS k FROM (SELECT zone, tile_key, count(*) AS n FROM {SQL} WHERE year = 1997 GROUP BY zone, tile_key))""")
def year_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = parcels(spark, sf_dir).where("year = 1997").groupBy("zone", "tile_key").agg(F.count("*").alias("n"))
    rated = tiles.select("zone", aggregates.flags(small=F.col("n") < 2).alias("f"))
    out = rated.agg(F.count_if(F.col("f") != "").alias("flagged"), F.count_distinct("zone").alias("fingerprints"), F.count("*").alias("files"))
    return out.withColumn("passes", (F.col("flagged") == 0) & (F.col("fingerprints") == 1))


@query(f"""SELECT zone, count(*) AS grids, max(n) AS tiles FROM (SELECT zone, column_no, count(DISTINCT tile_key) AS n FROM {SQL} GROUP BY zone, column_no) GROUP BY zone""")
def grid_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = parcels(spark, sf_dir).groupBy("zone", "column_no").agg(F.count_distinct("tile_key").alias("n"))
    return n.groupBy("zone").agg(F.count("*").alias("grids"), F.max("n").alias("tiles"))


@query(f"""SELECT p.year, count(*) AS rows, min(v.vintage) AS vintage FROM {SQL} p JOIN (SELECT y AS year, y - y % 2 AS vintage FROM (SELECT unnest(range(1990, 2030)) AS y)) v USING (year) GROUP BY p.year""")
def vintage_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed table looked up by year; a year that it lacks is an error, not a null."""
    known = F.create_map(*(F.lit(x) for y in range(1990, 2030) for x in (y, y - y % 2)))
    found = F.coalesce(known[F.col("year")], F.raise_error(F.lit("no vintage for the year")).cast("int"))
    return parcels(spark, sf_dir).withColumn("vintage", found).groupBy("year").agg(F.count("*").alias("rows"), F.min("vintage").cast("long").alias("vintage"))

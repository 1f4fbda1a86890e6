"""Checks before publishing, values with fallbacks, edges of zones."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import joins, predicates
from parcelspark.plans import release
from parcelspark.plans.base import query
from parcelspark.plans.files import _LONLAT, _lonlat
from parcelspark.plans.view import SQL, parcels, table
from parcelspark.session import materialise
from parcelspark.sources import vector_tiles


@query("SELECT p_partkey AS key, p_size AS size, CASE WHEN p_partkey % 4 = 0 THEN 'side' || p_partkey WHEN p_partkey % 3 = 0 THEN 'old' || p_partkey END AS digest FROM part")
def trusted_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests from a log beside the objects, else from what was committed, each only where its size is the object's."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    objects = p.select(k.alias("key"), F.col("p_size").alias("size"))
    side = p.where(k % 2 == 0).select(k.alias("key"), (F.col("p_size") + F.when(k % 4 == 0, 0).otherwise(1)).alias("size"), F.concat(F.lit("side"), k.cast("string")).alias("digest"))
    committed = p.select(k.alias("key"), (F.col("p_size") + F.when(k % 3 == 0, 0).otherwise(1)).alias("size"), F.concat(F.lit("old"), k.cast("string")).alias("digest"))
    return joins.trusted(objects, side, committed)


@query(f"SELECT id, CASE WHEN id % 50 = 0 THEN 'cut ' || id ELSE 'whole ' || id END AS outline FROM {SQL}")
def antimeridian_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines with those replaced that a table of fixes has."""
    named = lambda d, word: d.select("id", F.concat(F.lit(word), F.col("id").cast("string")).alias("outline"))
    rows = parcels(spark, sf_dir)
    return joins.override(named(rows, "whole "), named(rows.where("id % 50 = 0"), "cut "), "id", ["outline"])


@query(f"SELECT line, count(*) AS n FROM {_LONLAT}, (VALUES (-120), (0), (6), (120)) v(line) WHERE abs(lon - line) <= 1.25 AND lat BETWEEN -40 AND 60 GROUP BY line")
def near_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points near four meridians, in one pass."""
    lines = (-120, 0, 6, 120)
    counts = _lonlat(spark, sf_dir).agg(*(F.count_if(predicates.near_line(F.col("lon"), F.col("lat"), x, 1.25, -40, 60)).alias(str(i)) for i, x in enumerate(lines)))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(x).alias("line"), F.col(str(i)).alias("n")) for i, x in enumerate(lines)))).alias("r")).select("r.*").where("n > 0")


_NEW, _OLD = f"(SELECT zone, year FROM {SQL} WHERE year > 1992 AND NOT (zone = '05' AND year = 1995) AND NOT (zone = '09' AND id % 2 = 0))", f"(SELECT zone, year FROM {SQL} WHERE year < 1998)"


@query(f"""WITH n AS (SELECT zone, year, count(*) AS n FROM {_NEW} GROUP BY ALL), o AS (SELECT zone, year, count(*) AS n FROM {_OLD} GROUP BY ALL), want AS (SELECT DISTINCT zone FROM {SQL})
SELECT 'zone missing' AS problem, zone, year FROM want, (SELECT DISTINCT year FROM n) WHERE (zone, year) NOT IN (SELECT (zone, year) FROM n)
UNION ALL SELECT 'year gone', NULL, year FROM (SELECT DISTINCT year FROM o) WHERE year NOT IN (SELECT year FROM n)
UNION ALL SELECT 'shrunk', zone, year FROM n JOIN o USING (zone, year) WHERE n.n < o.n""")
def index_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What forbids replacing an index: a zone that a year lacks, a year that is gone, partitions that shrank."""
    rows = parcels(spark, sf_dir)
    new = rows.where("year > 1992 and not (zone = '05' and year = 1995) and not (zone = '09' and id % 2 = 0)")
    return joins.index_problems(new.select("zone", "year"), rows.where("year < 1998").select("zone", "year"), rows.select("zone"))


@query(f"""SELECT place, count(id) AS n, true AS agrees FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) v(place) LEFT JOIN {_LONLAT} ON floor((lon + 180) / 45) = place AND lat BETWEEN 0 AND 66 GROUP BY place""")
def tile_counts_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that decode from the map tiles of eight places, against the rows whose position lies there."""
    points = _lonlat(spark, sf_dir).where("lat between 0 and 66")
    tiles = vector_tiles.tiles_of(points, F.col("lon"), F.col("lat"), 3, ["id"])

    def decode(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("x"), pa.array([len(vector_tiles.tile_features(t)) for t in batch.column("tile").to_pylist()], pa.int64())], ["place", "features"])

    decoded = tiles.mapInArrow(decode, "place int, features long").groupBy("place").agg(F.sum("features").alias("features"))
    rows = points.groupBy(F.floor((F.col("lon") + 180) / 45).cast("int").alias("place")).agg(F.count("*").alias("n"))
    every = spark.range(8).select(F.col("id").cast("int").alias("place"))
    both = every.join(rows, "place", "left").join(decoded, "place", "left").fillna(0, ["n", "features"])
    return both.select("place", "n", (F.col("n") == F.col("features")).alias("agrees"))


@query("SELECT '33UYQ_0_0-' || s_suppkey AS id, 50 AS percent FROM supplier")
def cross_zone_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels on the border of two zones, claimed by the western one, with the half that the eastern one kept: one
    each, under the claimed id, with the mean weighted by area (30 % twice, 90 % once). Each has a place of its own:
    20,000 along the border, then further columns to the east."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.pmod(k, F.lit(20_000)) * F.lit(0.004)).alias("lat"), (F.floor(k / 20_000) * F.lit(0.012)).alias("column"))
    piece = lambda tile, west, east, mean, claimed: F.struct(F.lit(tile).alias("tile_key"), F.lit(west).alias("xmin"), F.lit(east).alias("xmax"), F.lit(mean).alias("pf_mean"), F.lit(claimed).alias("claimed"))
    rows = s.select("s_suppkey", "lat", "column", F.explode(F.array(piece("33UYQ_0_0", 18.01, 18.02, 0.3, True), piece("34UCV_0_0", 18.013, 18.018, 0.9, False))).alias("p")).select(
        F.concat_ws("-", "p.tile_key", k.cast("string")).alias("id"), "p.tile_key", (F.col("p.xmin") + F.col("column")).alias("xmin"), (F.col("p.xmax") + F.col("column")).alias("xmax"), "p.pf_mean", "p.claimed",
        F.col("lat").alias("ymin"), (F.col("lat") + 0.003).alias("ymax"),
    )
    out = release.cross_zone(materialise(release.box_geometry(rows), "border"))
    return out.select("id", F.round(F.col("pf_mean") * 100).cast("int").alias("percent"))


@query("SELECT cast(o_orderkey as varchar) AS id, cast(ceil((100 + o_custkey % 900) / 200.0) + 2 as bigint) AS n, true AS apart FROM orders")
def claim_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points every 200 metres along the row of each parcel's centroid, both ends and the centroid included, and
    whether no two of the row lie further apart (in degrees at 45 north)."""
    west = F.lit(400_000.0) + F.col("o_orderkey") % 1000
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.lit(31).alias("_number"), F.lit(2.0).alias("lon"), F.lit(45.0).alias("lat"), west.alias("west"), (west + 100 + F.col("o_custkey") % 900).alias("east"))
    points = release.row_points(rows)
    step = F.lit(200 / 78_000)
    return points.groupBy("id").agg(F.count("*").alias("n"), ((F.max(F.when(F.col("lon") != 2.0, F.col("lon"))) - F.min(F.when(F.col("lon") != 2.0, F.col("lon")))) <= step * (F.count("*") - 2)).alias("apart"))

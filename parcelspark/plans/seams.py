"""Seams: parcels cut by tile and zone edges, paired on a grid, grouped, merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import aggregates, joins
from parcelspark.operators.graph import connected_components
from parcelspark.plans.base import query
from parcelspark.plans.view import CELL, SQL, parcels

#: Side of a map sheet, and of the cells that sheets' extents and strips are paired by.
SHEET = 300
_MEET = "a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0"
_OVERLAP = "greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0)"
_AREA = "(({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0))"
# the oracle narrows its search by rows of the layout (boxes reach at most two), which keeps it from comparing all pairs
_NEAR = "cast(floor(a.y0 / 10) as bigint) - cast(floor(b.y0 / 10) as bigint) BETWEEN -2 AND 2"
_BANDS = f"(SELECT *, unnest([y0 // 20 - 1, y0 // 20, y0 // 20 + 1]) AS band FROM {SQL})"
_PAIRS = f"(SELECT a.id AS a, b.id AS b, {_OVERLAP} AS overlap FROM {_BANDS} a JOIN {SQL} b ON a.band = b.y0 // 20 AND a.id < b.id AND {_MEET})"
_SEAMS = f"(SELECT a.id AS a, b.id AS b FROM {_BANDS} a JOIN {SQL} b ON a.band = b.y0 // 20 AND a.id < b.id AND {_MEET} WHERE {_OVERLAP} > 0 AND 10 * {_OVERLAP} >= least({_AREA.format('a')}, {_AREA.format('b')}))"


@query(f"SELECT a, b, overlap FROM {_PAIRS}")
def grid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir).select("id", *joins.BOX)
    return joins.self_pairs(df, CELL).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), joins.overlap_area("a", "b").alias("overlap"))


def _seam_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir).select("id", *joins.BOX)
    size = lambda k: (F.col(f"{k}.x1") - F.col(f"{k}.x0")) * (F.col(f"{k}.y1") - F.col(f"{k}.y0"))
    over = joins.overlap_area("a", "b")
    rule = (over > 0) & (10 * over >= F.least(size("a"), size("b")))
    return joins.self_pairs(df, CELL, on=rule).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


@query(f"SELECT a, b FROM {_SEAMS}")
def seam_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seam_pairs(spark, sf_dir)


_COMPONENTS = f"""WITH RECURSIVE e AS (SELECT a, b FROM {_SEAMS} UNION SELECT b, a FROM {_SEAMS}),
r AS (SELECT DISTINCT a AS node, a AS reached FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a),
c AS (SELECT node AS id, min(reached) AS gid FROM r GROUP BY node)"""


@query(f"{_COMPONENTS} SELECT id, gid FROM c")
def seam_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(_seam_pairs(spark, sf_dir), "a", "b").toDF("id", "gid")


@query(f"""{_COMPONENTS} SELECT min(p.id) AS id, count(*) AS members, cast(sum(p.area) as bigint) AS area,
cast(floor(sum(cast(p.score as double) * p.area) / sum(p.area) + 0.5) as bigint) AS score FROM {SQL} p JOIN c USING (id) GROUP BY gid""")
def seam_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = connected_components(_seam_pairs(spark, sf_dir), "a", "b").toDF("id", "gid")
    merged = aggregates.merge_groups(parcels(spark, sf_dir).select("id", "area", "score").join(groups, "id"), "gid", "id", "area", "score")
    return merged.select("id", "members", "area", F.floor(F.col("score") + 0.5).cast("long").alias("score"))


@query(f"SELECT tile_key, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM {SQL} GROUP BY tile_key")
def tile_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.extents(parcels(spark, sf_dir), "tile_key")


_SHEETS = f"(SELECT x0 // 300 AS sheet, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM {SQL} GROUP BY x0 // 300)"
_STRIPS = f"""(SELECT a.sheet AS sa, b.sheet AS sb, greatest(a.x0, b.x0) - 1 AS x0, greatest(a.y0, b.y0) - 1 AS y0, least(a.x1, b.x1) + 1 AS x1, least(a.y1, b.y1) + 1 AS y1
FROM {_SHEETS} a JOIN {_SHEETS} b ON a.sheet < b.sheet AND {_MEET})"""


def _strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded rectangles where the extents of two map sheets overlap: as many as neighbouring sheets."""
    e = aggregates.extents(parcels(spark, sf_dir).withColumn("sheet", F.floor(F.col("x0") / SHEET).cast("long")), "sheet")
    both = joins.self_pairs(e, SHEET, "sheet")
    edge = lambda f, c, d: (f(f"a.{c}", f"b.{c}") + d).alias(c)
    return both.select(F.col("a.sheet").alias("sa"), F.col("b.sheet").alias("sb"), edge(F.greatest, "x0", -1), edge(F.greatest, "y0", -1), edge(F.least, "x1", 1), edge(F.least, "y1", 1))


@query(f"SELECT * FROM {_STRIPS}")
def tile_overlap_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _strips(spark, sf_dir)


_IN = "EXISTS (SELECT 1 FROM s WHERE d.x0 <= s.x1 AND d.x1 >= s.x0 AND d.y0 <= s.y1 AND d.y1 >= s.y0)"


@query(f"WITH s AS {_STRIPS} SELECT id FROM {SQL} d WHERE {_IN}")
def strip_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.in_any_box(parcels(spark, sf_dir), _strips(spark, sf_dir), SHEET).select("id")


@query(f"WITH s AS {_STRIPS} SELECT id FROM {SQL} d WHERE NOT {_IN}")
def strip_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.in_any_box(parcels(spark, sf_dir), _strips(spark, sf_dir), SHEET, keep=False).select("id")


@query(f"WITH s AS (SELECT tile_key AS tk, min(x0) AS x0, min(y0) AS y0, max(x0) AS x1, min(y0) AS y1 FROM {SQL} WHERE status = 'P' GROUP BY tile_key) SELECT id FROM {SQL} d WHERE EXISTS (SELECT 1 FROM s WHERE s.tk = d.tile_key AND d.x0 <= s.x1 AND d.x1 >= s.x0 AND d.y0 <= s.y1 AND d.y1 >= s.y0)")
def tile_box_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir)
    boxes = df.where("status = 'P'").groupBy("tile_key").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x0").alias("x1"), F.min("y0").alias("y1"))
    return joins.in_any_box(df, boxes, CELL, on=["tile_key"]).select("id")


@query(f"SELECT id, id IN (SELECT a FROM {_SEAMS}) AS paired FROM {SQL}")
def twe_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _seam_pairs(spark, sf_dir).select(F.col("a").alias("id"))
    return joins.flag_members(parcels(spark, sf_dir).select("id"), members, "id", "paired")


@query(f"SELECT a.id AS a, b.id AS b FROM {_BANDS} a JOIN {SQL} b ON a.band = b.y0 // 20 AND {_MEET} WHERE cast(b.zone as int) = cast(a.zone as int) % 60 + 1 AND 2 * {_OVERLAP} >= least({_AREA.format('a')}, {_AREA.format('b')})")
def cross_zone_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir).select("id", "zone", *joins.BOX)
    size = lambda k: (F.col(f"{k}.x1") - F.col(f"{k}.x0")) * (F.col(f"{k}.y1") - F.col(f"{k}.y0"))
    rule = (F.col("b.zone").cast("int") == F.col("a.zone").cast("int") % 60 + 1) & (2 * joins.overlap_area("a", "b") >= F.least(size("a"), size("b")))
    return joins.grid_join(df, df, CELL, rule).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


@query(f"SELECT a.id AS a, b.id AS b FROM {_BANDS} a JOIN {SQL} b ON a.band = b.y0 // 20 AND a.id < b.id AND {_MEET} WHERE (a.square >= 'N') <> (b.square >= 'N') AND a.tile_key <> b.tile_key AND 10 * {_OVERLAP} >= least({_AREA.format('a')}, {_AREA.format('b')})")
def equator_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcels(spark, sf_dir).select("id", "tile_key", "square", *joins.BOX)
    size = lambda k: (F.col(f"{k}.x1") - F.col(f"{k}.x0")) * (F.col(f"{k}.y1") - F.col(f"{k}.y0"))
    rule = ((F.col("a.square") >= "N") != (F.col("b.square") >= "N")) & (F.col("a.tile_key") != F.col("b.tile_key")) & (10 * joins.overlap_area("a", "b") >= F.least(size("a"), size("b")))
    return joins.self_pairs(df, CELL, on=rule).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


@query(f"""SELECT count(*) FILTER (WHERE x0 BETWEEN 0 AND 1000) AS s1, count(*) FILTER (WHERE x0 BETWEEN 1000 AND 2000 AND y0 < 200) AS s2,
count(*) FILTER (WHERE y0 BETWEEN 100 AND 150) AS s3, count(*) FILTER (WHERE abs(x0 - 3000) < 50) AS s4 FROM {SQL}""")
def strips_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x0"), F.col("y0")
    return parcels(spark, sf_dir).agg(F.count_if(x.between(0, 1000)).alias("s1"), F.count_if(x.between(1000, 2000) & (y < 200)).alias("s2"), F.count_if(y.between(100, 150)).alias("s3"), F.count_if(F.abs(x - 3000) < 50).alias("s4"))

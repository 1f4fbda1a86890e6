"""The parcel view of the test tables: the same columns, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column expressions that both dialects read alike. Boxes are integers, so no figure drifts.
COLUMNS = {
    "id": "o_orderkey",
    "zone": "lpad(cast(1 + o_custkey % 60 as string), 2, '0')",
    "square": "substr('CDEFGHJKLMNPQRSTUVWX', cast(1 + o_orderkey % 20 as int), 1)",
    "column_no": "cast(o_orderkey % 3 as int)",
    "year": "cast(year(o_orderdate) as int)",
    "quarter": "concat('Q', cast(quarter(o_orderdate) as string))",
    "area": "cast(round(o_totalprice * 100) as bigint)",
    "score": "cast(o_orderkey % 101 as bigint)",
    "frac_water": "case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 97 as bigint) end",
    "in_utm_zone": "o_orderkey % 11 <> 0",
    "in_mgrs_square": "o_orderkey % 13 <> 0",
    "x0": "(o_orderkey % 600) * 10",
    "y0": "(cast(floor(o_orderkey / 600) as bigint) % 500) * 10",
    "x1": "(o_orderkey % 600) * 10 + 1 + cast(floor(o_totalprice) as bigint) % 12",
    "y1": "(cast(floor(o_orderkey / 600) as bigint) % 500) * 10 + 1 + cast(floor(o_totalprice / 7) as bigint) % 12",
    "status": "o_orderstatus",
}
_TILE = "concat(zone, square, 'AA_', cast(column_no as string), '_0')"
SQL = f"(SELECT *, {_TILE} AS tile_key FROM (SELECT {', '.join(f'{e} AS {n}' for n, e in COLUMNS.items())} FROM orders))"
#: What a box's neighbour may lie in: cells of ten units.
CELL = 10


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(*(F.expr(e).alias(n) for n, e in COLUMNS.items())).withColumn("tile_key", F.expr(_TILE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

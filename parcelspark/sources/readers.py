"""Readers: by-name unions, zone trees, file footers, key lists, manifests with contracts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BOX = ("xmin", "ymin", "xmax", "ymax")
_F64 = ("pf_mean", "pb_mean", "frac_nodata_1q", "frac_nodata_3q", "frac_water", "frac_crops_ever", "slope_mean", "frac_slope_gt30", "elev_mean", *_BOX)
#: Columns of an outline tile, and of a released zone file.
TILE = T.StructType(
    [T.StructField("tile_key", T.StringType()), T.StructField("year", T.LongType()), T.StructField("parcel_id", T.LongType()), T.StructField("area_m2", T.DoubleType())]
    + [T.StructField(c, T.LongType()) for c in ("n_parts", "ext_h_px", "ext_w_px")]
    + [T.StructField(c, T.BooleanType()) for c in ("touches_window_edge", "in_utm_zone", "in_mgrs_square", "claimed")]
    + [T.StructField(c, T.DoubleType()) for c in _F64]
    + [T.StructField("geometry", T.BinaryType())]
)
RELEASE = T.StructType(
    [
        T.StructField("id", T.StringType(), False), T.StructField("collection", T.StringType(), False), T.StructField("geometry", T.BinaryType(), False),
        T.StructField("bbox", T.StructType([T.StructField(c, T.DoubleType()) for c in _BOX])), T.StructField("metrics:area", T.FloatType()), T.StructField("metrics:perimeter", T.FloatType()),
        T.StructField("score", T.ShortType()), T.StructField("determination:datetime", T.TimestampType()), T.StructField("determination:method", T.StringType()),
    ]
)


def read_tiles(spark: SparkSession, *paths: str, schema: T.StructType = TILE) -> DataFrame:
    """Tile files of any generation, by column name: a column that a file lacks is null, a column that
    the schema lacks is not read (so Parquet prunes it)."""
    return spark.read.schema(schema).parquet(*paths)


def read_zones(spark: SparkSession, root: str) -> DataFrame:
    """A tree of year=YYYY/zone=NN folders, the zone kept as two digits of text whatever the session infers."""
    df = spark.read.parquet(root)
    return df.withColumn("zone", F.lpad(F.col("zone").cast("string"), 2, "0")).withColumn("year", F.col("year").cast("int"))


def overlapping(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose bounds meet a box; the four comparisons reach the Parquet scan."""
    west, south, east, north = box
    return df.where((F.col("xmin") <= east) & (F.col("xmax") >= west) & (F.col("ymin") <= north) & (F.col("ymax") >= south))


def read_keys(spark: SparkSession, path: str, column: str = "tile_key") -> DataFrame:
    """Distinct keys of a text, CSV or Parquet list."""
    if path.endswith(".parquet"):
        found = spark.read.parquet(path).select(column)
    elif path.endswith(".csv"):
        found = spark.read.option("header", True).csv(path).select(column)
    else:
        found = spark.read.text(path).select(F.trim("value").alias(column)).where(F.length(column) > 0)
    return found.distinct()


def layout(files: DataFrame, path: Column | None = None) -> DataFrame:
    """`(tile_key, path)` of score files in either layout (flat or a folder for each tile), sidecars left out."""
    path = F.col("path") if path is None else path
    key = F.regexp_extract(path, r"(\d{2}[A-Z]{3}_\d+_\d+)[^/]*\.tif$", 1)
    return files.select(key.alias("tile_key"), path.alias("path")).where((F.col("tile_key") != "") & ~path.rlike(r"\.(json|ovr|xml)$"))


def file_listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """`(path, name, size, modified)` of files below a root, from metadata alone."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def by_range(spark: SparkSession, root: str, pattern: str, read: Callable, schema: str) -> DataFrame:
    """Rows of `read(path, file, size)` for each file below a root, opened by executors for random access: no more of
    a file is read than `read` asks for. Files are found by Spark's listing."""
    names = [x.split(" ")[0] for x in schema.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root).select("path", "length")
    kinds = spark.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in kinds.fields]
        for batch in batches:
            rows = []
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, name = pa.fs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as f:
                    rows += read(path, f, size)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return files.mapInArrow(run, schema)


def read_footers(spark: SparkSession, root: str) -> DataFrame:
    """`(path, n_rows, n_row_groups, schema, metadata)` of Parquet files; only their footers are read."""

    def footer(path: str, file, size: int) -> list[tuple]:
        import pyarrow.parquet as pq

        f = pq.ParquetFile(file)
        kv = {k.decode(): v.decode(errors="replace") for k, v in ((f.schema_arrow.metadata or {}) | (f.metadata.metadata or {})).items()}
        return [(path, f.metadata.num_rows, f.metadata.num_row_groups, ",".join(f"{x.name}:{x.type}" for x in f.schema_arrow), json.dumps(kv))]

    return by_range(spark, root, "*.parquet", footer, "path string, n_rows long, n_row_groups int, schema string, metadata string")


def footer_values(footers: DataFrame, *names: str) -> DataFrame:
    """`(path, names...)`: the texts of footer entries, null where a file has none."""
    return footers.select("path", *(F.get_json_object("metadata", f"$['{n}']").alias(n) for n in names))


def checked(df: DataFrame, **rules: Column) -> DataFrame:
    """`df`, failing at the first row that breaks a rule (named in the error)."""
    for name, rule in rules.items():
        df = df.where(F.when(F.coalesce(rule, F.lit(False)), True).otherwise(F.raise_error(F.lit(f"a row breaks the rule {name}"))))
    return df


def read_manifest(spark: SparkSession, path: str, bands: tuple[str, ...] = ("B02", "B03", "B04", "B08")) -> DataFrame:
    """A mirror's manifest, one row for each tile and quarter with a size and link for each band. Item ids
    must name their tile and quarter; a quarter must have every band."""
    raw = spark.read.parquet(path)
    parts = raw.withColumn("tile_key", F.regexp_extract("item_id", r"(\d{2}[A-Z]{3}_\d+_\d+)", 1)).withColumn("named", F.regexp_extract("item_id", r"(Q[1-4])", 1))
    parts = checked(parts, tile=F.col("tile_key") != "", quarter=F.col("named") == F.col("quarter"), band=F.col("band").isin(*bands))
    at = lambda b, c: F.max(F.when(F.col("band") == b, c))
    href = F.concat(F.lit("s3://"), "destination_bucket", F.lit("/"), "destination_key")
    columns = [x for b in bands for x in (at(b, F.col("size_bytes")).alias(f"{b.lower()}_size"), at(b, href).alias(f"{b.lower()}_href"))]
    wide = parts.groupBy("year", "quarter", "tile_key").agg(F.count_distinct("band").alias("_n"), *columns)
    return checked(wide, complete=F.col("_n") == len(bands)).drop("_n")


def read_log(spark: SparkSession, path: str, schema: T.StructType, key: str, order: str) -> DataFrame:
    """An append-only JSON log: torn lines are dropped, the last row of a key holds."""
    from parcelspark.operators.incremental import latest

    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.col(key).isNotNull())
    return latest(rows, key, order)


def read_objects(spark: SparkSession, root: str, expected: DataFrame, pattern: str = "*") -> DataFrame:
    """`(name, content)` of expected files (name, size, sha256); another size or digest is an error, an
    expected file that is not there has null content."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    found = found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content")
    joined = expected.join(found, "name", "left")
    whole = F.col("content").isNull() | ((F.col("length") == F.col("size")) & (F.sha2("content", 256) == F.col("sha256")))
    return checked(joined, size_and_digest=whole).select("name", "content")


def stack_bands(blocks: DataFrame, by: list[str], bands: list[str], grid: list[str]) -> DataFrame:
    """One row a block with its bands' data in the order of `bands`; another grid, or a band that is missing
    or there twice, is an error."""
    place = F.array_position(F.array(*(F.lit(b) for b in bands)), F.col("band")) - 1
    rows = checked(blocks, known_band=F.col("band").isin(*bands)).withColumn("_at", place)
    out = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_at", "data"))).alias("_s"), F.count_distinct(F.struct(*grid)).alias("_g"), F.count_distinct("band").alias("_b"), *(F.first(c).alias(c) for c in grid))
    whole = (F.size("_s") == len(bands)) & (F.col("_b") == len(bands))
    return checked(out, one_grid=F.col("_g") == 1, all_bands=whole).select(*by, *grid, F.transform("_s", lambda x: x["data"]).alias("bands"))

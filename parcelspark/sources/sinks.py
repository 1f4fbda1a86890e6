"""Writers: sorted zone files with exact row groups and footers, lite indexes, documents."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.functions.hashes import etag, part_size
from parcelspark.functions.keys import hilbert
from parcelspark.session import materialise

#: Rows of a row group in a release and in a merged zone.
RELEASE_ROWS, MERGED_ROWS = 8192, 50_000
_COMMON = {"compression": "zstd", "parquet.page.write-checksum.enabled": "true"}


def curve_key(x: Column, y: Column, box: tuple[float, float, float, float], order: int = 16) -> Column:
    """Place of a point on the Hilbert curve over the square that holds a box."""
    west, south, east, north = box
    side, n = max(east - west, north - south), (1 << order) - 1
    at = lambda c, low: F.least(F.greatest(F.floor((c - low) / side * n), F.lit(0)), F.lit(n))
    return hilbert(at(x, west), at(y, south), order)


def write_sorted(df: DataFrame, path: str, key: Column, ties: list[str], rows: int = RELEASE_ROWS, level: int = 19, metadata: dict | None = None, by: list[str] | None = None) -> None:
    """Parquet in order of (key, ties): range-dealt, sorted within each file, `rows` rows a group, zstd.

    With `by`, a tree of partitions, each replaced as a whole where it is written. `metadata` becomes the
    table's comment in the written schema (column metadata of the first tie), which readers get back.
    """
    ordered = df.withColumn("_key", key)
    ordered = ordered.repartitionByRange(*(by or []), "_key", *ties).sortWithinPartitions(*(by or []), "_key", *ties).drop("_key")
    if metadata:
        ordered = ordered.withColumn(ties[0], F.col(ties[0]).alias(ties[0], metadata={"table": json.dumps(metadata, sort_keys=True)}))
    writer = ordered.write.mode("overwrite").options(**_COMMON).option("parquet.block.row.count.limit", rows).option("parquet.compression.codec.zstd.level", level)
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(path)


def write_lite(df: DataFrame, path: str, *order: str) -> None:
    """A small index: one file in order, float32 bounds rounded outward, no statistics."""
    low = lambda c: F.when(F.col(c).cast("float").cast("double") > F.col(c), _next(c, False)).otherwise(F.col(c).cast("float"))
    high = lambda c: F.when(F.col(c).cast("float").cast("double") < F.col(c), _next(c, True)).otherwise(F.col(c).cast("float"))
    out = df.withColumns({"xmin": low("xmin"), "ymin": low("ymin"), "xmax": high("xmax"), "ymax": high("ymax")})
    out.coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").options(**_COMMON).option("parquet.column.statistics.enabled", "false").option("parquet.compression.codec.zstd.level", 19).parquet(path)


def _next(c: str, up: bool) -> Column:
    """The float beside a value's nearest: one part in 2 ** 23 outward (at least the least normal number)."""
    f = F.col(c).cast("float").cast("double")
    step = F.greatest(F.abs(f) * 2.0**-23, F.lit(1.2e-38))
    return (f + step if up else f - step).cast("float")


def write_documents(df: DataFrame, path: str, document: Column, by: list[str]) -> None:
    """One JSON document a row, in folders of `by`."""
    df.select(*by, document.alias("value")).write.mode("overwrite").partitionBy(*by).text(path)


def _placed(document: dict, key: str, value: object, after: str | None) -> dict:
    """`document` with a key set: in its place if it is there, else behind `after`, else at the end."""
    if key in document or after not in document:
        return {**document, key: value}
    out = {}
    for k, v in document.items():
        out[k] = v
        if k == after:
            out[key] = value
    return out


def patched_document(text: str, values: dict[str, object], after: dict[str, str] | None = None) -> str:
    """A JSON object with values set, of any type; a path such as "properties.license" names a member of a member
    (made where it is missing). The order of keys stays; a document that has the values already is returned as it is."""
    document = json.loads(text)

    def put(node: dict, path: list[str], value: object, whole: str) -> dict:
        if len(path) == 1:
            return _placed(node, path[0], value, (after or {}).get(whole))
        child = node.get(path[0])
        return _placed(node, path[0], put(child if isinstance(child, dict) else {}, path[1:], value, whole), None)

    new = document
    for path, value in values.items():
        new = put(new, path.split("."), value, path)
    return text if new == document and list(new) == list(document) else json.dumps(new, ensure_ascii=False, separators=(",", ":"))


def patched_table(text: str, cells: dict[str, str]) -> str:
    """A text with tables of bars: the second cell of rows whose first cell is a key gets its value."""
    lines = text.split("\n")
    for i, line in enumerate(lines):
        parts = line.split("|")
        if len(parts) >= 4 and (value := cells.get(parts[1].strip())) is not None and parts[2].strip() != value:
            parts[2] = f" {value} "
            lines[i] = "|".join(parts)
    return "\n".join(lines)


def patched(df: DataFrame, column: str, values: dict[str, object] | None = None, after: dict[str, str] | None = None, cells: dict[str, str] | None = None) -> DataFrame:
    """`df` with the documents of `column` patched (as JSON by `values`, or as text with tables by `cells`) and a
    boolean column `drifted`: was there anything to change? Where it is false everywhere, nothing drifted;
    patching again changes nothing. A null document stays null."""
    place, names = df.columns.index(column), [*df.columns, "drifted"]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            old = batch.column(place).to_pylist()
            new = [x if x is None else patched_table(x, cells) if cells is not None else patched_document(x, values or {}, after) for x in old]
            columns = [*batch.columns, pa.array([a != b for a, b in zip(old, new, strict=True)], pa.bool_())]
            columns[place] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, df.withColumn("drifted", F.lit(False)).schema)


def changed_objects(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local objects (key, size, md5) that the remote listing (key, size, etag) lacks or has otherwise; an etag
    of parts is compared by size alone. Nothing is ever deleted."""
    r = remote.select("key", F.col("size").alias("_size"), F.regexp_replace("etag", '"', "").alias("_etag"))
    same = (F.col("size") == F.col("_size")) & ((F.col("md5") == F.col("_etag")) | F.col("_etag").contains("-"))
    return local.join(r, "key", "left").where(~F.coalesce(same, F.lit(False))).select(*local.columns)


def stamp(spark, root: str, metadata: dict[str, str], casts: dict[str, str] | None = None) -> DataFrame:
    """Give each Parquet file below `root` footer entries (and columns that Spark cannot write, such as
    uint8), keeping row groups and compression: rewritten beside the file, then moved over it. Runs on
    executors; returns `(path, n_rows)`. A file that already has the entries is left alone."""
    from collections.abc import Iterator

    import pyarrow as pa

    wanted = {k.encode(): v.encode() for k, v in metadata.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                fs, name = pa.fs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as f:
                    source = pq.ParquetFile(f)
                    schema = source.schema_arrow
                    for column, kind in (casts or {}).items():
                        i = schema.get_field_index(column)
                        schema = schema.set(i, schema.field(i).with_type(pa.type_for_alias(kind)))
                    rows.append((path, source.metadata.num_rows))
                    if wanted.items() <= (schema.metadata or {}).items() and schema.equals(source.schema_arrow):
                        continue
                    schema = schema.with_metadata((schema.metadata or {}) | wanted)
                    folder, base = name.rsplit("/", 1)
                    with pq.ParquetWriter(fs.open_output_stream(f"{folder}/.{base}.stamp"), schema, compression="zstd") as out:
                        for g in range(source.num_row_groups):
                            out.write_table(source.read_row_group(g).cast(schema), row_group_size=1 << 30)
                sums = f"{folder}/.{base}.crc"  # a local folder's checksum is of the old bytes
                if fs.get_file_info(sums).type != pa.fs.FileType.NotFound:
                    fs.delete_file(sums)
                fs.move(f"{folder}/.{base}.stamp", name)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["path", "n_rows"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(root).select("path")
    return files.mapInArrow(run, "path string, n_rows long")


def geo_footer(box: tuple[float, float, float, float] | None, geometry: str = "geometry", crs: str = "OGC:CRS84") -> dict[str, str]:
    """The `geo` entry of a file of polygons in WKB with a bbox column."""
    column: dict = {"encoding": "WKB", "geometry_types": ["Polygon", "MultiPolygon"], "crs": {"id": {"authority": crs.split(":")[0], "code": crs.split(":")[1]}}}
    column["covering"] = {"bbox": {k: ["bbox", k] for k in ("xmin", "ymin", "xmax", "ymax")}}
    if box is not None:
        column["bbox"] = list(box)
    return {"geo": json.dumps({"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column}}, sort_keys=True)}


def _files(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def clear_partition(spark, root: str, **values: object) -> bool:
    """Remove one partition's folder: what a run that kept no row must leave. True if there was one."""
    p, fs = _files(spark, "/".join([root.rstrip("/"), *(f"{k}={v}" for k, v in values.items())]))
    return bool(fs.delete(p, True))


def swap(spark, staged: dict[str, str]) -> None:
    """Put staged folders in their targets' places, once every one is complete (has _SUCCESS). What was there is
    moved aside first and deleted last, so that a crash in between loses no partition: the next call ends the
    work of the last (a target that is gone while its old one is aside gets it back, or the staged one)."""
    for source in staged:
        p, fs = _files(spark, f"{source}/_SUCCESS")
        if not fs.exists(p):
            raise ValueError(f"{source} is not complete")
    aside = {}
    for source, target in staged.items():
        (a, fs), (b, _) = _files(spark, source), _files(spark, target)
        old, _ = _files(spark, f"{target.rstrip('/')}.replaced")
        if fs.exists(b):
            fs.delete(old, True)
            if not fs.rename(b, old):
                raise OSError(f"{target} could not be moved aside")
        aside[target] = old
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            fs.rename(old, b)
            raise OSError(f"{source} could not be moved to {target}")
    for old in aside.values():
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def write_compact(df: DataFrame, path: str, by: str) -> None:
    """Delta-encoded integer lists (see geo.compact) without dictionaries, one file for each value of `by`."""
    writer = df.repartition(by).sortWithinPartitions(by).write.mode("overwrite").options(**_COMMON).partitionBy(by)
    writer.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false").parquet(path)


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """A small report as one JSON or CSV file."""
    one = df.coalesce(1).write.mode("overwrite")
    (one.option("header", True).csv if kind == "csv" else one.json)(path)


def relayout_plan(objects: DataFrame, target: Column) -> DataFrame:
    """`(key, target, action)`: copy what is not at its target yet, delete the old of what is there in full."""
    named = objects.select("key", "size", target.alias("target"))
    there = objects.select(F.col("key").alias("target"), F.col("size").alias("_there"))
    moved = named.where(F.col("target") != F.col("key")).join(there, "target", "left")
    return moved.select("key", "target", F.when(F.col("_there") == F.col("size"), "delete").otherwise("copy").alias("action"))


def longest_first(files: DataFrame) -> DataFrame:
    """`files` (name, size) with `turn`, their place by falling size and then name, as work is dealt. Sizes are
    ranked by ranges: each task numbers its own, after the sum of those before it."""
    ordered = files.repartitionByRange(F.desc("size"), "name").sortWithinPartitions(F.desc("size"), "name")
    ordered = ordered.withColumn("_part", F.spark_partition_id()).withColumn("_nth", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    ordered = materialise(ordered, "longest-first")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ordered.join(F.broadcast(starts), "_part").select(*files.columns, (F.col("_start") + F.col("_nth") + 1).alias("turn"))


def uploaded(objects: DataFrame, send: Callable[[str, bytes, int | None], str], part: int | None = None, attempts: int = 4) -> DataFrame:
    """`(key, size, etag, tries, landed)`: each object (key, content) sent by the executors through
    `send(key, data, number)`, whole (number None) or in parts from 1 on, each part again up to `attempts` times. `send`
    returns the store's digest of what it got. An object has landed if the digest of each piece, and so of the whole,
    is its own. Sending again is harmless; nothing is deleted."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        def piece(key: str, data: bytes, number: int | None) -> tuple[int, bool]:
            for n in range(1, attempts + 1):
                try:
                    if send(key, data, number).strip('"') == hashlib.md5(data).hexdigest():
                        return n, True
                except OSError:
                    continue
            return attempts, False

        for batch in batches:
            rows = []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size = part_size(len(data), part) if part else len(data)
                pieces = [(None, data)] if not part or len(data) <= size else [(i // size + 1, data[i : i + size]) for i in range(0, len(data), size)]
                sent = [piece(key, d, n) for n, d in pieces]
                rows.append((key, len(data), etag(data, size if len(pieces) > 1 else None), sum(n for n, _ in sent), all(ok for _, ok in sent)))
            types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["key", "size", "etag", "tries", "landed"])

    return objects.select("key", "content").mapInArrow(run, "key string, size long, etag string, tries int, landed boolean")


def verified(sent: DataFrame, remote: DataFrame) -> DataFrame:
    """`(key, problem)` of objects sent (key, size, etag) that a listing (key, size, etag) lacks or has otherwise."""
    r = remote.select("key", F.col("size").alias("_size"), F.regexp_replace("etag", '"', "").alias("_etag"))
    problem = F.when(F.col("_size").isNull(), "missing").when(F.col("_size") != F.col("size"), "size").when(F.col("_etag") != F.col("etag"), "etag")
    return sent.join(r, "key", "left").select("key", problem.alias("problem")).where(F.col("problem").isNotNull())


def write_objects(objects: DataFrame, root: str) -> DataFrame:
    """Write each row's `content` (bytes) as the file `name` below `root`, from the executors, beside its place first
    and then moved there; returns `(name, path, size)`. Lazy: the files are there once the result has been read."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs

        for batch in batches:
            fs, base = pa.fs.FileSystem.from_uri(root)
            rows = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{base.rstrip('/')}/{name}"
                folder, last = path.rsplit("/", 1)
                fs.create_dir(folder, recursive=True)
                with fs.open_output_stream(f"{folder}/.{last}.part") as f:
                    f.write(data)
                fs.move(f"{folder}/.{last}.part", path)
                rows.append((name, path, len(data)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["name", "path", "size"])

    return objects.select("name", "content").mapInArrow(run, "name string, path string, size long")


def replace_compact(rows: DataFrame, staged: str, target: str, by: str, geometry: str = "geometry") -> int:
    """Write outlines on the grid (see geo.compact) to `staged`, read them back, and only if every row decodes to the
    geometry it came from put them in `target`'s place; otherwise an error, and `target` is as it was. `rows` has
    tile_key, `by` and the geometry. Returns the rows written."""
    from parcelspark.functions import geo

    spark = rows.sparkSession
    packed = geo.compact(rows.select("tile_key", by, geometry), geometry)
    write_compact(packed.drop(geometry), staged, by)
    again = spark.read.schema(packed.drop(geometry).schema).parquet(staged)
    columns = [by, "tile_key", "x0", "y0", "dx", "dy", "ring_n", "part_n"]
    keyed = lambda d: d.groupBy(*columns).agg(F.count("*").alias("n"))
    lost = keyed(packed).exceptAll(keyed(again)).unionByName(keyed(again).exceptAll(keyed(packed)))
    if bad := lost.limit(1).collect():
        raise ValueError(f"{bad[0]['tile_key']} does not read back")
    n = again.count()
    swap(spark, {staged: target})
    return n

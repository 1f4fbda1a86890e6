"""Readers, writers, geometry columns, streaming, and their contracts."""

import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelspark.functions import geo, keys, wkb
from parcelspark.operators import incremental
from parcelspark.sources import readers, sinks
from parcelspark.streaming import runs


def _boxes(spark, n=40):
    rows = [("31UFS_0_0", i, float(x := 3 + 0.01 * (i % 8)), float(y := 51 + 0.01 * (i // 8)), x + 0.002, y + 0.002, bytearray(wkb.write(wkb.box(x, y, x + 0.002, y + 0.002)))) for i in range(n)]
    return spark.createDataFrame(rows, "tile_key string, parcel_id long, xmin double, ymin double, xmax double, ymax double, geometry binary")


def test_sorted_zone_files_row_groups_and_back(spark, tmp_path):
    df = _boxes(spark).withColumn("year", F.lit(2025)).withColumn("zone", F.lit("01"))
    key = sinks.curve_key((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2, (3, 51, 3.1, 51.1))
    sinks.write_sorted(df, f"file://{tmp_path}/z", key, ["parcel_id"], rows=8, by=["year", "zone"], metadata={"filter": "area <= 5"})
    files = sorted((tmp_path / "z/year=2025/zone=01").glob("*.parquet"))
    meta = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_rows for m in meta) == 40 and all(m.row_group(i).num_rows <= 8 for m in meta for i in range(m.num_row_groups))
    assert meta[0].row_group(0).column(0).compression == "ZSTD"
    back = readers.read_zones(spark, f"file://{tmp_path}/z")
    assert back.select("zone").distinct().collect()[0][0] == "01" and back.count() == 40
    foot = readers.read_footers(spark, f"file://{tmp_path}/z")
    assert foot.agg(F.sum("n_rows")).first()[0] == 40


def test_tiles_of_two_generations(spark, tmp_path):
    spark.createDataFrame([("31UFS_0_0", 1, 1000.0)], "tile_key string, parcel_id long, area_m2 double").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([("31UFS_0_0", 2, True)], "tile_key string, parcel_id long, claimed boolean").write.parquet(f"{tmp_path}/b")
    rows = {r.parcel_id: r for r in readers.read_tiles(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()}
    assert rows[1].claimed is None and rows[2].claimed is True and rows[2].area_m2 is None


def test_lite_index_bounds_hold_the_true_ones(spark, tmp_path):
    sinks.write_lite(_boxes(spark).select("tile_key", "parcel_id", "xmin", "ymin", "xmax", "ymax"), f"{tmp_path}/lite", "tile_key", "parcel_id")
    true = {r.parcel_id: r for r in _boxes(spark).collect()}
    for r in spark.read.parquet(f"{tmp_path}/lite").collect():
        t = true[r.parcel_id]
        assert r.xmin <= t.xmin and r.ymin <= t.ymin and r.xmax >= t.xmax and r.ymax >= t.ymax and t.xmin - r.xmin < 1e-5


def test_manifest_contract(spark, tmp_path):
    bands = ["B02", "B03", "B04", "B08"]
    rows = [(2025, "Q1", f"x_31UFS_0_0_{'Q1'}", b, 10 + i, "bucket", f"k/{b}") for i, b in enumerate(bands)]
    schema = "year int, quarter string, item_id string, band string, size_bytes long, destination_bucket string, destination_key string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/ok")
    r = readers.read_manifest(spark, f"{tmp_path}/ok").first()
    assert r.tile_key == "31UFS_0_0" and r.b08_size == 13 and r.b02_href == "s3://bucket/k/B02"
    spark.createDataFrame(rows[:3], schema).write.parquet(f"{tmp_path}/gap")
    with pytest.raises(Exception, match="complete"):
        readers.read_manifest(spark, f"{tmp_path}/gap").collect()


def test_geometry_columns(spark):
    m = geo.measure(_boxes(spark, 4)).first()
    assert 25_000 < m.area_m2 < 35_000 and m.n_parts == 1 and m.n_coordinates == 5 and m.xmin == 3.0
    hole = wkb.write([[wkb.box(3, 51, 3.002, 51.002)[0][0], wkb.box(3.0005, 51.0005, 3.00052, 51.00052)[0][0][::-1]], wkb.box(3.01, 51, 3.0101, 51.0001)[0]])
    tidy = geo.tidy(spark.createDataFrame([("31UFS_0_0", bytearray(hole))], "tile_key string, geometry binary")).first()
    assert [len(p) for p in wkb.parse(bytes(tidy.geometry))] == [1]
    pair = spark.createDataFrame([(bytearray(wkb.write(wkb.box(0, 0, 2, 2))), bytearray(wkb.write(wkb.box(1, 1, 3, 3))))], "a binary, b binary")
    assert geo.overlaps(pair, "a", "b").first().overlap == pytest.approx(1)
    assert geo.measure(spark.createDataFrame([("31UFS_0_0", None)], "tile_key string, geometry binary")).first().area_m2 is None


def test_key_functions(spark):
    df = spark.createDataFrame([("31UFS_0_0", 5.32, 60.39), ("30MXX_1_2", -3.0, -2.0), ("bad", 20.0, 75.0)], "k string, lon double, lat double")
    rows = df.select(keys.utm_epsg(F.col("k"), True).alias("e"), keys.utm_zone(F.col("lon"), F.col("lat")).alias("z"), keys.is_tile_key(F.col("k")).alias("v"), keys.band_of(F.col("lat")).alias("b")).collect()
    assert rows[0].e == 32631 and rows[1].e == 32730 and [r.z for r in rows] == [32, 30, 33] and [r.v for r in rows] == [True, True, False] and rows[0].b == "V"
    one = spark.range(1).select(keys.quarter_start(F.lit(2025), F.lit(4)).alias("s"), keys.quarter_end(F.lit(2025), F.lit(4)).alias("e"), keys.neighbour_zone(F.lit(60), 1).alias("n"), keys.multihash(F.lit("a")).alias("h"), keys.human_bytes(F.lit(1500)).alias("b"), keys.cell_area_km2(F.lit(7)).alias("c")).first()
    assert one.s == datetime.datetime(2025, 10, 1) and one.e == datetime.datetime(2025, 12, 31, 23, 59, 59) and one.n == 1
    assert one.h.startswith("1220ca978112") and one.b == "1.5 kB" and 2070 < one.c < 2080


def test_documents_and_uploads(spark):
    text = '{"n":5,"id":"a","links":[{"rel":"self","x":1.5}],"meta":{"b":null},"é":true}'
    doc = sinks.patched(spark.createDataFrame([(1, text), (2, None)], "k int, d string"), "d", {"license": "new", "meta.c": [1], "more.deep.er": {"z": 0}, "n": 6}, {"license": "id"}).orderBy("k").collect()
    assert doc[0].d == '{"n":6,"id":"a","license":"new","links":[{"rel":"self","x":1.5}],"meta":{"b":null,"c":[1]},"é":true,"more":{"deep":{"er":{"z":0}}}}' and doc[0].drifted
    assert doc[1].d is None and not doc[1].drifted and sinks.patched_document(doc[0].d, {"n": 6, "meta.c": [1]}) is doc[0].d
    table = "# t\n| zone | n |\n|---|---|\n| 31 | 5 |\n| a \\| b | 1 |\n"
    assert sinks.patched_table(table, {"31": "7", "zone": "n"}) == table.replace("| 5 |", "| 7 |") and sinks.patched_table(table, {"32": "1"}) == table
    local = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "key string, size int, md5 string")
    remote = spark.createDataFrame([("a", 1, '"x"'), ("b", 2, '"q-3"'), ("d", 9, "w")], "key string, size int, etag string")
    assert [r.key for r in sinks.changed_objects(local, remote).collect()] == ["c"]


def test_streaming_run_is_idempotent(spark, tmp_path):
    df = _boxes(spark).withColumn("zone", F.lit("31")).select("zone", "parcel_id")
    df.write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        runs.on_new_tiles(spark, f"{tmp_path}/in", df.schema, runs.replace_partitions(f"{tmp_path}/out", ["zone"]), f"{tmp_path}/check").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 40
    units, done, claims = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "unit string"), spark.createDataFrame([("a",)], "unit string"), spark.createDataFrame([("b", 990.0), ("c", 10.0)], "unit string, heartbeat double")
    assert sorted(r.unit for r in runs.work_left(units, done, claims, 1000.0).collect()) == ["c", "d"]


def test_fingerprints_change_with_inputs_and_rules(spark):
    files = spark.createDataFrame([("31", "a", 1, 5), ("31", "b", 2, 5), ("32", "c", 3, 5)], "zone string, name string, size long, modified long")
    a = incremental.fingerprints(files, "zone", "r1")
    assert incremental.stale(a, a, "zone").count() == 0
    assert incremental.stale(incremental.fingerprints(files, "zone", "r2"), a, "zone").count() == 2
    touched = files.withColumn("modified", F.when(F.col("name") == "b", 6).otherwise(F.col("modified")))
    assert [r.zone for r in incremental.stale(incremental.fingerprints(touched, "zone", "r1"), a, "zone").collect()] == ["31"]


def test_torn_log_lines_are_dropped(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"k":"a","t":1}\n{"k":"a","t":2}\n{"k":"b","t":')
    from pyspark.sql import types as T

    rows = readers.read_log(spark, str(tmp_path / "log.json"), T.StructType([T.StructField("k", T.StringType()), T.StructField("t", T.LongType())]), "k", "t").collect()
    assert [(r.k, r.t) for r in rows] == [("a", 2)]


def test_materialised_tables_can_be_dropped(spark):
    from parcelspark.session import drop_tables, materialise

    df = materialise(spark.range(3), "three")
    assert df.count() == 3
    drop_tables(spark)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()

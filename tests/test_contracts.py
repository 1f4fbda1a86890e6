"""Footers, swaps, stacks, probes, digests, resampling."""

import hashlib
import json

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelspark.functions import arrays, hashes
from parcelspark.operators import aggregates, graph, incremental, rasters
from parcelspark.plans import outlines
from parcelspark.sources import paging, readers, sinks


def test_stamped_files_keep_rows_and_groups(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 101).cast("short").alias("score"))
    sinks.write_sorted(df, f"file://{tmp_path}/z", F.col("id"), ["id"], rows=8)
    before = {f.name: pq.ParquetFile(f).metadata.num_row_groups for f in (tmp_path / "z").glob("*.parquet")}
    for _ in range(2):
        assert sinks.stamp(spark, f"file://{tmp_path}/z", sinks.geo_footer((0, 0, 1, 1)), {"score": "uint8"}).agg(F.sum("n_rows")).first()[0] == 100
    for f in (tmp_path / "z").glob("*.parquet"):
        p = pq.ParquetFile(f)
        assert str(p.schema_arrow.field("score").type) == "uint8" and json.loads(p.schema_arrow.metadata[b"geo"])["columns"]["geometry"]["bbox"] == [0, 0, 1, 1]
        assert p.metadata.num_row_groups == before[f.name]
    foot = readers.read_footers(spark, f"file://{tmp_path}/z").first()
    assert json.loads(json.loads(foot.metadata)["geo"])["primary_column"] == "geometry" and spark.read.parquet(f"file://{tmp_path}/z").count() == 100


def test_partitions_are_cleared_and_swapped(spark, tmp_path):
    df = spark.range(6).withColumn("zone", (F.col("id") % 2).cast("string"))
    df.write.partitionBy("zone").parquet(f"{tmp_path}/t")
    assert sinks.clear_partition(spark, f"file://{tmp_path}/t", zone="1") and not sinks.clear_partition(spark, f"file://{tmp_path}/t", zone="7")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3
    spark.range(2).write.parquet(f"{tmp_path}/new")
    (tmp_path / "half").mkdir()
    with pytest.raises(ValueError):
        sinks.swap(spark, {f"file://{tmp_path}/new": f"file://{tmp_path}/t", f"file://{tmp_path}/half": f"file://{tmp_path}/u"})
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3  # nothing was touched
    sinks.swap(spark, {f"file://{tmp_path}/new": f"file://{tmp_path}/t"})
    assert not (tmp_path / "t.replaced").exists()
    # a crash after the old was moved aside and before the new was moved in
    spark.range(5).write.parquet(f"{tmp_path}/newer")
    (tmp_path / "t").rename(tmp_path / "t.replaced")
    sinks.swap(spark, {f"file://{tmp_path}/newer": f"file://{tmp_path}/t"})
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5 and not (tmp_path / "t.replaced").exists()
    spark.range(2).write.parquet(f"{tmp_path}/new")
    sinks.swap(spark, {f"file://{tmp_path}/new": f"file://{tmp_path}/t"})
    assert spark.read.parquet(f"file://{tmp_path}/t/*.parquet").count() == 2


def test_compact_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("t1", 1, [1, 2, 3]), ("t2", 2, [4])], "tile_key string, x0 int, dx array<int>")
    sinks.write_compact(df, f"{tmp_path}/c", "tile_key")
    assert sorted(r.dx for r in spark.read.parquet(f"{tmp_path}/c").collect()) == [[1, 2, 3], [4]]
    sinks.write_report(df.select("tile_key", "x0"), f"{tmp_path}/r", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/r").count() == 2
    plan = sinks.relayout_plan(spark.createDataFrame([("a/1", 5), ("b/1", 5), ("a/2", 6)], "key string, size int"), F.regexp_replace("key", "^a/", "b/"))
    assert {(r.key, r.action) for r in plan.collect()} == {("a/1", "delete"), ("a/2", "copy")}


def test_objects_with_digests(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    digest = hashlib.sha256(b"abc").hexdigest()
    want = spark.createDataFrame([("a.bin", 3, digest), ("b.bin", 1, "x")], "name string, size long, sha256 string")
    got = {r.name: r.content for r in readers.read_objects(spark, str(tmp_path), want).collect()}
    assert bytes(got["a.bin"]) == b"abc" and got["b.bin"] is None
    with pytest.raises(Exception, match="size_and_digest"):
        readers.read_objects(spark, str(tmp_path), want.withColumn("size", F.lit(4).cast("long"))).collect()


def test_band_stacks(spark):
    rows = [("t", b, 4, bytearray(b.encode())) for b in ("Q1_B04", "Q1_B02")]
    df = spark.createDataFrame(rows, "tile_key string, band string, width int, data binary")
    assert [bytes(x) for x in readers.stack_bands(df, ["tile_key"], ["Q1_B02", "Q1_B04"], ["width"]).first().bands] == [b"Q1_B02", b"Q1_B04"]
    with pytest.raises(Exception, match="all_bands"):
        readers.stack_bands(df.limit(1), ["tile_key"], ["Q1_B02", "Q1_B04"], ["width"]).collect()
    with pytest.raises(Exception, match="one_grid"):
        readers.stack_bands(df.withColumn("width", F.when(F.col("band") == "Q1_B02", 5).otherwise(4)), ["tile_key"], ["Q1_B02", "Q1_B04"], ["width"]).collect()


def test_probes_and_retries(spark):
    head = lambda url: (404, 0) if url.endswith("x") else (200, len(url))
    assert {r.url: r.size for r in paging.probe(spark.createDataFrame([("ab",), ("x",)], "url string"), head).collect()} == {"ab": 2, "x": None}
    calls = []

    def flaky(method, url, body):
        calls.append(url)
        if len(calls) < 3:
            raise ConnectionError
        return {}

    assert paging.retried(flaky)("GET", "u", None) == {} and len(calls) == 3
    with pytest.raises(ConnectionError):
        paging.retried(lambda *a: (_ for _ in ()).throw(ConnectionError()), attempts=2)("GET", "u", None)


def test_etags_and_parts():
    assert hashes.etag(b"abc") == hashlib.md5(b"abc").hexdigest()
    parts = hashlib.md5(hashlib.md5(b"ab").digest() + hashlib.md5(b"c").digest()).hexdigest()
    assert hashes.etag(b"abc", 2) == f"{parts}-2" and hashes.part_size(1) == 8 << 20 and hashes.part_size((8 << 20) * 10_001) == 16 << 20


def test_listings_that_change(spark):
    a = spark.createDataFrame([("x", 1, 1), ("y", 1, 1)], "name string, size int, modified int")
    b = spark.createDataFrame([("x", 1, 2), ("y", 1, 1), ("z", 1, 1)], "name string, size int, modified int")
    assert sorted(r.name for r in incremental.changed_meanwhile(a, b).collect()) == ["x", "z"] and incremental.changed_meanwhile(a, a).count() == 0


def test_pixel_tables(spark):
    px = spark.createDataFrame([("t", r, c, (r + c) % 3) for r in range(4) for c in range(4)], "tile string, row long, col long, value int")
    layer = spark.createDataFrame([("t", 0, 0, 7.0), ("t", 1, 1, 9.0)], "tile string, row long, col long, value double")
    got = rasters.sample_layer(px, layer, 2, "elev", ["tile"])
    assert got.where("elev = 7").count() == 4 and got.where("elev = 9").count() == 4 and got.where("elev is null").count() == 8
    area = rasters.class_areas(px, {"crop": [1], "any": [0, 1, 2]}, 2.0, "tile").first()
    assert area["any"] == 32 and area.crop == 2 * sum((r + c) % 3 == 1 for r in range(4) for c in range(4))
    s = rasters.band_stats(px.withColumn("value", F.when(F.col("value") > 0, F.col("value"))), "value", "tile").first()
    assert (s.minimum, s.maximum) == (1, 2) and s.valid_percent == pytest.approx(100 * s.mean * 0 + 100 * sum((r + c) % 3 > 0 for r in range(4) for c in range(4)) / 16)


def test_resampling():
    x = np.arange(36.0).reshape(6, 6)
    assert arrays.area_mean(x, (3, 3)).tolist() == [[np.floor(x[r : r + 2, c : c + 2].mean() + 0.5) for c in (0, 2, 4)] for r in (0, 2, 4)]
    five = np.array([[0, 10, 20, 30, 40]], np.uint8)
    assert arrays.area_mean(five, (1, 2)).tolist() == [[8, 32]]
    assert arrays.sampled(x, np.array([1.0, 1.5, 9.0]), np.array([2.0, 2.5, 0.0]), "bilinear")[:2].tolist() == [8.0, 11.5]
    assert np.isnan(arrays.sampled(x, np.array([9.0]), np.array([0.0]))[0]) and arrays.sampled(x, np.array([1.4]), np.array([2.6]))[0] == 9
    assert arrays.block_mode(np.array([[1, 2, 5, 5], [2, 3, 4, 4]]), 2).tolist() == [[2, 4]]


def test_uploads_that_never_land_say_so(spark):
    def send(key, data, number):
        if key == "b" or (key == "c" and number == 2):
            raise OSError("down")
        return hashlib.md5(data if key != "d" else b"else").hexdigest()

    rows = spark.createDataFrame([(k, bytearray(b"x" * 25)) for k in "abcd"], "key string, content binary")
    out = {r.key: (r.tries, r.landed, "-" in r.etag) for r in sinks.uploaded(rows, send, part=10, attempts=3).collect()}
    assert out == {"a": (3, True, True), "b": (9, False, True), "c": (5, False, True), "d": (9, False, True)}


def test_compact_files_replace_only_what_they_decode_to(spark, tmp_path):
    from parcelspark.functions import utm, wkb

    def outline(x):
        lon, lat = utm.inverse(np.array([x, x + 10, x + 10, x, x]), np.array([5e6, 5e6, 5e6 + 5, 5e6 + 5, 5e6]), 31)
        return bytearray(wkb.write([[np.column_stack([lon, lat])]]))

    rows = lambda *xs: spark.createDataFrame([("31TAA_0_0", "31", outline(x)) for x in xs], "tile_key string, zone string, geometry binary")
    at, target = f"file://{tmp_path}/staged", f"file://{tmp_path}/zones"
    assert sinks.replace_compact(rows(400_000, 400_100), at, target, "zone") == 2 and spark.read.parquet(target).count() == 2
    with pytest.raises(Exception, match="off the grid"):
        sinks.replace_compact(rows(400_001), at, target, "zone")
    assert spark.read.parquet(target).count() == 2


def test_manifests_of_every_year_or_none(spark):
    get = lambda url: (404, b"") if url.endswith("2019.csv") else (200, b"a,1\nb,2\n")
    assert paging.manifests(spark, get, "https://example.org", [2018]).count() == 2
    with pytest.raises(Exception, match="no manifest"):
        paging.manifests(spark, get, "https://example.org", [2018, 2019]).collect()


def test_blocks_beyond_their_halo_are_refused(spark):
    row = ("t", 10, 10, 2, 4, 30, 30, "<i4", bytearray(3600))
    df = spark.createDataFrame([row], "tile_key string, row int, col int, row0 int, col0 int, height int, width int, dtype string, labels binary")
    assert outlines.outlines(df, 20, 8, []).count() == 0
    with pytest.raises(Exception, match="core_and_halo"):
        outlines.outlines(df, 20, 6, []).count()


def test_images_with_holes_are_refused(spark):
    points = spark.createDataFrame([(0.5, 0.5, 3.0)], "lon double, lat double, v double")
    due = spark.createDataFrame([(8, 7), (9, 7)], "x int, y int")
    assert rasters.world_mosaic(points, 4, "v", due.where("x = 8")).count() == 1
    with pytest.raises(ValueError, match="9, 7"):
        rasters.world_mosaic(points, 4, "v", due)


def test_quantiles_without_one_task(spark):
    import random

    rng = random.Random(2)
    rows = [("ab"[i % 2], rng.choice([None, rng.randint(0, 9), rng.random() * 1e6])) for i in range(3000)] + [("c", 5.0)]
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double")
    for by in ((), ("g",)):
        want = {(k, q): v for k in ("abc" if by else "") or [None] for q, v in zip((0.0, 0.25, 0.5, 1.0), df.where(F.lit(True) if k is None else F.col("g") == k).agg(F.percentile("v", F.array(*map(F.lit, (0.0, 0.25, 0.5, 1.0))))).first()[0])}
        got = aggregates.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 1.0], by, continuous=True).collect()
        assert {(r["g"] if by else None, r.share): r.value for r in got} == pytest.approx(want)
    assert aggregates.exact_quantiles(df.limit(0), "v", [0.5]).collect() == [] or aggregates.exact_quantiles(df.limit(0), "v", [0.5]).first().value is None


def test_components_of_named_nodes(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("z", "z"), (None, "q")], "s string, t string")
    found = {}
    for r in graph.named_components(edges, "s", "t").collect():
        found.setdefault(r.component, set()).add(r.node)
    assert sorted(map(sorted, found.values())) == [["a", "b", "c"], ["x", "y"]]

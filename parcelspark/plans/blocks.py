"""Raster kernels on block tables, and gates over scans: rasters that SQL can lay out pixel by pixel."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions import arrays, colour, keys, wkb
from parcelspark.operators import joins, predicates, rasters
from parcelspark.plans import outlines, release
from parcelspark.plans.base import query
from parcelspark.plans.view import SQL, parcels, table

#: A raster for each supplier k: h by w pixels, value (k + 3 r + 5 c) % 200 at row r, column c.
_SIZE = "k, 20 + k % 30 AS h, 24 + k % 17 AS w FROM (SELECT s_suppkey AS k FROM supplier)"
_PIXELS = f"(SELECT k, h, w, r, c, (k + 3 * r + 5 * c) % 200 AS v FROM (SELECT {_SIZE}), range(49) x(r), range(40) y(c) WHERE r < h AND c < w)"


def _shape(k: int) -> tuple[int, int]:
    return 20 + k % 30, 24 + k % 17


def _values(k: int) -> np.ndarray:
    h, w = _shape(k)
    r, c = np.ogrid[:h, :w]
    return ((k + 3 * r + 5 * c) % 200).astype(np.uint8)


def _each(spark: SparkSession, sf_dir: str, schema: str, rows: Callable[[int], list[tuple]]) -> DataFrame:
    """Rows that a kernel gives for each supplier's key."""
    names = [x.split(" ")[0] for x in schema.split(", ")]
    kinds = spark.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in kinds.fields]
        for batch in batches:
            out = [r for k in batch.column(0).to_pylist() for r in rows(k)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    return table(spark, sf_dir, "supplier").select("s_suppkey").mapInArrow(run, schema)


@query(f"SELECT k, sum((v > 100 AND v >= 255 - 200)::int)::bigint AS field, sum((v <= 100 AND 200 - v > 55)::int)::bigint AS boundary FROM {_PIXELS} GROUP BY k")
def class_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of each class where field is v, boundary 200 - v and background the rest; a tie is the first of the three."""

    def rows(k: int) -> list[tuple]:
        v = _values(k)
        found = arrays.class_map(np.stack([v, 200 - v]))
        return [(k, int((found == 1).sum() - (v == 100).sum()), int((found == 2).sum() + (v == 100).sum()))]

    return _each(spark, sf_dir, "k long, field long, boundary long", rows)


@query(f"SELECT k, v % 7 AS label, min(r) AS r0, min(c) AS c0, max(r) AS r1, max(c) AS c1, count(*) AS n, cast(sum(r) as bigint) AS total FROM {_PIXELS} WHERE v % 7 > 0 GROUP BY k, v % 7")
def label_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds, pixels and a layer's sum of each label of a raster."""

    def rows(k: int) -> list[tuple]:
        labels = _values(k).astype(np.int64) % 7
        layer = np.broadcast_to(np.arange(labels.shape[0], dtype=float)[:, None], labels.shape)
        boxes, sums = arrays.label_boxes(labels), arrays.zonal_sums(labels, {"r": layer}, strip=16)
        return [(k, i, *(b[0], b[1], b[2], b[3]), int(sums["n"][i]), int(sums["r"][i])) for i, b in boxes.items()]

    return _each(spark, sf_dir, "k long, label long, r0 long, c0 long, r1 long, c1 long, n long, total long", rows)


@query(f"SELECT k, r * 10 AS row, c * 10 AS col, greatest(r * 10 - 3, 0) AS row0, greatest(c * 10 - 3, 0) AS col0, least(r * 10 + 13, h) AS row1, least(c * 10 + 13, w) AS col1 FROM (SELECT {_SIZE}), range(5) x(r), range(5) y(c) WHERE r * 10 < h AND c * 10 < w")
def raster_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten pixels with a halo of three."""
    return _each(spark, sf_dir, "k long, row long, col long, row0 long, col0 long, row1 long, col1 long", lambda k: [(k, *w) for w in arrays.windows(_shape(k), 10, 3)])


_FIELDS = f"(SELECT k, i, i % 4 * 10 + 1 AS r, i // 4 * 10 + 1 AS c, 2 + (k + i) % 7 AS hh, 2 + (k * 3 + i) % 7 AS ww FROM (SELECT {_SIZE}), range(12) t(i))"


@query(f"SELECT k, cast(i + 1 as int) AS label, hh * ww * 6.25e0 AS area_m2, 1 AS n_parts, cast(hh as int) AS ext_h_px, cast(ww as int) AS ext_w_px, c * 2.5e0 AS xmin, (r + hh) * 2.5e0 AS ymax FROM {_FIELDS}")
def window_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve rectangular fields of a label raster, outlined window by window: each is kept by the window that holds its middle."""

    def rows(k: int) -> list[tuple]:
        labels = np.zeros((41, 31), np.int32)
        for i in range(12):
            r, c = i % 4 * 10 + 1, i // 4 * 10 + 1
            labels[r : r + 2 + (k + i) % 7, c : c + 2 + (k * 3 + i) % 7] = i + 1
        out = []
        for r, c, r0, c0, r1, c1 in arrays.windows(labels.shape, 16, 9):
            h, w, kind, data = outlines.block(labels[r0:r1, c0:c1])
            out.append((str(k), r, c, r0, c0, h, w, kind, data))
        return out

    blocks = _each(spark, sf_dir, "tile_key string, row int, col int, row0 int, col0 int, height int, width int, dtype string, labels binary", rows)
    from parcelspark.functions import geo

    found = geo.measure(outlines.outlines(blocks, 16, 9, []).withColumnRenamed("area_m2", "pixels_m2").withColumnRenamed("n_parts", "parts"), tile_key=None)
    return found.select(F.col("tile_key").cast("long").alias("k"), "label", F.col("area_m2").alias("area_m2"), "n_parts", "ext_h_px", "ext_w_px", "xmin", "ymax")


@query(f"SELECT k, cast(i + 1 as int) AS label, 5 AS vertices, hh * ww * 1.0e0 AS area FROM {_FIELDS}")
def traced_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as polygons: corners alone are vertices."""

    def rows(k: int) -> list[tuple]:
        labels = np.zeros((41, 31), np.int32)
        for i in range(12):
            r, c = i % 4 * 10 + 1, i // 4 * 10 + 1
            labels[r : r + 2 + (k + i) % 7, c : c + 2 + (k * 3 + i) % 7] = i + 1
        return [(k, i, wkb.coordinate_count(p), wkb.area(p)) for i, p in arrays.trace(labels).items()]

    return _each(spark, sf_dir, "k long, label int, vertices int, area double", rows)


@query(f"SELECT k, r // 4 AS row, c // 4 AS col, cast(min(v) as int) AS commonest FROM (SELECT k, h, w, r, c, (r // 4 * 7 + c // 4 + k) % 50 AS v FROM {_PIXELS}) WHERE r // 4 < h // 4 AND c // 4 < w // 4 GROUP BY ALL")
def commonest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest value of cells of four pixels, of which one in each cell is another."""

    def rows(k: int) -> list[tuple]:
        h, w = _shape(k)
        r, c = np.ogrid[:h, :w]
        x = (r // 4 * 7 + c // 4 + k) % 50
        x = np.where((r % 4 == 1) & (c % 4 == 2), 99, x)
        m = arrays.block_mode(x, 4)
        return [(k, i, j, int(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]

    return _each(spark, sf_dir, "k long, row long, col long, commonest int", rows)


@query(f"SELECT k, r // 2 AS row, c // 2 AS col, cast(floor(avg(v) + 0.5e0) as int) AS mean FROM {_PIXELS} WHERE h % 2 = 0 AND w % 2 = 0 GROUP BY ALL")
def area_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rasters of even sides at half their size."""

    def rows(k: int) -> list[tuple]:
        h, w = _shape(k)
        m = arrays.area_mean(_values(k).astype(np.int64), (h // 2, w // 2)) if h % 2 == 0 and w % 2 == 0 else np.zeros((0, 0))
        return [(k, i, j, int(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]

    return _each(spark, sf_dir, "k long, row long, col long, mean int", rows)


@query(f"SELECT k, r, c, round(2.0e0 * (r + 0.25e0) + 3.0e0 * (c + 0.5e0) + k, 6) AS value FROM {_PIXELS} WHERE r < h - 1 AND c < w - 1")
def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plane read between its pixels, bilinearly."""

    def rows(k: int) -> list[tuple]:
        h, w = _shape(k)
        r, c = np.mgrid[: h - 1, : w - 1]
        x = 2.0 * np.arange(h)[:, None] + 3.0 * np.arange(w) + k
        return list(zip([k] * r.size, r.ravel().tolist(), c.ravel().tolist(), np.round(arrays.sampled(x, r.ravel() + 0.25, c.ravel() + 0.5, "bilinear"), 6).tolist(), strict=True))

    return _each(spark, sf_dir, "k long, r long, c long, value double", rows)


@query("SELECT p_partkey, round(degrees(atan(sqrt(pow(p_size % 13, 2) + pow(p_partkey % 11, 2)) / 30)), 6) AS least, round(degrees(atan(sqrt(pow(p_size % 13, 2) + pow(p_partkey % 11, 2)) / 30)), 6) AS most FROM part")
def slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slopes of planes: the same everywhere."""
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 13).alias("a"), (F.col("p_partkey") % 11).alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [arrays.slope_degrees(np.arange(8.0)[:, None] * a + np.arange(9.0) * b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("p_partkey"), *(pa.array([round(float(f(x)), 6) for x in out]) for f in (np.min, np.max))], ["p_partkey", "least", "most"])

    return p.mapInArrow(run, "p_partkey long, least double, most double")


@query("SELECT s_suppkey AS k, b AS band, CASE WHEN b = 2 THEN 0 ELSE cast(100 * b + s_suppkey % 50 as int) END AS least, cast(100 * b + s_suppkey % 50 as int) AS most, 0 AS left_over FROM supplier, range(4) t(b)")
def filled_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacks of constant bands with gaps of three kinds (small, whole rows, a whole layer), filled; where a layer
    without any value meets a gap of the other time, 0 is left."""

    def rows(k: int) -> list[tuple]:
        stack = np.stack([np.full((40, 40), 100 * b + k % 50, np.int16) for _ in range(2) for b in range(4)])
        stack[:, 3:6, 4 + k % 20 : 8 + k % 20] = -1
        stack[0, 10:30] = -1
        stack[6] = -1
        out = arrays.fill_gaps(stack, -1)
        return [(k, b, int(out[b::4].min()), int(out[b::4].max()), int((out[b::4] == -1).sum())) for b in range(4)]

    return _each(spark, sf_dir, "k long, band long, least int, most int, left_over int", rows)


@query(f"SELECT k, h * w AS pixels, cast(sum(v) as bigint) AS total FROM {_PIXELS} GROUP BY k, h, w")
def blended_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that gives back what it is given (a share of 255), run on overlapping patches and written as bytes."""

    def rows(k: int) -> list[tuple]:
        v = _values(k)
        h, w, kind, data = outlines.block(v / 255.0)
        return [(str(k), h, w, kind, data)]

    blocks = _each(spark, sf_dir, "tile_key string, height int, width int, dtype string, data binary", rows)
    out = outlines.predicted(blocks, lambda x: x, 16, 8)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, np.uint8) for x in batch.column("scores").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x) for x in batch.column("tile_key").to_pylist()], pa.int64()), pa.array([len(f) for f in found], pa.int64()), pa.array([int(f.sum()) for f in found], pa.int64())], ["k", "pixels", "total"])

    return out.mapInArrow(total, "k long, pixels long, total long")


@query(f"SELECT k, count(*) AS n FROM (SELECT {_SIZE}), range(49) x(r), range(40) y(c) WHERE r < h AND c < w AND pow(r - k % 20, 2) + pow(c - k % 24, 2) <= pow(2 + k % 6, 2) GROUP BY k")
def near_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels within 2 to 7 pixels of the one that is set."""

    def rows(k: int) -> list[tuple]:
        mask = np.zeros(_shape(k), bool)
        mask[k % 20, k % 24] = True
        return [(k, int(arrays.distance_within(mask, 2 + k % 6).sum()))]

    return _each(spark, sf_dir, "k long, n long", rows)


@query(f"""WITH q AS (SELECT k, v, sum(count(*)) OVER (PARTITION BY k ORDER BY v) AS upto, sum(count(*)) OVER (PARTITION BY k) AS n FROM {_PIXELS} GROUP BY k, v)
SELECT k, cast(floor(sum(v * m) / sum(m) * 1000 + 1e-6) as bigint) AS mean_milli, cast(min(v) FILTER (WHERE upto >= 0.5e0 * n) as int) AS p50, cast(min(v) FILTER (WHERE upto >= 0.9e0 * n) as int) AS p90, cast(min(v) FILTER (WHERE upto >= 0.99e0 * n) as int) AS p99, 0 AS zero_rows
FROM (SELECT *, upto - coalesce(lag(upto) OVER (PARTITION BY k ORDER BY v), 0) AS m FROM q) GROUP BY k""")
def score_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of score bands: mean and percentiles by histogram, rows without any score."""

    def rows(k: int) -> list[tuple]:
        s = arrays.output_stats(_values(k))
        return [(k, int(np.floor(s["mean"] * 1000 + 1e-6)), s["p50"], s["p90"], s["p99"], s["zero_rows"])]

    return _each(spark, sf_dir, "k long, mean_milli long, p50 int, p90 int, p99 int, zero_rows int", rows)


@query(f"SELECT k, cast(floor(avg((v = 0)::int) * 1e6 + 0.501e0) as bigint) AS nodata_ppm, cast(floor(avg((v > 150)::int) FILTER (WHERE v <> 0) * 1e6 + 0.501e0) as bigint) AS bright_ppm FROM {_PIXELS} GROUP BY k")
def input_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of pixels without data, and of bright ones among those with."""

    def rows(k: int) -> list[tuple]:
        s = arrays.input_stats(_values(k)[None].astype(np.int16), 0, 150)
        return [(k, int(s["nodata_share"] * 1e6 + 0.501), int(s["bright_share"] * 1e6 + 0.501))]

    return _each(spark, sf_dir, "k long, nodata_ppm long, bright_ppm long", rows)


_LINES = "(SELECT l_linenumber AS tile, l_orderkey % 64 AS row, l_partkey % 64 AS col, cast(l_quantity as bigint) AS value, l_suppkey % 10 AS class FROM lineitem)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(c("l_linenumber").alias("tile"), (c("l_orderkey") % 64).alias("row"), (c("l_partkey") % 64).alias("col"), c("l_quantity").cast("long").alias("value"), (c("l_suppkey") % 10).alias("class"))


@query(f"SELECT tile, min(value) AS minimum, max(value) AS maximum, cast(floor(avg(value) * 1000 + 1e-6) as bigint) AS mean_milli, cast(round(stddev_pop(value) * 1000) as bigint) AS stddev_milli, cast(floor(count(value) * 100.0e0 / count(*) + 1e-9) as int) AS valid FROM (SELECT tile, CASE WHEN class > 0 THEN value END AS value FROM {_LINES}) GROUP BY tile")
def band_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = _lines(spark, sf_dir).withColumn("value", F.when(F.col("class") > 0, F.col("value")))
    out = rasters.band_stats(px, "value", "tile")
    return out.select("tile", "minimum", "maximum", F.floor(F.col("mean") * 1000 + 1e-6).cast("long").alias("mean_milli"), F.round(F.col("stddev") * 1000).cast("long").alias("stddev_milli"), F.floor(F.col("valid_percent") + 1e-9).cast("int").alias("valid"))


@query(f"SELECT tile, count(*) FILTER (WHERE class IN (1, 2, 3)) * 100.0e0 AS crops, count(*) FILTER (WHERE class = 8) * 100.0e0 AS water FROM {_LINES} GROUP BY tile")
def class_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.class_areas(_lines(spark, sf_dir).withColumn("value", F.col("class")), {"crops": [1, 2, 3], "water": [8]}, 100.0, "tile")


@query(f"SELECT row, col, bool_or(class IN (1, 2)) AS hit FROM (SELECT row // 2 AS row, col // 2 AS col, class FROM {_LINES}) GROUP BY row, col")
def class_ever(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Was a cell ever, in any of the vintages (tiles), of one of two classes?"""
    return rasters.reduce_any(_lines(spark, sf_dir), 2, F.col("class").isin(1, 2))


@query(f"SELECT p.tile, p.row, p.col, cast(max(s.v) as bigint) AS slope, count(*) AS n FROM {_LINES} p LEFT JOIN (SELECT tile, row // 8 AS r, col // 8 AS c, max(value) AS v FROM {_LINES} WHERE class < 5 GROUP BY ALL) s ON p.tile = s.tile AND p.row // 8 = s.r AND p.col // 8 = s.c GROUP BY p.tile, p.row, p.col")
def context_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pixel's value of a layer of coarser cells."""
    px = _lines(spark, sf_dir)
    layer = px.where("class < 5").groupBy("tile", F.expr("row div 8").alias("row"), F.expr("col div 8").alias("col")).agg(F.max("value").alias("value"))
    return rasters.sample_layer(px.select("tile", "row", "col"), layer, 8, "slope", ["tile"]).groupBy("tile", "row", "col").agg(F.max("slope").alias("slope"), F.count("*").alias("n"))


@query("SELECT cast(floor((lon + 180) / 360 * 64) as int) AS x, cast(floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * 64) as int) AS y, cast(floor(avg(s) * 1000 + 1e-6) as bigint) AS value_milli FROM (SELECT -179.5e0 + (o_orderkey % 719) * 0.5e0 AS lon, -80.25e0 + (o_custkey % 320) * 0.5e0 AS lat, o_orderkey % 101 AS s FROM orders) GROUP BY ALL")
def world_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means in the pixels of a map of the world, refused where a pixel that is due has none."""
    o = F.col("o_orderkey")
    points = table(spark, sf_dir, "orders").select((F.lit(-179.5) + (o % 719) * 0.5).alias("lon"), (F.lit(-80.25) + (F.col("o_custkey") % 320) * 0.5).alias("lat"), (o % 101).alias("s"))
    x, y = keys.map_tile(F.col("lon"), F.col("lat"), 6)
    due = points.where("s > 50").select(x.alias("x"), y.alias("y")).distinct()
    return rasters.world_mosaic(points, 6, "s", due).select("x", "y", F.floor(F.col("value") * 1000 + 1e-6).cast("long").alias("value_milli"))


@query("SELECT band, count(*) AS n, cast(sum(p_partkey) as bigint) AS keys FROM (SELECT p_partkey, unnest(['B02', 'B03', 'B04', 'B08']) AS band FROM part) GROUP BY band")
def stacked_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of single bands as stacks in the order of bands, on one grid each, and what stands in each place."""
    bands = ["B02", "B03", "B04", "B08"]
    blocks = table(spark, sf_dir, "part").select("p_partkey", F.lit(10).alias("step"), F.explode(F.array(*(F.lit(b) for b in reversed(bands)))).alias("band"))
    blocks = blocks.withColumn("data", F.concat("band", F.lit(":"), F.col("p_partkey").cast("string")).cast("binary"))
    from parcelspark.sources.readers import stack_bands

    out = stack_bands(blocks, ["p_partkey"], bands, ["step"])
    each = out.select(F.posexplode("bands").alias("at", "data")).select("at", F.split(F.col("data").cast("string"), ":").alias("d"))
    right = F.element_at(F.array(*(F.lit(b) for b in bands)), F.col("at") + 1) == F.col("d")[0]
    return each.where(right).groupBy(F.col("d")[0].alias("band")).agg(F.count("*").alias("n"), F.sum(F.col("d")[1].cast("long")).alias("keys"))


_ANCHORS = [(26, (32, 64, 96)), (76, (64, 160, 96)), (153, (240, 224, 64)), (255, (255, 255, 255))]


@query("SELECT cast(v as int) AS v, CASE v WHEN 26 THEN '32,64,96' WHEN 76 THEN '64,160,96' WHEN 153 THEN '240,224,64' WHEN 255 THEN '255,255,255' ELSE '0,0,0' END AS rgb FROM (SELECT unnest([0, 10, 25, 26, 76, 153, 255]) AS v)")
def colour_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours at the anchors of a ramp, and below its floor."""
    first, anchors = colour.ramp(["#204060", "#40a060", "#f0e040", "#ffffff"], [30, 60, 99.999], 0.1)
    painted = colour.painted(np.arange(256, dtype=np.uint8), first, anchors).tolist()
    return spark.createDataFrame([(v, ",".join(map(str, painted[v]))) for v in (0, 10, 25, 26, 76, 153, 255)], "v int, rgb string")


_SCANS = f"""(SELECT DISTINCT ON (tile_key) tile_key, id FROM {SQL} ORDER BY tile_key, id)"""


@query(f"""SELECT tile_key, CASE WHEN id % 11 = 0 THEN 'unreadable' WHEN flags = '' AND id % 13 = 0 THEN 'unexpected' ELSE flags END AS qa_flags FROM (SELECT tile_key, id,
concat_ws(',', CASE WHEN id % 3 = 0 THEN 'structure' END, CASE WHEN id % 5 = 0 THEN 'no_provenance' END, CASE WHEN id % 5 = 1 AND id % 2 = 0 THEN 'stale' END, CASE WHEN id % 5 <> 0 AND id % 7 = 0 THEN 'tf32' END, CASE WHEN id % 17 = 0 THEN 'zero_run' END, CASE WHEN id % 19 = 0 THEN 'saturated' END) AS flags FROM {_SCANS})""")
def raster_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of scanned rasters against the expected tiles."""
    i = F.col("id")
    scans = parcels(spark, sf_dir).groupBy("tile_key").agg(F.min("id").alias("id")).select(
        "tile_key", "id", F.when(i % 11 == 0, "bad").alias("error"), F.when(i % 3 == 0, "tiles").alias("structure"), F.when(i % 5 != 0, F.when((i % 5 == 1) & (i % 2 == 0), "other").otherwise("f")).alias("prov_fingerprint"),
        F.when(i % 7 == 0, "1").otherwise("0").alias("prov_tf32"), F.lit("H100").alias("prov_gpu"), F.when(i % 17 == 0, 4096).otherwise(0).alias("zero_row_run"), F.lit(0.0).alias("in_nodata_any"),
        *(F.lit(0.1).alias(c) for c in ("top_field", "next_field", "top_boundary", "next_boundary")), F.when(i % 19 == 0, 0.5).otherwise(0.0).alias("sat255"),
    )
    # a file that cannot be read has no other flag
    known = [c for c in scans.columns if c not in ("tile_key", "id", "error", "in_nodata_any", "prov_gpu")]
    scans = scans.select("tile_key", "id", "error", "in_nodata_any", "prov_gpu", *(F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in known))
    out = release.raster_gate(scans, scans.where(i % 13 != 0).select("tile_key"), ["H100"], "f")
    return out.select("tile_key", F.when(F.col("qa_flags").startswith("unreadable"), "unreadable").otherwise(F.col("qa_flags")).alias("qa_flags"))


@query("SELECT p_partkey AS name, CASE WHEN p_partkey % 6 = 0 THEN 'added' WHEN p_partkey % 6 = 1 THEN 'missing' ELSE 'changed' END AS status FROM part WHERE p_partkey % 6 IN (0, 1, 2)")
def manifest_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose size or digest differs between two manifests, or that one lacks."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey") % 6
    row = lambda d, extra: d.select(F.col("p_partkey").alias("name"), F.col("p_size").alias("size"), F.sha2(F.concat("p_name", extra).cast("binary"), 256).alias("sha256"))
    return release.manifest_difference(row(p.where(k != 0), F.lit("")), row(p.where(k != 1), F.when(k == 2, "x").otherwise("")))


@query(f"SELECT zone, n AS counted, CASE WHEN z % 5 = 0 THEN NULL ELSE n + (z % 3) * 40 END AS published, CASE WHEN z % 5 = 0 THEN 'unpublished' ELSE 'differs' END AS problem FROM (SELECT zone, cast(zone as int) AS z, count(*) AS n FROM {SQL} GROUP BY zone) WHERE z % 5 = 0 OR z % 3 * 40 > 0.1e0 * n UNION ALL SELECT '99', NULL, 7, 'uncounted'")
def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published figures that the rows do not bear out, to a tenth."""
    n = parcels(spark, sf_dir).groupBy("zone").agg(F.count("*").alias("n"))
    z = F.col("zone").cast("int")
    told = n.where(z % 5 != 0).select("zone", (F.col("n") + (z % 3) * 40).alias("n")).unionByName(spark.createDataFrame([("99", 7)], "zone string, n long"))
    return joins.count_gate(n, told, "zone", 0.1)


@query("SELECT p_partkey, CASE WHEN b < 1000 THEN b || ' B' WHEN b < 1000000 THEN format('{:.1f}', b / 1000.0e0) || ' kB' WHEN b < 1000000000 THEN format('{:.1f}', b / 1000000.0e0) || ' MB' ELSE format('{:.1f}', b / 1000000000.0e0) || ' GB' END AS size FROM (SELECT p_partkey, (p_size * 100 + 7) * cast(pow(10, p_partkey % 7) as bigint) AS b FROM part)")
def readable_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = (F.col("p_size") * 100 + 7) * F.pow(F.lit(10), F.col("p_partkey") % 7).cast("long")
    return table(spark, sf_dir, "part").select("p_partkey", keys.human_bytes(b).alias("size"))


@query("SELECT cast(r as int) AS resolution, cast(round(510065621.724e0 / (60 * pow(4, r - 1)) * 1000) as bigint) AS area_dam2 FROM range(1, 16) t(r)")
def cell_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1, 16).select(F.col("id").cast("int").alias("resolution"), F.round(keys.cell_area_km2(F.col("id")) * 1000).cast("long").alias("area_dam2"))


_GRID = "cast(least(greatest(floor((sin(radians(lat)) + 1) / 2 * 96), 0), 95) as bigint)"


@query(f"SELECT cell, count(*) AS n FROM (SELECT (5::bigint << 58) + {_GRID} * (1::bigint << 29) + cast(floor((lon + 180) / 360 * 160) as bigint) % 160 AS cell FROM (SELECT -179.5e0 + (o_orderkey % 719) * 0.5e0 AS lon, -80.25e0 + (o_custkey % 320) * 0.5e0 AS lat FROM orders)) GROUP BY cell")
def equal_area_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by cell of the equal-area grid."""
    from parcelspark.functions.cells import cell_of

    o = F.col("o_orderkey")
    at = cell_of(F.lit(-179.5) + (o % 719) * 0.5, F.lit(-80.25) + (F.col("o_custkey") % 320) * 0.5, 5)
    return table(spark, sf_dir, "orders").groupBy(at.alias("cell")).agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS n, true AS same_rule FROM {SQL} WHERE in_utm_zone AND in_mgrs_square AND area <= 20000000 AND coalesce(frac_water, 0) < 70")
def recorded_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by the rule as its text was recorded, and whether the text read again is the rule that was used."""
    text = predicates.retention_sql(20_000_000, 70)
    noted = spark.createDataFrame([(text,)], "rule string").first()["rule"]
    return parcels(spark, sf_dir).where(noted).agg(F.count("*").alias("n")).withColumn("same_rule", F.lit(noted == text))


@query("SELECT o_orderkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of two dimensions, whose keys are checked to be unique."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = joins.join_attributes(joins.join_attributes(orders, customers, ["c_custkey"]), nations, ["n_nationkey"])
    return out.select("o_orderkey", "c_mktsegment", "n_name")


@query(f"SELECT id, zone FROM (SELECT id, zone, row_number() OVER (PARTITION BY zone ORDER BY md5('7:' || id), id) AS r FROM {SQL}) WHERE r <= 5")
def seeded_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rows of each zone, chosen by a seeded hash: the same in every run, however the rows lie."""
    from parcelspark.operators.aggregates import seeded_sample

    return seeded_sample(parcels(spark, sf_dir).select("id", "zone"), "id", 5, 7, "zone")

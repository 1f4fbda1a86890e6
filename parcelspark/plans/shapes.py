"""Geometry kernels over whole tables: shapes whose measures SQL knows in closed form."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions import codec, geo, overlay, utm, wkb
from parcelspark.plans import outlines, release, validation
from parcelspark.plans.base import query
from parcelspark.plans.view import SQL, parcels, table
from parcelspark.session import materialise, spread

ZONE = 31
#: Transverse Mercator in SQL, as functions.utm: series in the third flattening.
_N = "0.0016792203863837047e0"
_RAD = f"(6378137e0 / (1 + {_N}) * (1 + pow({_N}, 2) / 4 + pow({_N}, 4) / 64))"
_ALPHA = (
    f"({_N} / 2 - 2 * pow({_N}, 2) / 3 + 5 * pow({_N}, 3) / 16 + 41 * pow({_N}, 4) / 180)",
    f"(13 * pow({_N}, 2) / 48 - 3 * pow({_N}, 3) / 5 + 557 * pow({_N}, 4) / 1440)",
    f"(61 * pow({_N}, 3) / 240 - 103 * pow({_N}, 4) / 140)",
    f"(49561 * pow({_N}, 4) / 161280)",
)


def utm_sql(rows: str, lon: str = "lon", lat: str = "lat") -> str:
    """`rows` with `east` and `north`, metres of zone 31."""
    e = f"(2 * sqrt({_N}) / (1 + {_N}))"
    series = lambda f, g: " + ".join(f"{a} * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, a in enumerate(_ALPHA, 1))
    a = f"SELECT *, radians({lon} - 3) AS lam, sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat})))) AS tt FROM {rows}"
    b = f"SELECT *, atan2(tt, cos(lam)) AS xi, asinh(sin(lam) / sqrt(tt * tt + cos(lam) * cos(lam))) AS eta FROM ({a})"
    return f"(SELECT * EXCLUDE (lam, tt, xi, eta), 500000 + 0.9996e0 * {_RAD} * (eta + {series('cos', 'sinh')}) AS east, 0.9996e0 * {_RAD} * (xi + {series('sin', 'cosh')}) AS north FROM ({b}))"


def shaped(df: DataFrame, build: Callable[[dict], wkb.Polygons], name: str = "geometry") -> DataFrame:
    """`df` with the WKB of what `build` makes of each row."""
    kept = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([wkb.write(build(r)) for r in batch.to_pylist()], pa.binary())], [*kept, name])

    return df.mapInArrow(run, df.withColumn(name, F.lit(None).cast("binary")).schema)


def boxed(df: DataFrame, name: str, *sides: Column) -> DataFrame:
    """`df` with the WKB of boxes (x0, y0, x1, y1)."""
    return release.box_geometry(df.withColumns({k: c.cast("double") for k, c in zip(("xmin", "ymin", "xmax", "ymax"), sides, strict=True)})).drop("xmin", "ymin", "xmax", "ymax").withColumnRenamed("geometry", name)


_PLACES = "(SELECT o_orderkey AS id, 1 + (o_orderkey % 400) * 0.01e0 AS lon, 44 + (o_custkey % 500) * 0.01e0 AS lat, 1 + o_orderkey % 30 AS w, 1 + o_custkey % 30 AS h, o_orderkey % 5 AS k FROM orders)"


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(o.alias("id"), (1 + (o % 400) * F.lit(0.01)).alias("lon"), (44 + (F.col("o_custkey") % 500) * F.lit(0.01)).alias("lat"), (1 + o % 30).alias("w"), (1 + F.col("o_custkey") % 30).alias("h"), (o % 5).alias("k"))


def _parts(r: dict) -> wkb.Polygons:
    """k = 0: nothing; 1: a box; 2: a box with a hole; 3: two boxes; 4: two boxes, the second with a hole."""
    x, y, w, h, k = float(r["x0"]), float(r["y0"]), float(r["w"]), float(r["h"]), r["k"]
    box, hole = wkb.box(x, y, x + 4 * w, y + 4 * h), wkb.box(x + w, y + h, x + 2 * w, y + 2 * h)[0][0][::-1]
    far = wkb.box(x + 100 * w, y, x + 102 * w, y + h * 2)
    inner = wkb.box(x + 100.5 * w, y + h * 0.5, x + 101 * w, y + h)[0][0][::-1]
    return {0: [], 1: box, 2: [[box[0][0], hole]], 3: box + far, 4: [*box, [far[0][0], inner]]}[k]


_BOXES = f"(SELECT id, x0, y0, 1 + id % 9 AS w, 1 + score % 7 AS h, id % 5 AS k FROM {SQL})"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parcels(spark, sf_dir).select("id", "x0", "y0", (1 + F.col("id") % 9).alias("w"), (1 + F.col("score") % 7).alias("h"), (F.col("id") % 5).alias("k"))


@query(f"""SELECT id, CASE k WHEN 0 THEN NULL WHEN 1 THEN 16e0 WHEN 2 THEN 15e0 WHEN 3 THEN 20e0 ELSE 19.75e0 END * w * h AS area,
CASE k WHEN 0 THEN NULL WHEN 1 THEN 8e0 WHEN 2 THEN 10e0 WHEN 3 THEN 12e0 ELSE 13e0 END * (w + h) AS perimeter,
CASE k WHEN 0 THEN NULL WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 2 END AS parts, CASE k WHEN 0 THEN NULL WHEN 2 THEN 1 WHEN 4 THEN 1 ELSE 0 END AS holes,
CASE k WHEN 0 THEN NULL WHEN 1 THEN 5 WHEN 2 THEN 10 WHEN 3 THEN 10 ELSE 15 END AS coordinates FROM {_BOXES}""")
def geometry_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WKB written, parsed and measured: areas, perimeters, parts, rings, vertices; no measures where there is nothing."""
    out = geo.measure(shaped(_boxes(spark, sf_dir), _parts), tile_key=None)
    return out.select("id", F.round("area_m2", 6).alias("area"), F.round("perimeter_m", 6).alias("perimeter"), F.col("n_parts").alias("parts"), F.col("n_holes").alias("holes"), F.col("n_coordinates").alias("coordinates"))


@query(f"""SELECT id, cast(x0 as double) AS xmin, cast(y0 as double) AS ymin, x0 + CASE WHEN k < 3 THEN 4e0 ELSE 102e0 END * w AS xmax, y0 + 4e0 * h AS ymax,
round((CASE k WHEN 1 THEN x0 + 2.0 * w WHEN 2 THEN x0 + (16 * 2.0 - 1.5) / 15 * w WHEN 3 THEN x0 + (16 * 2.0 + 4 * 101) / 20 * w ELSE x0 + (16 * 2.0 + 4 * 101 - 0.25 * 100.75) / 19.75 * w END), 6) AS cx,
round((CASE k WHEN 1 THEN y0 + 2.0 * h WHEN 2 THEN y0 + (16 * 2.0 - 1.5) / 15 * h WHEN 3 THEN y0 + (16 * 2.0 + 4 * 1) / 20 * h ELSE y0 + (16 * 2.0 + 4 * 1 - 0.25 * 0.75) / 19.75 * h END), 6) AS cy FROM {_BOXES} WHERE k > 0""")
def geometry_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and centroids of what is not empty."""
    shapes = shaped(_boxes(spark, sf_dir), _parts).where(F.col("geometry").isNotNull())
    return geo.measure(shapes, tile_key=None).select("id", "xmin", "ymin", "xmax", "ymax", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@query(f"SELECT id, 16e0 * w * h AS largest, x0 + 4e0 * w AS xmax FROM {_BOXES} WHERE k >= 3")
def largest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest part of geometries with several, and where it ends."""
    several = shaped(_boxes(spark, sf_dir).where("k >= 3"), lambda r: wkb.largest_part(_parts(r)))
    return geo.measure(several, tile_key=None).select("id", F.round("area_m2", 6).alias("largest"), "xmax")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two boxes for each part, the second moved by (dx, dy)."""
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 7 + 2).alias("w"), (F.col("p_partkey") % 5 + 2).alias("h"), (F.col("p_partkey") % 9).alias("dx"), (F.col("p_size") % 6).alias("dy"))
    at = F.lit(0)
    one = boxed(spread(p, "p_partkey"), "ga", at, at, F.col("w"), F.col("h"))
    return boxed(one, "gb", F.col("dx"), F.col("dy"), F.col("dx") + F.col("w"), F.col("dy") + F.col("h"))


_TWO = "(SELECT p_partkey, w, h, greatest(w - dx, 0) * greatest(h - dy, 0) AS common FROM (SELECT p_partkey, p_size % 7 + 2 AS w, p_partkey % 5 + 2 AS h, p_partkey % 9 AS dx, p_size % 6 AS dy FROM part))"


@query(f"SELECT p_partkey, cast(common as double) AS overlap, common > 0 AND 10 * common >= w * h AND common >= 8 AS seam FROM {_TWO}")
def geometry_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of intersection, and whether the two are pieces of one (a tenth of the smaller, and 8 units)."""
    over = geo.overlaps(_pairs(spark, sf_dir), "ga", "gb")
    rule = (F.col("overlap") > 0) & (F.round("overlap", 6) * 10 >= F.round(F.least("area_a", "area_b"), 6)) & (F.round("overlap", 6) >= 8)
    return over.select("p_partkey", F.round("overlap", 6).alias("overlap"), rule.alias("seam"))


@query(f"SELECT p_partkey, cast(2 * w * h - common as double) AS area FROM {_TWO}")
def geometry_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unions as geometries, measured again."""
    united = geo.overlaid(_pairs(spark, sf_dir), overlay.unions, "ga", "gb")
    return geo.measure(united.select("p_partkey", "geometry"), tile_key=None).select("p_partkey", F.round("area_m2", 6).alias("area"))


@query(f"SELECT p_partkey, cast(common as double) AS area FROM {_TWO} WHERE common > 0")
def geometry_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersections as geometries; pairs that do not overlap have none."""
    shared = geo.overlaid(_pairs(spark, sf_dir), overlay.intersections, "ga", "gb")
    return geo.measure(shared.select("p_partkey", "geometry"), tile_key=None).where("area_m2 > 1e-9").select("p_partkey", F.round("area_m2", 6).alias("area"))


@query("SELECT p_partkey, w * h / 2e0 AS area, 2 AS parts FROM (SELECT p_partkey, 2 * (1 + p_size % 9) AS w, 2 * (1 + p_partkey % 7) AS h FROM part)")
def geometry_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that cross themselves (a box with two corners exchanged) as two triangles."""
    p = table(spark, sf_dir, "part").select("p_partkey", (2 * (1 + F.col("p_size") % 9)).alias("w"), (2 * (1 + F.col("p_partkey") % 7)).alias("h"))
    crossed = lambda r: overlay.repaired([[np.array([[0, 0], [r["w"], r["h"]], [r["w"], 0], [0, r["h"]], [0, 0]], float)]])
    return geo.measure(shaped(p, crossed), tile_key=None).select("p_partkey", F.round("area_m2", 6).alias("area"), F.col("n_parts").alias("parts"))


_METRES = f"(SELECT id, lon, lat, w, h, lon + w * 0.0001e0 AS lon1, lat + h * 0.0001e0 AS lat1, k FROM {_PLACES})"


@query(f"SELECT id, cast(floor(east * 100 + 0.5e0) as bigint) AS east_cm, cast(floor(north * 100 + 0.5e0) as bigint) AS north_cm FROM {utm_sql(_PLACES)}")
def projected_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in metres of their zone, to the centimetre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            east, north = utm.forward(batch.column("lon").to_numpy(), batch.column("lat").to_numpy(), ZONE)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(np.floor(v * 100 + 0.5).astype(np.int64)) for v in (east, north))], ["id", "east_cm", "north_cm"])

    return _places(spark, sf_dir).mapInArrow(run, "id long, east_cm long, north_cm long")


@query(f"SELECT id, cast(round(lon * 1e7) as bigint) AS lon_e7, cast(round(lat * 1e7) as bigint) AS lat_e7 FROM {_PLACES}")
def projected_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points projected to their zone and back: the same, to a hundredth of a metre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lon, lat = utm.inverse(*utm.forward(batch.column("lon").to_numpy(), batch.column("lat").to_numpy(), ZONE), ZONE)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(np.rint(v * 1e7).astype(np.int64)) for v in (lon, lat))], ["id", "lon_e7", "lat_e7"])

    return _places(spark, sf_dir).mapInArrow(run, "id long, lon_e7 long, lat_e7 long")


_CORNERS = utm_sql(f"(SELECT id, c, CASE WHEN c IN (0, 3) THEN lon ELSE lon1 END AS lon, CASE WHEN c < 2 THEN lat ELSE lat1 END AS lat FROM {_METRES}, (VALUES (0), (1), (2), (3)) v(c))")
_QUADS = f"(SELECT id, c, east, north, lead(east) OVER w AS e1, lead(north) OVER w AS n1, first_value(east) OVER w AS e0, first_value(north) OVER w AS n0 FROM {_CORNERS} WINDOW w AS (PARTITION BY id ORDER BY c))"


@query(f"""SELECT id, cast(floor(abs(sum((east - e0) * (coalesce(n1, n0) - n0) - (coalesce(e1, e0) - e0) * (north - n0)) / 2) + 0.5e0) as bigint) AS area_m2,
cast(floor(sum(sqrt(pow(coalesce(e1, e0) - east, 2) + pow(coalesce(n1, n0) - north, 2))) * 10 + 0.5) as bigint) AS perimeter_dm FROM {_QUADS} GROUP BY id""")
def metric_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas and perimeters of boxes in degrees, in metres of their zone."""
    rows = _places(spark, sf_dir).withColumn("tile_key", F.lit("31TAA_0_0"))
    boxes = shaped(rows, lambda r: wkb.box(r["lon"], r["lat"], r["lon"] + r["w"] * 0.0001, r["lat"] + r["h"] * 0.0001))
    return geo.measure(boxes).select("id", F.floor(F.col("area_m2") + 0.5).cast("long").alias("area_m2"), F.floor(F.col("perimeter_m") * 10 + 0.5).cast("long").alias("perimeter_dm"))


_E2 = "(1 / 298.257223563e0 * (2 - 1 / 298.257223563e0))"
_Q = "(6378137e0 * 6378137e0 / 2 * (1 - {e2}) * (sin(radians({x})) / (1 - {e2} * pow(sin(radians({x})), 2)) + atanh(sqrt({e2}) * sin(radians({x}))) / sqrt({e2})))"


@query(f"SELECT id, cast(floor(radians(lon1 - lon) * ({_Q.format(e2=_E2, x='lat1')} - {_Q.format(e2=_E2, x='lat')}) + 0.5e0) as bigint) AS ellipsoid_m2 FROM {_METRES}")
def ellipsoid_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas on the ellipsoid, which need no zone."""
    boxes = shaped(_places(spark, sf_dir), lambda r: wkb.box(r["lon"], r["lat"], r["lon"] + r["w"] * 0.0001, r["lat"] + r["h"] * 0.0001))
    return geo.ellipsoid_areas(boxes).select("id", F.floor(F.col("ellipsoid_m2") + 0.5).cast("long").alias("ellipsoid_m2"))


@query("SELECT 1e0 AS ratio, true AS steady")
def area_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas in the zone against those on the ellipsoid: one factor (the square of the scale, near 1) does for all."""
    rows = _places(spark, sf_dir).withColumn("tile_key", F.lit("31TAA_0_0"))
    boxes = shaped(rows, lambda r: wkb.box(r["lon"], r["lat"], r["lon"] + r["w"] * 0.0001, r["lat"] + r["h"] * 0.0001))
    out = geo.calibrated(geo.measure(boxes), "area_m2")
    return out.select(F.round("ratio", 2).alias("ratio"), (F.col("spread") < 0.02).alias("steady"))


def _holed(r: dict) -> wkb.Polygons:
    """About 100 m a side, with a hole of w metres a side, and a second part of h times 10 metres a side."""
    m = 1 / 111_111
    x, y, c = r["lon"], r["lat"], 1 / np.cos(np.radians(r["lat"]))
    side = lambda a, b, n: wkb.box(x + a * m * c, y + b * m, x + (a + n) * m * c, y + (b + n) * m)[0][0]
    return [[side(0, 0, 100), side(10, 10, r["w"] % 10 + 1)[::-1]], [side(300, 0, (r["h"] % 7 + 1) * 10)]]


@query(f"SELECT id, CASE WHEN w % 10 + 1 >= 5 THEN 1 ELSE 0 END AS holes, CASE WHEN h % 7 + 1 >= 4 THEN 2 WHEN h % 7 + 1 = 3 THEN NULL ELSE 1 END AS parts FROM {_PLACES} WHERE h % 7 + 1 <> 3")
def tidy_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holes below 20 square metres filled, then parts below 900 dropped (a part of 30 by 30 metres, at the limit, is left out)."""
    rows = _places(spark, sf_dir).where("h % 7 + 1 <> 3").withColumn("tile_key", F.lit("31TAA_0_0"))
    out = geo.measure(geo.tidy(shaped(rows, _holed)))
    return out.select("id", F.col("n_holes").alias("holes"), F.col("n_parts").alias("parts"))


@query("""SELECT id, CASE WHEN wide THEN 2 ELSE 1 END AS parts, CASE WHEN wide THEN -180e0 ELSE x END AS west, CASE WHEN wide THEN 180e0 ELSE x + w END AS east, w * 2e0 AS area
FROM (SELECT *, x + w > 180 AS wide FROM (SELECT o_orderkey AS id, 170e0 + o_orderkey % 10 AS x, 1e0 + o_custkey % 12 AS w FROM orders) WHERE x + w <> 180)""")
def antimeridian_wraps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that reach past 180 degrees cut there; nothing of the area is lost."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.lit(170.0) + F.col("o_orderkey") % 10).alias("x"), (F.lit(1.0) + F.col("o_custkey") % 12).alias("w")).where("x + w <> 180")
    wrapped = shaped(o, lambda r: wkb.wrap_antimeridian(wkb.box(r["x"], 10, r["x"] + r["w"], 12)))
    return geo.measure(wrapped, tile_key=None).select("id", F.col("n_parts").alias("parts"), F.col("xmin").alias("west"), F.col("xmax").alias("east"), F.round("area_m2", 6).alias("area"))


@query(f"SELECT id, id % 1000 AS x0, score AS y0, '[' || w || ',0,' || -w || ',0]' AS dx, '[0,' || h || ',0,' || -h || ']' AS dy, '[5]' AS ring_n, '[1]' AS part_n, true AS same FROM (SELECT id, score, 1 + id % 9 AS w, 1 + score % 7 AS h FROM {SQL})")
def outline_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines on the 2.5 m grid as starts and steps, and whether they decode to what they were."""
    rows = parcels(spark, sf_dir).select("id", (F.col("id") % 1000).alias("x"), F.col("score").alias("y"), (1 + F.col("id") % 9).alias("w"), (1 + F.col("score") % 7).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                box = wkb.box(*(2.5 * v for v in (r["x"], r["y"], r["x"] + r["w"], r["y"] + r["h"])))
                coded = codec.encode(box)
                again = codec.decode(*coded)
                out.append((r["id"], coded[0], coded[1], *("[" + ",".join(map(str, v)) + "]" for v in coded[2:]), wkb.write(again) == wkb.write(box)))
            types = [pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["id", "x0", "y0", "dx", "dy", "ring_n", "part_n", "same"])

    return rows.mapInArrow(run, "id long, x0 long, y0 long, dx string, dy string, ring_n string, part_n string, same boolean")


@query("SELECT p_partkey, 5 AS coordinates, 4e0 * (1 + p_size % 9) * (1 + p_partkey % 7) AS area FROM part")
def simplified_coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with a vertex on each side, and neighbours that share one: simplified together, corners alone are left."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("tile_key"), (2.0 * (1 + F.col("p_size") % 9)).alias("w"), (2.0 * (1 + F.col("p_partkey") % 7)).alias("h"))

    def dense(r: dict, at: int) -> wkb.Polygons:
        x, w, h = at * r["w"], r["w"], r["h"]
        return [[np.array([[x, 0], [x + w / 2, 0], [x + w, 0], [x + w, h / 2], [x + w, h], [x + w / 2, h], [x, h], [x, h / 2], [x, 0]], float)]]

    both = shaped(p, lambda r: dense(r, 0)).withColumn("at", F.lit(0)).unionByName(shaped(p, lambda r: dense(r, 1)).withColumn("at", F.lit(1)))
    out = geo.measure(outlines.simplified(both, 0.5), tile_key=None)
    return out.where("at = 0").select("p_partkey", F.col("n_coordinates").alias("coordinates"), F.round("area_m2", 6).alias("area"))


@query(f"SELECT p.id, p.area AS before, cast(p.area * CASE WHEN p.id % 4 = 0 THEN 2 WHEN p.id % 4 = 1 THEN 1.2e0 ELSE 3 END as bigint) AS after FROM {SQL} p WHERE p.id % 4 <> 1")
def area_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose area changed by more than a quarter."""
    rows = parcels(spark, sf_dir).select("id", "area")
    factor = F.when(F.col("id") % 4 == 0, 2).when(F.col("id") % 4 == 1, F.lit(1.2)).otherwise(3)
    changed = rows.select("id", (F.col("area") * factor).alias("area"))
    return outlines.drift(rows, changed, "id", "area").select("id", "before", F.round("after").cast("long").alias("after"))


@query("SELECT id, k, cast(k as int) AS eighths FROM (SELECT o_orderkey AS id, o_orderkey % 9 AS k FROM orders)")
def land_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels k eighths of which lie on land, on three coasts: inside a cell, on a cell's edge and in a cell that is all land."""
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(o.alias("id"), (o % 9).alias("k"), (45.2 + (F.col("o_custkey") % 500) * F.lit(0.001)).alias("y"))
    # land lies between 1.5 and 4.5 degrees east; a parcel is 0.008 degrees wide
    x = F.lit(1.5) - (8 - F.col("k")) * F.lit(0.001)
    boxes = materialise(release.box_geometry(rows.select("id", "k", x.alias("xmin"), F.col("y").alias("ymin"), (x + 0.008).alias("xmax"), (F.col("y") + 0.008).alias("ymax"))), "land-parcels")
    land = release.box_geometry(spark.createDataFrame([(1.5, 44.5, 3.0, 47.5), (3.0, 44.5, 4.5, 47.5)], "xmin double, ymin double, xmax double, ymax double"))
    return release.land_shares(boxes, land).select("id", "k", F.round(F.col("land_share") * 8).cast("int").alias("eighths"))


@query("SELECT id FROM (SELECT o_orderkey AS id, o_orderkey % 9 AS k FROM orders) WHERE k >= 5")
def sea_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels of which more than half lies on land (those at the limit are left out)."""
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 4").select(o.alias("id"), (F.lit(1.5) - (8 - o % 9) * F.lit(0.001)).alias("xmin"), (45.2 + (F.col("o_custkey") % 500) * F.lit(0.001)).alias("ymin"))
    boxes = materialise(release.box_geometry(rows.withColumns({"xmax": F.col("xmin") + 0.008, "ymax": F.col("ymin") + 0.008})), "land-parcels")
    land = release.box_geometry(spark.createDataFrame([(1.5, 44.5, 4.5, 47.5)], "xmin double, ymin double, xmax double, ymax double"))
    return release.on_land(boxes, land).select("id")


_SQUARES = utm_sql(_PLACES)


@query(f"SELECT id, true AS north, cast(floor(east / 100000) * 100000 as bigint) AS x0, cast(ceil(north / 100000) * 100000 as bigint) AS y1 FROM {_SQUARES}")
def owned_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 km square of each point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = release.square_of(ZONE, batch.column("lon").to_numpy(), batch.column("lat").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(at[:, 1] > 0), pa.array(at[:, 2]), pa.array(at[:, 3])], ["id", "north", "x0", "y1"])

    return _places(spark, sf_dir).mapInArrow(run, "id long, north boolean, x0 long, y1 long")


@query(f"""WITH sq AS (SELECT DISTINCT cast(floor(east / 100000) as bigint) AS x, cast(ceil(north / 100000) as bigint) AS y FROM {_SQUARES}), p AS (SELECT id, cast(floor(east / 100000) as bigint) AS x, cast(ceil(north / 100000) as bigint) AS y FROM {_SQUARES})
SELECT id, CASE WHEN sq.x IS NULL THEN 'nobody' ELSE 'own' END AS owner FROM p LEFT JOIN (SELECT * FROM sq WHERE (x + y) % 2 = 0) sq USING (x, y)""")
def square_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which points' squares their own zone keeps, where it keeps every second one and its neighbours none."""
    places = _places(spark, sf_dir)
    owned = owned_squares(spark, sf_dir).select(F.lit(ZONE).alias("zone"), "north", "x0", "y1").distinct().where("(x0 / 100000 + y1 / 100000) % 2 = 0")
    claimed = release.claimed_points(places.select("id", "lon", "lat"), owned)
    kept = owned_squares(spark, sf_dir).join(owned.select("x0", "y1"), ["x0", "y1"], "left_semi").select("id", F.lit("own").alias("owner"))
    return claimed.where(F.col("claimer").isNull()).select("id").join(kept, "id", "left").select("id", F.coalesce("owner", F.lit("nobody")).alias("owner"))


_TOPS = f"(SELECT k, min(lon) AS a, min(lat) AS b, max(lon) AS c, max(lat) AS d FROM {_PLACES} GROUP BY k)"


@query(f"SELECT k, cast(floor(max(north) * 10 + 0.5e0) as bigint) AS top_dm, cast(floor(min(east) * 10 + 0.5e0) as bigint) AS west_dm FROM {utm_sql(f'(SELECT k, x AS lon, y AS lat FROM (SELECT k, unnest([a, c]) AS x, b, d FROM {_TOPS}), LATERAL (SELECT unnest([b, d]) AS y))')} GROUP BY k")
def tile_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top and west of each footprint in its own projection."""
    f = _places(spark, sf_dir).groupBy("k").agg(F.min("lon").alias("xmin"), F.min("lat").alias("ymin"), F.max("lon").alias("xmax"), F.max("lat").alias("ymax"))
    prints = release.box_geometry(f.withColumn("tile_key", F.concat(F.lit("31TAA_"), F.col("k").cast("string"), F.lit("_0"))))
    out = validation.tile_frames(prints)
    dm = lambda c: F.floor(F.col(c) * 10 + 0.5).cast("long")
    return out.select(F.split("tile_key", "_")[1].cast("long").alias("k"), dm("top_y").alias("top_dm"), dm("west_x").alias("west_dm"))


_HALVES = f"""(SELECT id, k, lon, lat, lon + 0.004e0 AS lon1, lat + 0.003e0 AS lat1, id % 101 AS s FROM {_PLACES} QUALIFY row_number() OVER (PARTITION BY lon, lat ORDER BY id) = 1)"""
_HALF_CORNERS = utm_sql(f"(SELECT id, s, c, CASE WHEN c IN (0, 3) THEN lon ELSE lon1 END AS lon, CASE WHEN c < 2 THEN lat ELSE lat1 END AS lat FROM {_HALVES}, (VALUES (0), (1), (2), (3)) v(c))")
_HALF_QUADS = f"(SELECT id, s, c, east, north, lead(east) OVER w AS e1, lead(north) OVER w AS n1, first_value(east) OVER w AS e0, first_value(north) OVER w AS n0 FROM {_HALF_CORNERS} WINDOW w AS (PARTITION BY id ORDER BY c))"


@query(f"""SELECT '31TAA_0_0-' || id AS id, cast(s as smallint) AS score, cast(floor(abs(sum((east - e0) * (coalesce(n1, n0) - n0) - (coalesce(e1, e0) - e0) * (north - n0)) / 2) / 100 + 0.5e0) as bigint) AS area_100
FROM {_HALF_QUADS} GROUP BY id, s""")
def release_seams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels cut by a tile's edge, as two pieces of two tiles that overlap: the release has each once, whole."""
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy("lon", "lat").orderBy("id"))
    rows = _places(spark, sf_dir).withColumn("r", first).where("r = 1")
    piece = F.explode(F.array(F.struct(F.lit("31TAA_0_0").alias("tile_key"), F.lit(0.0).alias("a"), F.lit(0.0025).alias("b")), F.struct(F.lit("31TBA_0_0").alias("tile_key"), F.lit(0.0015).alias("a"), F.lit(0.004).alias("b"))))
    pieces = rows.select("id", "lon", "lat", piece.alias("p")).select(
        "p.tile_key", F.col("id").alias("parcel_id"), ((F.col("id") % 101) / 100).alias("pf_mean"), F.lit(False).alias("touches_window_edge"),
        (F.col("lon") + F.col("p.a")).alias("xmin"), F.col("lat").alias("ymin"), (F.col("lon") + F.col("p.b")).alias("xmax"), (F.col("lat") + 0.003).alias("ymax"),
    )
    out = release.convert(materialise(release.box_geometry(pieces), "release-tiles"), "parcels", 2025, (0.0, 44.0, 6.0, 50.0))
    # the released area is a float, whose steps of 1/128 square metre move some roundings: the released shape is measured
    return geo.measure(out.select("id", "score", "geometry"), tile_key="id").select("id", "score", F.floor(F.col("area_m2") / 100 + 0.5).cast("long").alias("area_100"))

"""Conversion to a release, zone edges, the sea rule and gates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelspark.functions import cells, utm, wkb
from parcelspark.plans import release

SCHEMA = "tile_key string, parcel_id long, xmin double, ymin double, xmax double, ymax double, pf_mean double, touches_window_edge boolean"
#: A place in zone 34, and metres of a degree there.
LON, LAT = 22.4, 47.25
EAST, NORTH = float(111_320 * np.cos(np.radians(LAT))), 111_170
A, B = "34TEU_0_0", "34TFU_0_0"


def _box(tile, number, east, north, width, height, mean=0.5, cut=False):
    """A parcel some metres east and north of the place."""
    return tile, number, LON + east / EAST, LAT + north / NORTH, LON + (east + width) / EAST, LAT + (north + height) / NORTH, mean, cut


def _convert(spark, rows, **kw):
    df = release.box_geometry(spark.createDataFrame(rows, SCHEMA))
    return {r.id: r for r in release.convert(df, "c", 2025, (22.3, 47.2, 22.5, 47.3), **kw).collect()}


def test_seam_pieces_become_one_and_neighbours_do_not(spark):
    out = _convert(spark, [_box(A, 7, 0, 0, 120, 90, 0.2), _box(B, 3, 80, 0, 120, 90, 0.4)])
    assert list(out) == [f"{A}-7"] and out[f"{A}-7"].score == 30 and out[f"{A}-7"]["metrics:area"] == pytest.approx(200 * 90, rel=0.004)
    out = _convert(spark, [_box(A, 7, 0, 0, 120, 90), _box(B, 3, 120, 0, 120, 90)])
    assert len(out) == 2 and all(r["metrics:area"] == pytest.approx(120 * 90, rel=0.004) for r in out.values())


def test_an_overlap_too_small_joins_nothing(spark):
    # 9 of 100 metres are less than a tenth of either; 2 by 40 metres are less than 100 square metres
    assert len(_convert(spark, [_box(A, 1, 0, 0, 100, 50), _box(B, 2, 91, 0, 100, 50)])) == 2
    assert len(_convert(spark, [_box(A, 1, 0, 0, 60, 40), _box(B, 2, 58, 0, 60, 40)])) == 2


def test_window_edges_within_a_tile(spark):
    rows = [_box(A, 1, 0, 0, 100, 70, 0.6, True), _box(A, 2, 60, 0, 100, 70, 0.8, True)]
    assert list(_convert(spark, rows)) == [f"{A}-1"]
    assert len(_convert(spark, [(*rows[0][:7], False), rows[1]])) == 2


def test_sizes_apply_to_the_final_geometry(spark):
    half = [_box(A, 1, 0, 0, 26, 28), _box(B, 2, 20, 0, 26, 28)]  # 728 each, 1,288 together
    out = _convert(spark, half)
    assert list(out) == [f"{A}-1"] and out[f"{A}-1"]["metrics:area"] == pytest.approx(46 * 28, rel=0.004)
    assert _convert(spark, half[:1]) == {}
    assert len(_convert(spark, [_box(A, 1, 0, 0, 2100, 2300)])) == 1 and _convert(spark, [_box(A, 1, 0, 0, 2100, 2300), _box(B, 2, 1800, 0, 2100, 2300)]) == {}
    with pytest.raises(ValueError, match="duplicate"):
        _convert(spark, [half[0], half[0]])


def test_equator_halves_merge(spark):
    rows = [("36MZA_0_0", 4, 33.51, -0.0012, 33.512, 0.0011, 0.5, False), ("36NZF_0_0", 9, 33.51, -0.001, 33.512, 0.0013, 0.5, False)]
    out = release.convert(release.box_geometry(spark.createDataFrame(rows, SCHEMA)), "c", 2025, (33.0, -1.0, 34.0, 1.0)).collect()
    assert [r.id for r in out] == ["36MZA_0_0-4"]


def test_claimed_pieces_absorb_the_neighbours(spark):
    # zones 33 and 34 meet at 18 degrees east
    rows = [("33UYQ_0_0-2", "33UYQ_0_0", 18.01, 49.1, 18.04, 49.103, 0.3, True), ("34UCV_0_0-8", "34UCV_0_0", 18.02, 49.1, 18.035, 49.103, 0.9, False), ("34UCV_0_0-9", "34UCV_0_0", 18.3, 49.1, 18.31, 49.103, 0.9, False)]
    df = release.box_geometry(spark.createDataFrame(rows, "id string, tile_key string, xmin double, ymin double, xmax double, ymax double, pf_mean double, claimed boolean"))
    out = {r.id: r for r in release.cross_zone(df).collect()}
    assert set(out) == {"33UYQ_0_0-2", "34UCV_0_0-9"} and out["33UYQ_0_0-2"].pf_mean == pytest.approx((0.3 * 2 + 0.9) / 3, abs=1e-4)


def test_ownership_of_zone_edges(spark):
    z33 = release.square_of(33, np.array([18.07]), np.array([49.1]))[0].tolist()
    squares = spark.createDataFrame([(z33[0], bool(z33[1]), z33[2], z33[3])], "zone int, north boolean, x0 long, y1 long")
    points = spark.createDataFrame([(18.07, 49.1), (17.9, 49.1), (21.0, 49.1)], "lon double, lat double")
    got = {r.lon: r.claimer for r in release.claimed_points(points, squares).collect()}
    assert got[18.07] == 33 and got[21.0] is None
    e, _ = utm.forward(np.array([18.06, 18.08]), np.array([49.1, 49.1]), 33)
    rows = [("p", "33UYQ_0_0", True, 18.07, 49.1, float(e[0]), float(e[1])), ("q", "33UYQ_0_0", False, 18.07, 49.1, float(e[0]), float(e[1])), ("r", "33UYQ_0_0", True, 17.9, 49.1, 0.0, 100.0)]
    parcels = spark.createDataFrame(rows, "id string, tile_key string, in_mgrs_square boolean, lon double, lat double, west double, east double")
    assert {r.id: (r.in_utm_zone, r.claimed) for r in release.claims(parcels, squares).collect()} == {"p": (True, True), "q": (False, False), "r": (True, False)}


def test_sea_rule(spark):
    coast = [np.array([[11.0, 54.2], [13.4, 54.2], [13.4, 55.7], [11.0, 55.7], [11.0, 54.2]]), np.array([[12.5, 54.5], [12.5, 54.6], [12.6, 54.6], [12.6, 54.5], [12.5, 54.5]])]
    land = spark.createDataFrame([(bytearray(wkb.write([coast])),)], "geometry binary")
    # inland, at sea, half on the western coast, on the edge of two cells, in the lake, a quarter in the lake
    at = [(11.5, 54.6), (10.2, 54.6), (11.0, 54.9), (12.0, 55.0), (12.55, 54.55), (12.6, 54.5)]
    rows = release.box_geometry(spark.createDataFrame([(str(i), x - 0.002, y - 0.002, x + 0.002, y + 0.002) for i, (x, y) in enumerate(at)], "id string, xmin double, ymin double, xmax double, ymax double"))
    got = {r.id: r.land_share for r in release.land_shares(rows, land).collect()}
    assert [got[str(i)] for i in range(6)] == pytest.approx([1, 0, 0.5, 1, 0, 0.75], abs=0.01)
    assert sorted(r.id for r in release.on_land(rows, land, 0.6).collect()) == ["0", "3", "5"]
    cells = {(r.cx, r.cy): r.whole for r in release.land_cells(land).collect()}
    assert set(cells) == {(x, y) for x in (11, 12, 13) for y in (54, 55)} and not any(cells.values())
    wide = release.land_cells(release.box_geometry(spark.createDataFrame([(10.5, 53.5, 13.0, 56.5)], "xmin double, ymin double, xmax double, ymax double")))
    assert {(r.cx, r.cy) for r in wide.where("whole").collect()} == {(x, y) for x in (11, 12) for y in (54, 55)}


def test_raster_gate_flags(spark):
    schema = "tile_key string, error string, structure string, prov_fingerprint string, prov_tf32 string, prov_gpu string, zero_row_run int, in_nodata_any double, top_field double, next_field double, top_boundary double, next_boundary double, sat255 double"
    good = (None, None, "f", "0", "H100 x", 0, 0.0, 0.1, 0.1, 0.1, 0.1, 0.0)
    rows = [("t1", *good), ("t2", "bad", *good[1:2], None, *good[3:]), ("t3", None, "tiles", "g", "1", "T4", 4096, None, 0.4, 0.1, 0.1, 0.1, 0.3), ("t4", *good), ("x", *good)]
    got = {r.tile_key: r.qa_flags for r in release.raster_gate(spark.createDataFrame(rows, schema), spark.createDataFrame([("t1",), ("t2",), ("t3",), ("t4",), ("t9",)], "tile_key string"), ["H100", "A100"]).collect()}
    assert got == {"t1": "", "t2": "unreadable", "t3": "structure,stale,tf32,gpu,zero_run,top_edge,saturated", "t4": "", "x": "unexpected", "t9": "missing"}


def test_manifests(spark):
    a = spark.createDataFrame([("x", 1, "p"), ("y", 2, "q"), ("z", 3, "r")], "name string, size long, sha256 string")
    b = spark.createDataFrame([("x", 1, "p"), ("y", 2, "s"), ("w", 3, "r")], "name string, size long, sha256 string")
    assert {(r.name, r.status) for r in release.manifest_difference(a, b).collect()} == {("y", "changed"), ("z", "missing"), ("w", "added")}


def test_equal_area_cells(spark):
    df = spark.createDataFrame([(float(x), float(y)) for x in range(-180, 181, 17) for y in range(-90, 91, 9)], "lon double, lat double")
    cell = df.select("lon", "lat", cells.cell_of(F.col("lon"), F.col("lat"), 5).alias("c"))
    lon, lat = cells.centre_of(F.col("c"), 5)
    out = cell.select("c", "lon", "lat", cells.cell_of(lon, lat, 5).alias("again"), cells.outline_of(F.col("c"), 5).alias("o")).collect()
    assert all(r.c == r.again and r.o[1] - 1e-9 <= r.lat <= r.o[3] + 1e-9 for r in out)
    area = {round((r.o[2] - r.o[0]) * (np.sin(np.radians(r.o[3])) - np.sin(np.radians(r.o[1]))), 9) for r in out}
    assert len(area) == 1 and len({r.c >> 58 for r in out}) == 1

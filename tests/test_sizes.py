"""Queries whose layouts and kernels must hold at sizes and keys beyond the smallest tables."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelspark.functions import geo, overlay, wkb
from parcelspark.plans import registry
from parcelspark.sources import formats


def _both(spark, folder, name, **tables):
    """The query's rows and its SQL's, both sorted, on tables that DuckDB writes from SQL."""
    con = duckdb.connect()
    for t, sql in tables.items():
        con.execute(f"copy ({sql}) to '{folder}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    rows = registry.queries()[name](spark, str(folder)).select(*columns).collect()
    return sorted(map(tuple, rows)), sorted(map(tuple, want.fetchall()))


def test_border_parcels_have_places_of_their_own(spark, tmp_path):
    keys = [0, 1, 2_000, 2_001, 4_001, 19_999, 20_000, 20_001, 59_999, 9_999_999]
    got, want = _both(spark, tmp_path, "cross_zone_merges", supplier=f"select unnest({keys}::bigint[]) as s_suppkey")
    assert got == want and len(got) == len(keys)


def test_one_row_group_is_not_one_task(spark):
    # its rows were united by one task, one pair at a time
    assert registry.queries()["geometry_unions"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() > 1


def _star(rng, n):
    turn = np.sort(rng.random(n)) * 2 * np.pi
    p = rng.random(2)[None] + np.column_stack([np.cos(turn), np.sin(turn)]) * (0.3 + rng.random(n))[:, None]
    return [[np.concatenate([p, p[:1]])]]


def test_a_batch_of_overlays_has_the_areas_of_the_slabs():
    rng = np.random.default_rng(3)
    box = lambda: wkb.box(*(c := rng.integers(0, 6, 2)), *(c + rng.integers(1, 6, 2)))
    holed = [[wkb.box(0, 0, 9, 9)[0][0], wkb.box(2, 2, 5, 5)[0][0][::-1]]]
    rows = [[box() for _ in range(k)] for k in (1, 2, 3, 7, 40)] * 8 + [[_star(rng, 9) for _ in range(k)] for k in (2, 3, 60)] * 4 + [[holed, box()], [[], box()], []]
    for row, shape in zip(rows, overlay.unions(rows), strict=True):
        assert wkb.area(shape) == pytest.approx(overlay.union_area(row) if row else 0, abs=1e-6)
    pairs = [(r[0], r[1]) for r in rows if len(r) > 1]
    for pair, area, shape in zip(pairs, overlay.intersection_areas(pairs), overlay.intersections(pairs), strict=True):
        assert area == pytest.approx(overlay.intersection_area(*pair), abs=1e-7) and wkb.area(shape) == pytest.approx(area, abs=1e-6)


def test_geometries_of_any_kind_are_read_in_order():
    import pyarrow as pa

    two, holed = wkb.box(0, 0, 1, 1) + wkb.box(5, 5, 7, 7), [[wkb.box(0, 0, 9, 9)[0][0], wkb.box(2, 2, 5, 5)[0][0][::-1]]]
    shapes = [wkb.box(1, 2, 3, 4), [], two, wkb.box(3, 3, 4, 9), holed, [], wkb.box(0, 0, 2, 2)]
    flat = geo.Flat.read(pa.array([wkb.write(s) for s in [None, *shapes] if s is not None], pa.binary()).slice(1))
    assert [wkb.write(s) for s in flat.shapes(flat.points)] == [wkb.write(s) for s in shapes[1:]]
    assert wkb.boxes(*np.array([[1.0, 2, 3, 4]]).T).to_pylist() == [wkb.write(shapes[0])]


def test_shapefiles_of_boxes_are_written_and_read_at_once(spark, tmp_path):
    boxes = np.random.default_rng(0).integers(0, 50, (70_000, 4)).astype(float)
    boxes[:, 2:] += boxes[:, :2] + 1
    shapes = [wkb.box(*b) for b in boxes[:500]]
    assert formats.shapefile_bytes(shapes) == formats.shapefile_boxes(boxes[:500])
    (tmp_path / "boxes.shp").write_bytes(formats.shapefile_boxes(boxes))
    (tmp_path / "other.shp").write_bytes(formats.shapefile_bytes([*shapes[:2], [[wkb.box(0, 0, 9, 9)[0][0], wkb.box(2, 2, 5, 5)[0][0]]]]))
    rows = formats.shapefile_rows(spark, str(tmp_path)).collect()
    assert "Sort" not in formats.shapefile_rows(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    first = [r for r in rows if r.path.endswith("boxes.shp")]
    assert [(r.xmin, r.ymin, r.xmax, r.ymax) for r in first] == list(map(tuple, boxes)) and {len(bytes(r.geometry)) for r in first} == {93}
    assert [wkb.area(wkb.parse(bytes(r.geometry))) for r in rows if r.path.endswith("other.shp")] == [wkb.area(shapes[0]), wkb.area(shapes[1]), 72]


def test_released_areas_are_not_rounded_twice(spark, tmp_path):
    # areas of which the nearest float lies on the other side of a half
    places = "values (85139, 5287), (136100, 4887), (39102, 1955), (28943, 7623), (127197, 6082), (1, 1)"
    got, want = _both(spark, tmp_path, "release_seams", orders=f"select a::bigint as o_orderkey, b::bigint as o_custkey from ({places}) v(a, b)")
    assert got == want and len(got) == 6


def test_edges_that_nearly_coincide_bound_thin_regions():
    from parcelspark.functions import utm

    rng, pairs = np.random.default_rng(5), []
    for _ in range(600):
        x, y, (w, h, w2, h2) = rng.integers(0, 600) * 10, rng.integers(0, 500) * 10, rng.integers(1, 13, 4)
        pairs.append(tuple(utm.projected(wkb.box(1 + x * 0.0004, 45 + y * 0.0004, 1 + (x + a) * 0.0004, 45 + (y + b) * 0.0004), 31) for a, b in ((w, h), (w2, h2))))
    for pair, area, shape in zip(pairs, overlay.intersection_areas(pairs), overlay.unions([list(p) for p in pairs]), strict=True):
        assert area == pytest.approx(overlay.intersection_area(*pair), abs=1e-2) and wkb.area(shape) == pytest.approx(overlay.union_area(list(pair)), abs=1e-2)


def test_a_chain_beyond_the_limit_goes_without_its_union(spark):
    from parcelspark.plans import release

    # 300 pieces of 0.004 degrees overlap in a row over three blocks; five others make one parcel
    rows = [(f"31T{'AB'[i % 2]}A_0_0", i, 1 + i * 0.002, 45.0, 1.004 + i * 0.002, 45.003, 0.5, False) for i in range(300)]
    rows += [(f"31T{'AB'[i % 2]}A_0_0", 1000 + i, 3 + i * 0.002, 45.0, 3.004 + i * 0.002, 45.003, 0.5, False) for i in range(5)]
    schema = "tile_key string, parcel_id long, xmin double, ymin double, xmax double, ymax double, pf_mean double, touches_window_edge boolean"
    tiles = release.box_geometry(spark.createDataFrame(rows, schema))
    groups = release.seam_groups(release.seam_links(tiles.withColumn("id", F.concat_ws("-", "tile_key", "parcel_id"))))
    assert sorted(r["count"] for r in groups.select("id", "gid").distinct().groupBy("gid").count().collect()) == [5, 300]
    assert release.too_large(groups, 1e6).count() == 1 and release.too_large(groups, 1e9).count() == 0
    assert [r.id for r in release.convert(tiles, "c", 2025, (0.0, 44.0, 6.0, 50.0)).collect()] == ["31TAA_0_0-1000"]

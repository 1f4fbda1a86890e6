"""Windows, outlines, models over blocks, coverage simplification."""

import numpy as np
import pytest

from parcelspark.functions import arrays, overlay, wkb
from parcelspark.plans import outlines


def test_each_parcel_is_kept_by_one_window(spark):
    labels = np.zeros((40, 40), np.int32)
    k = 0
    for r in range(0, 40, 5):
        for c in range(0, 40, 8):
            k += 1
            labels[r : r + 4, c : c + 7] = k
    elev = np.arange(1600.0).reshape(40, 40)
    rows = []
    for r, c, r0, c0, r1, c1 in arrays.windows((40, 40), 20, 6):
        h, w, kind, data = outlines.block(labels[r0:r1, c0:c1])
        rows.append(("31UFS_0_0", r, c, r0, c0, h, w, kind, bytearray(data), bytearray(elev[r0:r1, c0:c1].tobytes())))
    df = spark.createDataFrame(rows, "tile_key string, row int, col int, row0 int, col0 int, height int, width int, dtype string, labels binary, elev binary")
    out = outlines.outlines(df, 20, 6, ["elev"]).collect()
    assert sorted(r.label for r in out) == list(range(1, k + 1))
    for r in out:
        assert r.area_m2 == 28 * 6.25 == wkb.area(wkb.parse(bytes(r.geometry))) and r.elev == pytest.approx(elev[labels == r.label].mean()) and (r.ext_h_px, r.ext_w_px) == (4, 7)


def test_models_run_on_patches(spark):
    x = np.random.default_rng(0).random((50, 37))
    df = spark.createDataFrame([("t", *outlines.block(x)[:3], bytearray(x.tobytes()))], "tile_key string, height int, width int, dtype string, data binary")
    got = np.frombuffer(outlines.predicted(df, lambda p: p, 16, 8).first().scores, np.uint8).reshape(50, 37)
    assert (got == np.rint(x * 255)).all()


def test_tiles_are_simplified_as_coverages(spark):
    y = np.linspace(0, 100, 20)
    edge = np.column_stack([50 + 3 * np.sin(y / 7), y])
    a, b = np.concatenate([[[0, 0]], edge, [[0, 100], [0, 0]]]), np.concatenate([edge[::-1], [[100, 0], [100, 100]], edge[-1:]])
    df = spark.createDataFrame([(t, i, bytearray(wkb.write([[r]]))) for t in ("t1", "t2") for i, r in enumerate((a, b))], "tile_key string, id int, geometry binary")
    out = outlines.simplified(df, 5.0).collect()
    for t in ("t1", "t2"):
        p, q = (wkb.parse(bytes(r.geometry)) for r in sorted((r for r in out if r.tile_key == t), key=lambda r: r.id))
        assert overlay.intersection_area(p, q) == pytest.approx(0, abs=1e-9) and wkb.area(p) + wkb.area(q) == pytest.approx(10_000)
        assert wkb.coordinate_count(p) < len(a)
    before, after = (spark.createDataFrame([(1, 100.0), (2, v)], "id int, area double") for v in (100.0, 60.0))
    assert [r.id for r in outlines.drift(before, after, "id", "area").collect()] == [2]

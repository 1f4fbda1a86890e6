"""Geometry, codec, projection and raster kernels against closed forms and brute force."""

import numpy as np
import pytest

from parcelspark.functions import arrays, codec, overlay, utm, wkb


def test_wkb_round_trip_and_measures():
    p = wkb.box(0, 0, 10, 4) + [[wkb.box(20, 0, 26, 6)[0][0], wkb.box(22, 2, 24, 4)[0][0][::-1]]]
    q = wkb.parse(wkb.write(p))
    assert wkb.area(q) == 40 + 36 - 4 and wkb.perimeter(q) == 28 + 24 + 8 and wkb.bounds(q) == (0, 0, 26, 6)
    assert wkb.coordinate_count(q) == 15 and wkb.parse(None) == [] and wkb.write([]) is None
    assert wkb.centroid(wkb.box(2, 2, 4, 6)) == (3, 4)
    assert wkb.area(wkb.fill_holes(q, 5)) == 76 and wkb.area(wkb.fill_holes(q, 3)) == 72
    assert len(wkb.drop_parts(q, 35)) == 1 and wkb.largest_part(q)[0][0][0, 0] == 0


def test_wrapping_keeps_the_area():
    east = wkb.wrap_antimeridian(wkb.box(179, 0, 182, 2))
    assert wkb.area(east) == 6 and sorted(round(wkb.bounds([p])[0]) for p in east) == [-180, 179]
    assert wkb.area(wkb.wrap_antimeridian(wkb.box(-181, 0, -179, 2))) == 4


def test_utm_known_point_and_round_trip():
    e, n = utm.forward(np.array([6.0]), np.array([60.0]), 32)
    assert abs(e[0] - 332705.179) < 0.002 and abs(n[0] - 6655205.484) < 0.002
    lon, lat = np.random.default_rng(1).uniform([-3, -80], [3, 84], (200, 2)).T
    for zone, south in ((31, False), (31, True)):
        back = utm.inverse(*utm.forward(lon + 3, lat, zone, south), zone, south)
        assert np.abs(back[0] - lon - 3).max() < 1e-9 and np.abs(back[1] - lat).max() < 1e-9


def test_intersections_of_boxes_triangles_and_holes():
    t = [[np.array([[0, 0], [10, 0], [5, 10], [0, 0]], float)]]
    assert overlay.intersection_area(t, [[np.array([[0, 10], [10, 10], [5, 0], [0, 10]], float)]]) == pytest.approx(25)
    ring = [[wkb.box(0, 0, 10, 10)[0][0], wkb.box(3, 3, 7, 7)[0][0]]]
    assert overlay.intersection_area(ring, wkb.box(5, 5, 20, 20)) == pytest.approx(25 - 4)
    assert overlay.union_area([wkb.box(0, 0, 2, 2), wkb.box(1, 1, 3, 3)]) == pytest.approx(7)
    assert overlay.land_fraction(wkb.box(0, 0, 10, 10), [wkb.box(-1, -1, 4, 11), wkb.box(3, -1, 5, 11)]) == pytest.approx(0.5)
    assert overlay.intersection_area(wkb.box(0, 0, 1, 1), wkb.box(1, 0, 2, 1)) == 0


def test_intersections_against_sampling():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = ([[wkb.closed(np.column_stack([np.cos(t), np.sin(t)]) * r[:, None] + c)]] for t, r, c in ((np.sort(rng.uniform(0, 2 * np.pi, 9)), rng.uniform(0.5, 1, 9), rng.uniform(0, 0.4, 2)) for _ in range(2)))
        x, y = rng.uniform(-1.5, 1.5, (2, 20_000))
        share = (wkb.contains(a, x, y) & wkb.contains(b, x, y)).mean() * 9
        assert overlay.intersection_area(a, b) == pytest.approx(share, abs=0.08)


def test_seam_rule_needs_an_overlap():
    assert not overlay.is_seam_pair(0, 10, 10, True) and overlay.is_seam_pair(50, 400, 900, True)
    assert not overlay.is_seam_pair(50, 400, 900, False) and overlay.is_seam_pair(120, 400, 900, False)


def test_codec_is_lossless_and_refuses_other_grids():
    p = [[r * 2.5 for r in q] for q in wkb.box(4, 7, 9, 12) + [[wkb.box(20, 20, 30, 30)[0][0], wkb.box(22, 22, 24, 24)[0][0]]]]
    back = codec.decode(*codec.encode(p))
    assert [[r.tolist() for r in q] for q in back] == [[r.tolist() for r in q] for q in p] and codec.encode([]) is None
    with pytest.raises(ValueError):
        codec.encode(wkb.box(0, 0, 1, 1))


def test_zonal_sums_and_reductions():
    labels = np.repeat(np.repeat(np.array([[1, 2], [3, 3]]), 12, 0), 12, 1)
    layers = {"coarse": np.array([[1.0, np.nan], [3.0, 5.0]]), "fine": np.arange(576.0).reshape(24, 24)}
    out = arrays.zonal_sums(labels, layers, strip=5)
    assert out["n"].tolist() == [0, 144, 144, 288] and out["coarse"][1] == 144 and np.isnan(out["coarse"][2]) and out["coarse"][3] == 144 * 8
    assert out["fine"][3] == layers["fine"][12:].sum()
    mask = np.zeros((9, 6), bool)
    mask[8, 5] = True
    assert arrays.block_any(mask, 4).tolist() == [[False, False], [False, False], [False, True]]
    assert arrays.label_boxes(labels)[3] == (12, 0, 23, 23)


def test_gap_filling_by_brute_force():
    rng = np.random.default_rng(0)
    stack = rng.integers(1, 1000, (4, 12, 11)).astype(np.int16)  # two times of two bands
    stack[rng.random(stack.shape) < 0.75] = -1
    stack[3] = -1
    got = arrays.fill_gaps(stack, -1, window=3, least=0.3, bands=2)
    ways = set()
    for layer, r, c in zip(*np.nonzero(stack == -1)):
        w = stack[layer, max(r - 1, 0) : r + 2, max(c - 1, 0) : c + 2]
        w, other = w[w != -1], stack[(layer + 2) % 4, r, c]
        rest = np.sort(stack[layer][stack[layer] != -1])
        way = 0 if len(w) / 9 >= 0.3 else 1 if other != -1 else 2
        ways.add(way)
        want = (w.mean() if way == 0 else other if way == 1 else rest[(len(rest) - 1) // 2] if len(rest) else 0)
        assert got[layer, r, c] == np.rint(want)
    assert ways == {0, 1, 2} and (got[stack != -1] == stack[stack != -1]).all()
    full = np.ones((4, 3, 3), np.int16)
    assert arrays.fill_gaps(full, -1) is full


def test_pyramid_patches_and_figures():
    x = np.array([[1, 2, 9], [3, 3, 9], [7, 8, 255]], np.uint8)
    assert arrays.halve(x).tolist() == [[2, 9], [8, 255]]
    starts = arrays.patch_starts(100, 32, 16)
    assert starts[0] == 0 and starts[-1] == 68 and max(np.diff(starts)) <= 16
    full = np.random.default_rng(2).random((100, 40))
    blended = arrays.overlap_add(full.shape, [(r, c, full[r : r + 32, c : c + 32]) for r in starts for c in arrays.patch_starts(40, 32, 16)])
    assert np.allclose(blended, full)
    assert arrays.longest_run(np.array([0, 1, 1, 0, 1])) == 2 and arrays.longest_run(np.zeros(0)) == 0
    assert arrays.histogram_percentiles(np.arange(100, dtype=np.uint8), [0.5, 0.99]) == [49, 98]
    assert arrays.slope_degrees(np.arange(0, 300, 30.0)[None].repeat(3, 0))[1, 3] == pytest.approx(45)
    assert arrays.class_map(np.array([[[0, 200, 100]], [[0, 20, 150]]], np.uint8)).tolist() == [[0, 1, 2]]
    near = arrays.distance_within(np.eye(9, dtype=bool)[:, :1] & True, 2)
    assert near[:3, 0].all() and not near[3:].any()


def test_traced_outlines_have_the_pixels_areas():
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 4, (15, 18))
    labels[3:9, 3:9] = 7
    labels[5:7, 5:7] = 0
    for k, polygons in arrays.trace(labels).items():
        assert wkb.area(polygons) == (labels == k).sum()
    assert len(arrays.trace(np.array([[1, 0], [0, 1]]))[1]) == 2


def test_shared_edges_stay_shared():
    y = np.linspace(0, 100, 20)
    edge = np.column_stack([50 + 3 * np.sin(y / 7), y])
    a = np.concatenate([[[0, 0]], edge, [[0, 100], [0, 0]]])
    b = np.concatenate([edge[::-1], [[100, 0], [100, 100]], edge[-1:]])
    p, q = arrays.simplify_shared([a, b], 5.0)
    assert len(p) + len(q) < len(a) + len(b)
    assert overlay.intersection_area([[p]], [[q]]) == pytest.approx(0, abs=1e-9)
    assert abs(wkb.ring_area(p)) + abs(wkb.ring_area(q)) == pytest.approx(10_000)


def test_unions_and_repairs_have_the_measured_areas():
    rng = np.random.default_rng(5)
    for i in range(60):
        if i % 2:
            shapes = [wkb.box(*(c := rng.integers(0, 6, 2)), *(c + rng.integers(1, 5, 2))) for _ in range(4)]
        else:
            shapes = []
            for _ in range(3):
                t, r, c = np.sort(rng.uniform(0, 2 * np.pi, 8)), rng.uniform(0.5, 1, 8), rng.uniform(0, 1.2, 2)
                shapes.append([[wkb.closed(np.column_stack([np.cos(t), np.sin(t)]) * r[:, None] + c)]])
        assert wkb.area(overlay.union(shapes)) == pytest.approx(overlay.union_area(shapes), abs=1e-6)
        assert wkb.area(overlay.intersection(*shapes[:2])) == pytest.approx(overlay.intersection_area(*shapes[:2]), abs=1e-6)
    ring = overlay.union([wkb.box(0, 0, 3, 1), wkb.box(0, 2, 3, 3), wkb.box(0, 0, 1, 3), wkb.box(2, 0, 3, 3)])
    assert [len(p) for p in ring] == [2] and wkb.area(ring) == pytest.approx(8)
    bow = [[np.array([[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]], float)]]
    assert wkb.area(overlay.repaired(bow)) == pytest.approx(2) and len(overlay.repaired(bow)) == 2

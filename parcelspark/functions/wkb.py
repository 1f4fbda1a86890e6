"""Polygons as WKB: parsing, writing, and ring-level edits, in NumPy."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

Ring = np.ndarray
#: A polygon is a list of rings, the first one its shell; a geometry is a list of polygons.
Polygons = list[list[Ring]]
POLYGON, MULTIPOLYGON = 3, 6


def parse(data: bytes | None) -> Polygons:
    """Polygons of a WKB Polygon or MultiPolygon (either byte order); None and empty ones have none."""
    if data is None:
        return []
    at = 0

    def one() -> Polygons:
        nonlocal at
        order = "<" if data[at] else ">"
        kind = struct.unpack_from(order + "I", data, at + 1)[0] & 0xFF
        n = struct.unpack_from(order + "I", data, at + 5)[0]
        at += 9
        if kind == MULTIPOLYGON:
            return [p for _ in range(n) for p in one()]
        if kind != POLYGON:
            raise ValueError(f"geometry type {kind} is no polygon")
        rings = []
        for _ in range(n):
            k = struct.unpack_from(order + "I", data, at)[0]
            rings.append(np.frombuffer(data, order + "f8", 2 * k, at + 4).reshape(-1, 2).astype(np.float64))
            at += 4 + 16 * k
        return [rings] if rings else []

    return one()


def write(polygons: Polygons) -> bytes | None:
    """Little-endian WKB: a Polygon, a MultiPolygon of two or more, or None."""

    def polygon(rings: list[Ring]) -> bytes:
        return b"".join([struct.pack("<BII", 1, POLYGON, len(rings)), *(struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings)])

    if not polygons:
        return None
    if len(polygons) == 1:
        return polygon(polygons[0])
    return struct.pack("<BII", 1, MULTIPOLYGON, len(polygons)) + b"".join(map(polygon, polygons))


def box(x0: float, y0: float, x1: float, y1: float) -> Polygons:
    return [[np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]], float)]]


def rings_of_one_size(points: np.ndarray) -> pa.Array:
    """WKB of polygons of one ring, given as (rows, points, 2)."""
    rows = np.zeros(len(points), [("order", "u1"), ("kind", "<u4"), ("rings", "<u4"), ("points", "<u4"), ("at", "<f8", points.shape[1:])])
    rows["order"], rows["kind"], rows["rings"], rows["points"], rows["at"] = 1, POLYGON, 1, points.shape[1], points
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.dtype.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def boxes(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> pa.Array:
    """WKB of many boxes."""
    return rings_of_one_size(np.stack([np.column_stack([x0, x1, x1, x0, x0]), np.column_stack([y0, y0, y1, y1, y0])], axis=2).astype(float))


def plain_rings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are little-endian polygons of one ring, their points one after the other, and how many each has."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    size = np.diff(ends)
    plain = np.flatnonzero((size >= 13) & (size % 16 == 13) & ~column.is_null().to_numpy(zero_copy_only=False))
    if not len(plain):
        return plain, np.zeros((0, 2)), plain
    head = data[ends[plain][:, None] + np.arange(13)]
    n = np.ascontiguousarray(head[:, 9:]).view("<u4")[:, 0].astype(np.int64)
    same = (head[:, :9] == np.frombuffer(struct.pack("<BII", 1, POLYGON, 1), np.uint8)).all(1) & (16 * n + 13 == size[plain]) & (n > 0)
    plain, n = plain[same], n[same]
    words = np.repeat(ends[plain] + 13 - (np.cumsum(n) - n) * 16, n) + np.arange(n.sum()) * 16
    return plain, np.ascontiguousarray(data[words[:, None] + np.arange(16)]).view("<f8").reshape(-1, 2), n


def closed(ring: Ring) -> Ring:
    return ring if len(ring) and (ring[0] == ring[-1]).all() else np.concatenate([ring, ring[:1]])


def ring_area(ring: Ring) -> float:
    """Signed: counter-clockwise is positive."""
    if len(ring) < 3:
        return 0.0
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def polygon_area(rings: list[Ring]) -> float:
    return abs(ring_area(rings[0])) - sum(abs(ring_area(r)) for r in rings[1:])


def area(polygons: Polygons) -> float:
    return sum(map(polygon_area, polygons))


def perimeter(polygons: Polygons) -> float:
    return float(sum(np.hypot(*np.diff(r, axis=0).T).sum() for p in polygons for r in p))


def bounds(polygons: Polygons) -> tuple[float, float, float, float] | None:
    if not polygons:
        return None
    points = np.concatenate([p[0] for p in polygons])
    return (*points.min(0).tolist(), *points.max(0).tolist())


def centroid(polygons: Polygons) -> tuple[float, float] | None:
    """Of the area; of the vertices where there is no area."""
    if not polygons:
        return None
    total = np.zeros(3)
    for p in polygons:
        for i, r in enumerate(p):
            o = r[0]
            x, y = (r - o).T
            cross = x[:-1] * y[1:] - x[1:] * y[:-1]
            a = cross.sum() / 2
            sign = (1 if i == 0 else -1) * (1 if a >= 0 else -1)
            total += sign * np.array([a, o[0] * a + ((x[:-1] + x[1:]) * cross).sum() / 6, o[1] * a + ((y[:-1] + y[1:]) * cross).sum() / 6])
    if abs(total[0]) < 1e-300:
        return tuple(np.concatenate([p[0][:-1] for p in polygons]).mean(0).tolist())
    return float(total[1] / total[0]), float(total[2] / total[0])


def coordinate_count(polygons: Polygons) -> int:
    return sum(len(r) for p in polygons for r in p)


def fill_holes(polygons: Polygons, least: float, areas=ring_area) -> Polygons:
    """Without holes smaller than `least`; `areas` may measure a ring in another projection."""
    return [[p[0], *(r for r in p[1:] if abs(areas(r)) >= least)] for p in polygons]


def drop_parts(polygons: Polygons, least: float, areas=polygon_area) -> Polygons:
    """Without parts smaller than `least`, holes already filled."""
    return [p for p in polygons if areas(p) >= least]


def largest_part(polygons: Polygons) -> Polygons:
    return [max(polygons, key=polygon_area)] if polygons else []


def contains(polygons: Polygons, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd test of points; those on an edge may fall either way."""
    inside = np.zeros(len(x), bool)
    for r in (r for p in polygons for r in p):
        x0, y0, x1, y1 = r[:-1, 0], r[:-1, 1], r[1:, 0], r[1:, 1]
        across = (y0[None] > y[:, None]) != (y1[None] > y[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            at = x0 + (y[:, None] - y0) * (x1 - x0) / (y1 - y0)
        inside ^= ((across & (x[:, None] < at)).sum(1) % 2).astype(bool)
    return inside


def wrap_antimeridian(polygons: Polygons) -> Polygons:
    """Polygons that reach past 180 degrees, cut there, the far piece shifted back."""
    out: Polygons = []
    for p in polygons:
        x = p[0][:, 0]
        if x.max() <= 180 and x.min() >= -180:
            out.append(p)
            continue
        shift = -360.0 if x.max() > 180 else 360.0
        edge = 180.0 if shift < 0 else -180.0
        for low, moved in ((shift < 0, 0.0), (shift > 0, shift)) if shift < 0 else ((False, 0.0), (True, shift)):
            rings = [clip(r, 0, edge, low) for r in p]
            rings = [r + [moved, 0.0] for r in rings if len(r) >= 4 and abs(ring_area(r)) > 0]
            if rings:
                out.append(rings)
    return out


def clip(ring: Ring, axis: int, limit: float, below: bool) -> Ring:
    """The part of a ring at or below (or above) a limit on one axis."""
    points, out = closed(ring), []
    held = points[:, axis] <= limit if below else points[:, axis] >= limit
    for a, b, ha, hb in zip(points[:-1], points[1:], held[:-1], held[1:], strict=True):
        if ha:
            out.append(a)
        if ha != hb:
            t = (limit - a[axis]) / (b[axis] - a[axis])
            c = a + t * (b - a)
            c[axis] = limit
            out.append(c)
    return closed(np.array(out)) if len(out) >= 3 else np.zeros((0, 2))

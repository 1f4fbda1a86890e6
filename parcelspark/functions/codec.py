"""Lossless outlines on a grid: where a geometry starts, the steps to each next vertex, vertices of each
ring and rings of each part."""

from __future__ import annotations

import numpy as np

from parcelspark.functions.wkb import Polygons

#: Grid step in metres and the part of a step by which a vertex may be off it.
STEP, SLACK = 2.5, 0.01


def encode(polygons: Polygons, step: float = STEP) -> tuple[int, int, list[int], list[int], list[int], list[int]] | None:
    if not polygons:
        return None
    points = np.concatenate([r for p in polygons for r in p]) / step
    grid = np.rint(points)
    if np.abs(points - grid).max() > SLACK:
        raise ValueError("a vertex lies off the grid")
    grid = grid.astype(np.int64)
    d = np.diff(grid, axis=0)
    return int(grid[0, 0]), int(grid[0, 1]), d[:, 0].tolist(), d[:, 1].tolist(), [len(r) for p in polygons for r in p], [len(p) for p in polygons]


def decode(x0: int, y0: int, dx: list[int], dy: list[int], ring_n: list[int], part_n: list[int], step: float = STEP) -> Polygons:
    points = np.cumsum(np.column_stack([[x0, *dx], [y0, *dy]]), axis=0) * step
    rings = np.split(points, np.cumsum(ring_n)[:-1])
    ends = np.cumsum(part_n)
    return [rings[e - n : e] for e, n in zip(ends.tolist(), part_n, strict=True)]

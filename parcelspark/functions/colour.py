"""Colour ramps of scores, and the overview that a map zoom reads."""

from __future__ import annotations

import math

import numpy as np


def _rgb(colour: str) -> tuple[int, int, int]:
    h = colour.lstrip("#")
    return int(h[:2], 16), int(h[2:4], 16), int(h[4:6], 16)


def ramp(colours: list[str], edges: list[float], floor: float) -> tuple[int, list[tuple[int, int, int, int]]]:
    """The first opaque value (0-255) and anchors (value, r, g, b): each colour at the score (in percent) from
    which it holds, the first at the floor, the last up to 255. No colour may come near black, which stands for nothing."""
    if len(colours) != len(edges) + 1 or any(a >= b for a, b in zip(edges, edges[1:], strict=False)):
        raise ValueError("edges rise and are one fewer than colours")
    first = math.ceil(floor * 255)
    if not 1 <= first < round(edges[0] * 2.55):
        raise ValueError("the floor lies between 1 and the first edge")
    anchors = [(first, *_rgb(colours[0])), *((round(e * 2.55), *_rgb(c)) for e, c in zip(edges, colours[1:], strict=True)), (255, *_rgb(colours[-1]))]
    if any(r + g + b < 24 for _, r, g, b in anchors):
        raise ValueError("a colour near black")
    return first, anchors


def painted(values: np.ndarray, first: int, anchors: list[tuple[int, int, int, int]], below: tuple[int, int, int] = (0, 0, 0)) -> np.ndarray:
    """RGB of uint8 values: linear between anchors, `below` under the first opaque value."""
    x = np.array([a[0] for a in anchors])
    table = np.stack([np.interp(np.arange(256), x, [a[i] for a in anchors]) for i in (1, 2, 3)], 1)
    table[:first] = below
    return np.rint(table).astype(np.uint8)[values]


def overview_level(target: float, base: float, factors: list[int], slack: float) -> int:
    """Index of the coarsest overview that is at most `slack` times coarser than the target; -1 is full size."""
    return max((i for i, f in enumerate(factors) if base * f <= target * slack), default=-1)

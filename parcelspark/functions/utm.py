"""Transverse Mercator by Krueger's series (published; below a millimetre within a zone)."""

from __future__ import annotations

import numpy as np

_A, _F = 6378137.0, 1 / 298.257223563
_SCALE, _EAST, _NORTH = 0.9996, 500_000.0, 10_000_000.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def forward(lon: np.ndarray, lat: np.ndarray, zone: int, south: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing in metres; with `south` northings count from the southern false origin."""
    lam, phi = np.radians((np.asarray(lon) - (zone * 6 - 183) + 180) % 360 - 180), np.radians(lat)
    e = 2 * np.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arcsinh(np.sin(lam) / np.hypot(t, np.cos(lam)))
    x, y = eta.copy(), xi.copy()
    for j, a in enumerate(_ALPHA, 1):
        x += a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y += a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return _EAST + _SCALE * _RADIUS * x, (_NORTH if south else 0.0) + _SCALE * _RADIUS * y


def inverse(east: np.ndarray, north: np.ndarray, zone: int, south: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude in degrees."""
    xi = (np.asarray(north) - (_NORTH if south else 0.0)) / (_SCALE * _RADIUS)
    eta = (np.asarray(east) - _EAST) / (_SCALE * _RADIUS)
    x, y = xi.copy(), eta.copy()
    for j, b in enumerate(_BETA, 1):
        x -= b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        y -= b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    chi = np.arcsin(np.clip(np.sin(x) / np.cosh(y), -1, 1))
    phi = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    lam = np.arctan2(np.sinh(y), np.cos(x))
    return (np.degrees(lam) + zone * 6 - 183 + 180) % 360 - 180, np.degrees(phi)


def projected(polygons: list, zone: int, south: bool = False) -> list:
    """Polygons of degrees, in metres of a zone."""
    return [[np.column_stack(forward(r[:, 0], r[:, 1], zone, south)) for r in p] for p in polygons]

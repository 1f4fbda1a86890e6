"""An equal-area grid of cells behind three functions: point to cell, cell to centre, cell to outline.

Resolution r has 60 * 4 ** (r - 1) cells of one area on the sphere: 10 columns by 6 rows in longitude and
sine of latitude, each cut in four at every step. Ids are longs: resolution, row, column. The pentagonal
grid of the same areas is a drop-in for these three functions; cells nest here, there they do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COLUMNS, ROWS = 10, 6


def _counts(resolution: int) -> tuple[int, int]:
    return COLUMNS << (resolution - 1), ROWS << (resolution - 1)


def cell_of(lon: Column, lat: Column, resolution: int) -> Column:
    n, m = _counts(resolution)
    x = F.pmod(F.floor((lon + 180) / 360 * n), F.lit(n))
    y = F.least(F.greatest(F.floor((F.sin(F.radians(lat)) + 1) / 2 * m), F.lit(0)), F.lit(m - 1))
    return (F.lit(resolution << 58) + y * (1 << 29) + x).cast("long")


def _parts(cell: Column) -> tuple[Column, Column]:
    return cell.bitwiseAND(F.lit((1 << 29) - 1)), F.shiftright(cell, 29).bitwiseAND(F.lit((1 << 29) - 1))


def _lat(share: Column) -> Column:
    return F.degrees(F.asin(F.least(F.greatest(share * 2 - 1, F.lit(-1.0)), F.lit(1.0))))


def centre_of(cell: Column, resolution: int) -> tuple[Column, Column]:
    n, m = _counts(resolution)
    x, y = _parts(cell)
    return (x + 0.5) / n * 360 - 180, _lat((y + 0.5) / m)


def outline_of(cell: Column, resolution: int) -> Column:
    """West, south, east, north."""
    n, m = _counts(resolution)
    x, y = _parts(cell)
    return F.array(x / n * 360 - 180, _lat(y / m), (x + 1) / n * 360 - 180, _lat((y + 1) / m))

"""Scalar functions on tile keys, zones, tiles of the web map, sizes and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: UTM zones that depart from six degrees (west, east) in latitude bands V and X.
ODD_ZONES = {("V", 31): (0, 3), ("V", 32): (3, 12), ("X", 31): (0, 9), ("X", 33): (9, 21), ("X", 35): (21, 33), ("X", 37): (33, 42)}
#: Latitude bands of eight degrees from 80 south (X has twelve).
BANDS = "CDEFGHJKLMNPQRSTUVWX"
TILE_KEY = r"^\d{2}[A-Z]{3}_\d+_\d+$"


def zone_of(tile_key: Column) -> Column:
    return F.substring(tile_key, 1, 2)


def is_tile_key(tile_key: Column) -> Column:
    return F.coalesce(tile_key.rlike(TILE_KEY), F.lit(False))


def is_north(tile_key: Column) -> Column:
    return F.substring(tile_key, 3, 1) >= "N"


def utm_epsg(tile_key: Column, hemisphere: bool = False) -> Column:
    """EPSG code of the zone's projection: the northern one, in which both sides of the equator compare,
    or with `hemisphere` the tile's own."""
    number = zone_of(tile_key).try_cast("int")  # null for what is no tile key
    return F.when(is_north(tile_key), 32600 + number).otherwise(32700 + number) if hemisphere else 32600 + number


def band_of(lat: Column) -> Column:
    at = F.least(F.greatest(F.floor((lat + 80) / 8), F.lit(0)), F.lit(len(BANDS) - 1)).cast("int")
    return F.element_at(F.array(*(F.lit(b) for b in BANDS)), at + 1)


def utm_zone(lon: Column, lat: Column) -> Column:
    """Zone number of a point, with the odd zones of the north."""
    out = F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1
    band = band_of(lat)
    for (letter, number), (west, east) in ODD_ZONES.items():
        out = F.when((band == letter) & (lon >= west) & (lon < east), number).otherwise(out)
    return out.cast("int")


def neighbour_zone(zone: Column, step: int) -> Column:
    return (F.pmod(zone - 1 + step, F.lit(60)) + 1).cast("int")


def quarter_start(year: Column, quarter: Column) -> Column:
    return F.make_timestamp(year, quarter * 3 - 2, F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def quarter_end(year: Column, quarter: Column) -> Column:
    return F.timestamp_add("SECOND", F.lit(-1), F.timestamp_add("QUARTER", F.lit(1), quarter_start(year, quarter)))


def map_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Column and row of a web-map tile."""
    n = float(1 << zoom)
    limit = lambda c: F.least(F.greatest(F.floor(c), F.lit(0)), F.lit((1 << zoom) - 1)).cast("int")
    return limit((lon + 180) / 360 * n), limit((1 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2 * n)


def tile_bounds(x: Column, y: Column, zoom: int) -> tuple[Column, Column, Column, Column]:
    """West, south, east, north of a tile."""
    n = float(1 << zoom)
    lon = lambda c: c / n * 360 - 180
    lat = lambda c: F.degrees(F.atan(F.sinh(F.pi() * (1 - c * 2 / n))))
    return lon(x), lat(y + 1), lon(x + 1), lat(y)


def cell_area_km2(resolution: Column) -> Column:
    """Area of an equal-area pentagonal grid cell: the sphere's surface over 60 * 4 ** (resolution - 1)."""
    return F.lit(510_065_621.724) / (60 * F.pow(F.lit(4.0), resolution - 1))


def human_bytes(n: Column) -> Column:
    out, units = F.format_string("%d B", n.cast("long")), ("kB", "MB", "GB", "TB")
    for i, unit in enumerate(units, 1):
        out = F.when(n >= 1000**i, F.format_string(f"%.1f {unit}", n / float(1000**i))).otherwise(out)
    return out


def hive_path(root: str, year: Column, zone: Column) -> Column:
    return F.format_string(root.rstrip("/") + "/year=%d/zone=%s", year.cast("int"), zone)


def multihash(data: Column) -> Column:
    """SHA-256 as a self-describing checksum: code 12, length 20, digest in hex."""
    return F.concat(F.lit("1220"), F.sha2(data.cast("binary"), 256))


def hilbert(x: Column, y: Column, order: int) -> Column:
    """Index of integer cell (x, y) on the Hilbert curve of 2 ** order cells a side, as column arithmetic
    (one struct folded over the levels, so the expression stays small at any order)."""
    levels = F.array(*(F.lit(1 << i).cast("long") for i in reversed(range(order))))
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(a: Column, s: Column) -> Column:
        rx = (a["x"].bitwiseAND(s) > 0).cast("long")
        ry = (a["y"].bitwiseAND(s) > 0).cast("long")
        d = a["d"] + s * s * ((rx * 3).bitwiseXOR(ry))
        # turn the quadrant: low bits alone matter from here on
        lx, ly = F.pmod(a["x"], s), F.pmod(a["y"], s)
        fx, fy = F.when((ry == 0) & (rx == 1), s - 1 - lx).otherwise(lx), F.when((ry == 0) & (rx == 1), s - 1 - ly).otherwise(ly)
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    return F.aggregate(levels, start, step)["d"]

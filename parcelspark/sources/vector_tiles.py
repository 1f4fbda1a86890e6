"""Vector tiles: features by tile, the public tile encoding, and archives of tiles."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.keys import map_tile

#: Fixed value: units of a tile's side.
EXTENT = 4096


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _zigzag(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def tile_bytes(name: str, points: list[tuple[int, int]], properties: list[dict[str, int | str]]) -> bytes:
    """One layer of point features, in tile units, with whole-number and text properties."""
    keys: dict[str, int] = {}
    values: dict[int | str, int] = {}
    features = b""
    for (x, y), row in zip(points, properties, strict=True):
        tags = b"".join(_varint(keys.setdefault(k, len(keys))) + _varint(values.setdefault(v, len(values))) for k, v in row.items())
        geometry = _varint(1 | 1 << 3) + _varint(_zigzag(x)) + _varint(_zigzag(y))
        features += _field(2, _field(2, tags) + _varint(3 << 3) + _varint(1) + _field(4, geometry))
    stored = b"".join(_field(4, _field(1, v.encode()) if isinstance(v, str) else _varint(6 << 3) + _varint(_zigzag(v))) for v in values)
    layer = _varint(15 << 3) + _varint(2) + _field(1, name.encode()) + features + b"".join(_field(3, k.encode()) for k in keys) + stored + _varint(5 << 3) + _varint(EXTENT)
    return _field(3, layer)


def _parts(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        value = number()
        if key & 7 == 2:
            yield key >> 3, data[at : at + value]
            at += value
        else:
            yield key >> 3, value


def tile_features(data: bytes) -> list[tuple[int, int, dict]]:
    """(x, y, properties) of the point features that tile_bytes wrote."""

    def numbers(packed: bytes) -> list[int]:
        out, value, shift = [], 0, 0
        for byte in packed:
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                out.append(value)
                value = shift = 0
        return out

    back = lambda n: n >> 1 ^ -(n & 1)
    out = []
    for number, layer in _parts(data):
        if number != 3:
            continue
        features, keys, values = [], [], []
        for k, v in _parts(layer):
            if k == 2:
                features.append(dict(_parts(v)))
            elif k == 3:
                keys.append(v.decode())
            elif k == 4:
                kind, held = next(_parts(v))
                values.append(held.decode() if kind == 1 else back(held))
        for f in features:
            tags, (_, x, y) = numbers(f.get(2, b"")), numbers(f[4])
            out.append((back(x), back(y), {keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2], strict=True)}))
    return out


def tile_number(z: int, x: int, y: int) -> int:
    """Place of a tile in an archive: levels one after the other, each along the Hilbert curve."""
    n, d = (4**z - 1) // 3, 0
    side = (1 << z) >> 1
    while side:
        rx, ry = int(x & side > 0), int(y & side > 0)
        d += side * side * (3 * rx ^ ry)
        if not ry:
            if rx:
                x, y = side - 1 - (x & side - 1), side - 1 - (y & side - 1)
            x, y = y, x
        x, y, side = x & side - 1, y & side - 1, side >> 1
    return n + d


def archive_bytes(tiles: list[tuple[int, int, int, bytes]], box: tuple[float, float, float, float] = (-180.0, -85.0, 180.0, 85.0)) -> bytes:
    """An archive (version 3, nothing compressed, one directory) of (z, x, y, data)."""
    rows = sorted((tile_number(z, x, y), d) for z, x, y, d in tiles)
    data = b"".join(d for _, d in rows)
    offsets = np.concatenate([[0], np.cumsum([len(d) for _, d in rows])]).tolist()
    ids = [i for i, _ in rows]
    directory = _varint(len(rows)) + b"".join(_varint(b - a) for a, b in zip([0, *ids], ids, strict=False)) + _varint(1) * len(rows) + b"".join(_varint(len(d)) for _, d in rows)
    directory += b"".join(_varint(0 if i else o + 1) for i, o in enumerate(offsets[:-1]))
    meta, zooms = b"{}", [z for z, _, _, _ in tiles] or [0]
    places = [127, len(directory), 127 + len(directory), len(meta), 0, 0, 127 + len(directory) + len(meta), len(data), len(rows), len(rows), len(rows)]
    corners = [round(v * 1e7) for v in box]
    head = b"PMTiles" + bytes([3]) + struct.pack("<11Q", *places) + bytes([1, 1, 1, 1, min(zooms), max(zooms)]) + struct.pack("<4i", *corners) + bytes([min(zooms)]) + struct.pack("<2i", (corners[0] + corners[2]) // 2, (corners[1] + corners[3]) // 2)
    return head + directory + meta + data


def tiles_of(points: DataFrame, lon: Column, lat: Column, zoom: int, columns: list[str]) -> DataFrame:
    """`(z, x, y, n, tile)`: features of each map tile at `zoom`, as one encoded layer of points in order of
    `columns`. A tile's features are gathered, as its format asks; choose a zoom at which they are few."""
    side = float(1 << zoom)
    x, y = map_tile(lon, lat, zoom)
    inside = lambda place, tile: F.least(F.floor((place - tile) * EXTENT), F.lit(EXTENT - 1)).cast("int")
    across, down = (lon + 180) / 360 * side, (1 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2 * side
    rows = points.select(x.alias("x"), y.alias("y"), inside(across, x).alias("px"), inside(down, y).alias("py"), *columns)
    found = rows.groupBy("x", "y").agg(F.array_sort(F.collect_list(F.struct(*columns, "px", "py"))).alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles = [tile_bytes("features", [(r["px"], r["py"]) for r in f], [{c: r[c] for c in columns if r[c] is not None} for r in f]) for f in batch.column("f").to_pylist()]
            z = pa.array([zoom] * len(batch), pa.int32())
            yield pa.RecordBatch.from_arrays([z, batch.column("x"), batch.column("y"), pa.array([len(f) for f in batch.column("f").to_pylist()], pa.int64()), pa.array(tiles, pa.binary())], ["z", "x", "y", "n", "tile"])

    return found.mapInArrow(run, "z int, x int, y int, n long, tile binary")


def archives(tiles: DataFrame, shards: int) -> DataFrame:
    """`(name, content)`: one archive for each shard of tiles (z, x, y, tile), dealt by column and row."""

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table[c].to_pylist() for c in ("z", "x", "y", "tile")), strict=True))
        return pa.table({"name": [f"shard-{table['shard'][0].as_py():04d}.pmtiles"], "content": pa.array([archive_bytes(rows)], pa.binary())})

    return tiles.withColumn("shard", F.pmod(F.col("x") * 31 + F.col("y"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(run, "name string, content binary")

"""Binary formats as rows: shapefiles, TIFF headers, PNG pixels. Files come through Spark's binary reader,
so any store that Spark opens will do."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from parcelspark.functions import wkb


def _parsed(spark: SparkSession, root: str, pattern: str, schema: str, parse: Callable[[bytes], list[tuple]]) -> DataFrame:
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            rows = [(path, *r) for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in parse(data)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root).select("path", "content")
    fields = spark.createDataFrame([], schema).schema.fields
    return files.mapInArrow(run, schema)


def shapefile_polygons(data: bytes) -> list[wkb.Polygons]:
    """Polygons of a .shp file: clockwise rings are shells, others holes of the shell around them."""
    if len(data) < 100 or struct.unpack_from(">i", data, 0)[0] != 9994:
        raise ValueError("no shapefile")
    at, out = 100, []
    while at + 12 <= len(data):
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        record, at = at + 8, at + 8 + size
        kind = struct.unpack_from("<i", data, record)[0]
        if kind == 0:
            continue
        if kind not in (5, 15, 25):
            raise ValueError(f"shape type {kind} is no polygon")
        n_parts, n_points = struct.unpack_from("<2i", data, record + 36)
        starts = [*struct.unpack_from(f"<{n_parts}i", data, record + 44), n_points]
        points = np.frombuffer(data, "<f8", 2 * n_points, record + 44 + 4 * n_parts).reshape(-1, 2)
        rings = [points[a:b].copy() for a, b in zip(starts, starts[1:], strict=False)]
        shells = [[r] for r in rings if wkb.ring_area(r) <= 0]
        for hole in (r for r in rings if wkb.ring_area(r) > 0):
            inside = [s for s in shells if wkb.contains([[s[0]]], hole[:1, 0], hole[:1, 1])[0]]
            (min(inside, key=lambda s: abs(wkb.ring_area(s[0]))) if inside else shells[0] if shells else shells.append([hole]) or shells[-1]).append(hole)
        out.append(shells)
    return out


def shapefile_bytes(shapes: list[wkb.Polygons]) -> bytes:
    """A .shp file of polygons: shells clockwise, holes counter-clockwise."""
    records = []
    for i, polygons in enumerate(shapes, 1):
        rings = [wkb.closed(r if (wkb.ring_area(r) < 0) == (k == 0) else r[::-1]) for p in polygons for k, r in enumerate(p)]
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rings])])
        body = struct.pack("<i4d2i", 5, *wkb.bounds(polygons), len(rings), int(starts[-1])) + starts[:-1].astype("<i4").tobytes() + np.concatenate(rings).astype("<f8").tobytes()
        records.append(struct.pack(">2i", i, len(body) // 2) + body)
    boxes = np.array([wkb.bounds(p) for p in shapes]).reshape(-1, 4)
    return _shapefile(b"".join(records), boxes)


def _shapefile(records: bytes, boxes: np.ndarray) -> bytes:
    extent = [*boxes[:, :2].min(0), *boxes[:, 2:].max(0)] if len(boxes) else [0.0] * 4
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(records)) // 2) + struct.pack("<2i", 1000, 5) + struct.pack("<8d", *extent, 0, 0, 0, 0) + records


#: A record of one ring of five points.
_QUAD = np.dtype([("number", ">i4"), ("words", ">i4"), ("kind", "<i4"), ("box", "<f8", 4), ("parts", "<i4"), ("points", "<i4"), ("start", "<i4"), ("at", "<f8", (5, 2))])


def shapefile_boxes(boxes: np.ndarray) -> bytes:
    """What shapefile_bytes gives for boxes (rows x0, y0, x1, y1), all records at once."""
    rows = np.zeros(len(boxes), _QUAD)
    rows["number"], rows["words"], rows["kind"], rows["box"], rows["parts"], rows["points"] = np.arange(1, len(boxes) + 1), (_QUAD.itemsize - 8) // 2, 5, boxes, 1, 5
    rows["at"][:, :, 0], rows["at"][:, :, 1] = boxes[:, [0, 0, 2, 2, 0]], boxes[:, [1, 3, 3, 1, 1]]
    return _shapefile(rows.tobytes(), boxes)


def _quads(data: bytes) -> np.ndarray | None:
    """The records of a .shp file if each is one clockwise ring of five points."""
    if len(data) < 100 or (len(data) - 100) % _QUAD.itemsize or struct.unpack_from(">i", data, 0)[0] != 9994:
        return None
    rows = np.frombuffer(data, _QUAD, -1, 100) if len(data) > 100 else np.zeros(0, _QUAD)
    like = (rows["words"] == (_QUAD.itemsize - 8) // 2) & (rows["parts"] == 1) & (rows["points"] == 5) & (rows["start"] == 0) & np.isin(rows["kind"], (5, 15, 25))
    d = rows["at"] - rows["at"][:, :1]
    turn = (d[:, :-1, 0] * d[:, 1:, 1] - d[:, 1:, 0] * d[:, :-1, 1]).sum(1)
    return rows if like.all() and (turn <= 0).all() else None


#: Shapes of a file that are handed on at a time.
_PORTION = 1 << 16


def shapefile_rows(spark: SparkSession, root: str) -> DataFrame:
    """`(path, geometry, xmin, ymin, xmax, ymax)` of the shapes in a folder's files, in no order across files."""
    names = ["path", "geometry", "xmin", "ymin", "xmax", "ymax"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = value.as_py()
                quads = _quads(data)
                shapes = [p for p in shapefile_polygons(data) if p] if quads is None else quads["at"]
                for low in range(0, len(shapes), _PORTION):
                    part = shapes[low : low + _PORTION]
                    if quads is None:
                        geometry, box = pa.array(map(wkb.write, part), pa.binary()), np.array([wkb.bounds(p) for p in part])
                    else:
                        geometry, box = wkb.rings_of_one_size(part), np.concatenate([part.min(1), part.max(1)], axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(part), pa.string()), geometry, *(pa.array(box[:, i]) for i in range(4))], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").option("recursiveFileLookup", True).load(root).select("path", "content")
    return files.mapInArrow(run, "path string, geometry binary, xmin double, ymin double, xmax double, ymax double")


def read_shapefile(spark: SparkSession, root: str) -> DataFrame:
    """`(path, geometry, xmin, ymin, xmax, ymax)`, in order of xmin, ymin: what the sea rule reads."""
    return shapefile_rows(spark, root).orderBy("xmin", "ymin")


_TAGS = {256: "width", 257: "height", 258: "bits", 277: "samples", 322: "tile_width", 323: "tile_height", 339: "sample_format", 259: "compression", 254: "subfile"}
_SIZES = {1: ("B", 1), 2: ("c", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 12: ("d", 8), 16: ("Q", 8)}


def tiff_directories(data: bytes) -> list[dict[str, int]]:
    """Sizes, tiling and sample layout of each image of a (Big)TIFF: the full one, then its overviews."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    version = struct.unpack_from(order + "H", data, 2)[0] if order else 0
    if version not in (42, 43):
        raise ValueError("no TIFF")
    big = version == 43
    offset = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)[0]
    out = []
    while offset and len(out) < 64:
        n = struct.unpack_from(order + ("Q" if big else "H"), data, offset)[0]
        at, entry, tags = offset + (8 if big else 2), 20 if big else 12, {}
        for i in range(n):
            tag, kind = struct.unpack_from(order + "HH", data, at + i * entry)
            if tag in _TAGS and kind in _SIZES:
                count = struct.unpack_from(order + ("Q" if big else "I"), data, at + i * entry + 4)[0]
                value, (code, width) = at + i * entry + (12 if big else 8), _SIZES[kind]
                if count * width > (8 if big else 4):
                    value = struct.unpack_from(order + ("Q" if big else "I"), data, value)[0]
                tags[_TAGS[tag]] = struct.unpack_from(order + code[0], data, value)[0]
        out.append(tags)
        offset = struct.unpack_from(order + ("Q" if big else "I"), data, at + n * entry)[0]
    return out


def read_tiff_headers(spark: SparkSession, root: str) -> DataFrame:
    """One row an image: `(path, level, width, height, bits, samples, tile_width, tile_height, compression)`."""
    keys = ("width", "height", "bits", "samples", "tile_width", "tile_height", "compression")
    return _parsed(spark, root, "*.tif", "path string, level int, " + ", ".join(f"{k} int" for k in keys), lambda data: [(i, *(d.get(k) for k in keys)) for i, d in enumerate(tiff_directories(data))])


def header_deviations(header: dict, rules: dict) -> list[str]:
    """Names of the rules' values that a header does not have."""
    return [k for k, v in rules.items() if header.get(k) != v]


def png_pixels(data: bytes) -> np.ndarray:
    """A (h, w, channels) uint8 image of an 8-bit PNG that is not interlaced."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, body, palette = 8, b"", None
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        chunk, at = data[at + 8 : at + 8 + size], at + 12 + size
        if kind == b"IHDR":
            w, h, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += chunk
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    if depth != 8 or interlace:
        raise ValueError("only 8-bit PNG without interlacing")
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    for y in range(h):
        line, above = raw[y, 1:].astype(np.int64), out[y - 1].astype(np.int64) if y else np.zeros(w * channels, np.int64)
        method = raw[y, 0]
        if method == 0:
            out[y] = line
        elif method == 2:
            out[y] = line + above & 255
        elif method == 1:
            out[y] = (line.reshape(w, channels).cumsum(0) & 255).ravel()
        else:
            row = np.zeros(w * channels + channels, np.int64)
            up = np.concatenate([np.zeros(channels, np.int64), above])
            for i in range(channels, len(row)):
                a, b, c = row[i - channels], up[i], up[i - channels]
                if method == 3:
                    guess = (a + b) // 2
                else:
                    d = (abs(b - c), abs(a - c), abs(a + b - 2 * c))
                    guess = a if d[0] <= d[1] and d[0] <= d[2] else b if d[1] <= d[2] else c
                row[i] = line[i - channels] + guess & 255
            out[y] = row[channels:]
    image = out.reshape(h, w, channels)
    return palette[image[:, :, 0]] if colour == 3 else image


def read_png_stats(spark: SparkSession, root: str) -> DataFrame:
    """`(path, width, height, ink, mean)`: share of pixels that are not the commonest colour, and mean value."""

    def stats(data: bytes) -> list[tuple]:
        image = png_pixels(data)
        _, n = np.unique(image.reshape(-1, image.shape[2]), axis=0, return_counts=True)
        return [(image.shape[1], image.shape[0], float(1 - n.max() / n.sum()), float(image.mean()))]

    return _parsed(spark, root, "*.png", "path string, width int, height int, ink double, mean double", stats)


def pmtiles_header(data: bytes) -> dict[str, float]:
    """Counts, zooms and bounds of a tile archive (version 3), and where its root directory is."""
    if data[:7] != b"PMTiles" or data[7] != 3:
        raise ValueError("no tile archive")
    root, size = struct.unpack_from("<2Q", data, 8)
    addressed, entries, contents = struct.unpack_from("<3Q", data, 72)
    west, south, east, north = (x / 1e7 for x in struct.unpack_from("<4i", data, 102))
    return {"root": root, "root_size": size, "tiles": addressed, "entries": entries, "contents": contents, "packing": data[97], "min_zoom": data[100], "max_zoom": data[101], "west": west, "south": south, "east": east, "north": north}


def pmtiles_directory(data: bytes, packing: int = 1) -> list[tuple[int, int, int, int]]:
    """(first tile id, tiles, size, offset) of a directory's entries; run length 0 points to a further directory."""
    if packing == 2:
        data = zlib.decompress(data, 31)
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

    n = number()
    ids = np.cumsum([number() for _ in range(n)]).tolist() if n else []
    runs, sizes = [number() for _ in range(n)], [number() for _ in range(n)]
    offsets: list[int] = []
    for i in range(n):
        x = number()
        offsets.append(offsets[-1] + sizes[i - 1] if x == 0 and i else x - 1)
    return list(zip(ids, runs, sizes, offsets, strict=True))


def read_pmtiles(spark: SparkSession, root: str) -> DataFrame:
    """One row an archive: `(path, tiles, entries, min_zoom, max_zoom, west, south, east, north, largest)`; largest is
    the size of the largest tile that the root directory names."""

    def parse(data: bytes) -> list[tuple]:
        h = pmtiles_header(data)
        directory = pmtiles_directory(data[h["root"] : h["root"] + h["root_size"]], h["packing"])
        return [(h["tiles"], h["entries"], h["min_zoom"], h["max_zoom"], h["west"], h["south"], h["east"], h["north"], max((s for _, r, s, _ in directory if r), default=0))]

    return _parsed(spark, root, "*.pmtiles", "path string, tiles long, entries long, min_zoom int, max_zoom int, west double, south double, east double, north double, largest long", parse)


def png_bytes(image: np.ndarray) -> bytes:
    """An 8-bit PNG of a (h, w, 1, 3 or 4) uint8 image."""
    h, w, c = image.shape
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    lines = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, w * c)], axis=1)
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 9)) + chunk(b"IEND", b"")


def tiff_bytes(bands: np.ndarray, tile: int = 256, factors: tuple[int, ...] = (4, 8, 16, 32, 64)) -> bytes:
    """A tiled, deflated TIFF of (bands, h, w) whole numbers with overviews of area means, each level from the one
    before; levels of less than a pixel are left out."""
    from parcelspark.functions.arrays import area_mean

    levels, (h, w) = [bands], bands.shape[1:]
    for f in (f for f in factors if h // f and w // f):
        levels.append(np.stack([area_mean(b, (-(-h // f), -(-w // f))) for b in levels[-1]]))
    out = bytearray(struct.pack("<2sHI", b"II", 42, 8))
    for i, x in enumerate(levels):
        n, rows, cols = x.shape
        across, down = -(-cols // tile), -(-rows // tile)
        padded = np.zeros((n, down * tile, across * tile), x.dtype.newbyteorder("<"))
        padded[:, :rows, :cols] = x
        blocks = [zlib.compress(padded[:, r * tile : r * tile + tile, c * tile : c * tile + tile].transpose(1, 2, 0).tobytes(), 6) for r in range(down) for c in range(across)]
        tags: list[tuple[int, int, list[int]]] = [
            (254, 4, [int(i > 0)]), (256, 4, [cols]), (257, 4, [rows]), (258, 3, [8 * x.itemsize] * n), (259, 3, [8]), (262, 3, [1]), (277, 3, [n]), (284, 3, [1]), (322, 4, [tile]), (323, 4, [tile]),
            (324, 4, [0] * len(blocks)), (325, 4, [len(b) for b in blocks]), (338, 3, [0] * (n - 1)), (339, 3, [2 if x.dtype.kind == "i" else 1] * n),
        ]
        tags = [t for t in tags if t[2]]
        start, spill = len(out), len(out) + 2 + 12 * len(tags) + 4
        width = {3: 2, 4: 4}
        extra = sum(width[k] * len(v) for _, k, v in tags if width[k] * len(v) > 4)
        at = spill + extra
        for t in tags:
            if t[0] == 324:
                for j, b in enumerate(blocks):
                    t[2][j] = at
                    at += len(b)
        entries, beyond = b"", b""
        for tag, kind, values in tags:
            raw = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
            entries += struct.pack("<HHI", tag, kind, len(values)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", spill + len(beyond)))
            beyond += raw if len(raw) > 4 else b""
        out += struct.pack("<H", len(tags)) + entries + struct.pack("<I", at if i + 1 < len(levels) else 0) + beyond + b"".join(blocks)
        if start % 2 and i:
            raise AssertionError("an image must start at an even place")
        if len(out) % 2 and i + 1 < len(levels):
            out[start + 2 + 12 * len(tags) : start + 6 + 12 * len(tags)] = struct.pack("<I", at + 1)
            out += b"\0"
    return bytes(out)


def tiff_pixels(data: bytes, level: int = 0) -> np.ndarray:
    """Bands of one image of a file that tiff_bytes wrote: the check that what was written reads back."""
    offset = struct.unpack_from("<I", data, 4)[0]
    for _ in range(level):
        n = struct.unpack_from("<H", data, offset)[0]
        offset = struct.unpack_from("<I", data, offset + 2 + 12 * n)[0]
    found = {}
    for i in range(struct.unpack_from("<H", data, offset)[0]):
        tag, kind, count = struct.unpack_from("<HHI", data, offset + 2 + 12 * i)
        size = {3: 2, 4: 4}[kind] * count
        at = offset + 10 + 12 * i if size <= 4 else struct.unpack_from("<I", data, offset + 10 + 12 * i)[0]
        found[tag] = struct.unpack_from(f"<{count}{'H' if kind == 3 else 'I'}", data, at)
    cols, rows, n, tile = found[256][0], found[257][0], found[277][0], found[322][0]
    across, down = -(-cols // tile), -(-rows // tile)
    kind = np.dtype(f"<{'i' if found[339][0] == 2 else 'u'}{found[258][0] // 8}")
    out = np.zeros((n, down * tile, across * tile), kind)
    for j, (at, size) in enumerate(zip(found[324], found[325], strict=True)):
        r, c = divmod(j, across)
        out[:, r * tile : r * tile + tile, c * tile : c * tile + tile] = np.frombuffer(zlib.decompress(data[at : at + size]), kind).reshape(tile, tile, n).transpose(2, 0, 1)
    return out[:, :rows, :cols]

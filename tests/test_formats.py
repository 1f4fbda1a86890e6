"""Binary formats, paging, colours, validation."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelspark.functions import colour, wkb
from parcelspark.plans import validation
from parcelspark.sources import formats, paging


def _shp(polygons):
    body = b""
    for i, rings in enumerate(polygons):
        points = np.concatenate(rings)
        starts = np.cumsum([0, *(len(r) for r in rings)])[:-1]
        content = struct.pack("<i4d2i", 5, *points.min(0), *points.max(0), len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + points.astype("<f8").tobytes()
        body += struct.pack(">2i", i + 1, len(content) // 2) + content
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + body


def test_shapefiles(spark, tmp_path):
    shell, hole = wkb.box(0, 0, 10, 10)[0][0], wkb.box(2, 2, 4, 4)[0][0]
    (tmp_path / "land.shp").write_bytes(_shp([[shell[::-1], hole], [wkb.box(-5, 0, -3, 1)[0][0][::-1]]]))
    rows = formats.read_shapefile(spark, str(tmp_path)).collect()
    assert [r.xmin for r in rows] == [-5, 0] and wkb.area(wkb.parse(bytes(rows[1].geometry))) == 96
    with pytest.raises(ValueError):
        formats.shapefile_polygons(b"x" * 200)


def _tiff(big, order="<"):
    images = [{256: 512, 257: 300, 258: 8, 277: 2, 322: 256, 323: 256, 259: 8}, {256: 256, 257: 150, 258: 8, 277: 2, 322: 256, 323: 256, 259: 8}]
    out = struct.pack(order + "2sHHHQ", b"II" if order == "<" else b"MM", 43, 8, 0, 16) if big else struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 8)
    for i, tags in enumerate(images):
        size = (8 + 20 * len(tags) + 8) if big else (2 + 12 * len(tags) + 4)
        following = len(out) + size if i + 1 < len(images) else 0
        out += struct.pack(order + ("Q" if big else "H"), len(tags))
        for k, v in sorted(tags.items()):
            out += struct.pack(order + "HHQHHI", k, 3, 1, v, 0, 0) if big else struct.pack(order + "HHIHH", k, 3, 1, v, 0)
        out += struct.pack(order + ("Q" if big else "I"), following)
    return out


def test_tiff_headers(spark, tmp_path):
    for i, (big, order) in enumerate([(False, "<"), (True, "<"), (False, ">")]):
        (tmp_path / f"{i}.tif").write_bytes(_tiff(big, order))
    rows = formats.read_tiff_headers(spark, str(tmp_path)).collect()
    assert len(rows) == 6 and {(r.level, r.width, r.height, r.samples, r.tile_width) for r in rows} == {(0, 512, 300, 2, 256), (1, 256, 150, 2, 256)}
    assert formats.header_deviations({"width": 5, "bits": 8}, {"width": 6, "bits": 8}) == ["width"]


def _png(image, method):
    h, w, c = image.shape
    flat, lines = image.reshape(h, w * c).astype(int), b""
    for y in range(h):
        up = flat[y - 1] if y else np.zeros(w * c, int)
        left = np.concatenate([np.zeros(c, int), flat[y][:-c]])
        corner = np.concatenate([np.zeros(c, int), up[:-c]])
        p = left + up - corner
        d = np.abs(np.stack([p - left, p - up, p - corner]))
        paeth = np.where((d[0] <= d[1]) & (d[0] <= d[2]), left, np.where(d[1] <= d[2], up, corner))
        guess = [0 * up, left, up, (left + up) // 2, paeth][method]
        lines += bytes([method]) + ((flat[y] - guess) & 255).astype(np.uint8).tobytes()
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("method", range(5))
def test_png_filters(method):
    image = np.random.default_rng(method).integers(0, 256, (7, 9, 3 if method % 2 else 4), dtype=np.uint8)
    assert (formats.png_pixels(_png(image, method)) == image).all()


def test_png_stats(spark, tmp_path):
    image = np.zeros((4, 5, 3), np.uint8)
    image[1, 1] = 255
    (tmp_path / "a.png").write_bytes(_png(image, 0))
    r = formats.read_png_stats(spark, str(tmp_path)).first()
    assert (r.width, r.height) == (5, 4) and r.ink == pytest.approx(1 / 20)


def _server():
    def answer(method, url, body):  # local, so that it travels to the workers by value
        at = (body or {}).get("at", 0)
        links = [{"rel": "next", "method": "POST", "body": {"at": at + 2}, "merge": True}] if at + 2 < 5 else []
        return {"numberMatched": 5, "features": [{"i": i, "q": body["q"]} for i in range(at, min(at + 2, 5))], "links": links}

    return answer


def test_paging(spark):
    assert [f["i"] for f in paging.pages(_server(), "u", {"q": 1})] == list(range(5))
    assert paging.search(spark, _server(), "u", [{"q": 1}, {"q": 2}]).count() == 10
    stuck = lambda m, u, b: {"features": [{}], "links": [{"rel": "next", "href": "u2"}]}
    with pytest.raises(RuntimeError, match="advance"):
        list(paging.pages(stuck, "u", {}))
    with pytest.raises(RuntimeError, match="reports"):
        list(paging.pages(lambda m, u, b: {"numberMatched": 3, "features": [{}]}, "u", {}))
    with pytest.raises(paging.Absent):
        paging.checked_status(404)
    with pytest.raises(ConnectionError):
        paging.checked_status(403)
    paging.checked_status(200)


def test_colours_and_overviews():
    first, anchors = colour.ramp(["#d73027", "#fee08b", "#1a9850"], [40, 80], 0.2)
    rgb = colour.painted(np.array([0, first, 102, 255], np.uint8), first, anchors)
    assert rgb[0].tolist() == [0, 0, 0] and rgb[1].tolist() == [0xD7, 0x30, 0x27] and rgb[2].tolist() == [0xFE, 0xE0, 0x8B] and rgb[3].tolist() == [0x1A, 0x98, 0x50]
    with pytest.raises(ValueError):
        colour.ramp(["#000000", "#ffffff"], [50], 0.2)
    assert colour.overview_level(152.87, 2.5, [4, 8, 16, 32, 64], 1.1) == 4 and colour.overview_level(2.5, 2.5, [4], 1.0) == -1


def test_released_files(spark, tmp_path):
    bow = wkb.write([[np.array([[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]], float)]])

    def write(name, areas, scores, geometry, codec="zstd", drop=()):
        t = pa.table({c: v for c, v in {"id": ["a", "b"], "collection": ["c"] * 2, "geometry": pa.array([geometry] * 2, pa.binary()), "bbox": [{"xmin": 0.0}] * 2, "metrics:area": pa.array(areas, pa.float32()), "metrics:perimeter": pa.array([1.0] * 2, pa.float32()), "score": pa.array(scores, pa.uint8()), "determination:datetime": [None] * 2, "determination:method": ["m"] * 2}.items() if c not in drop})
        pq.write_table(t, tmp_path / f"{name}.parquet", compression=codec)

    good = wkb.write(wkb.box(0, 0, 1, 1))
    write("good", [5, 6], [1, 100], good)
    write("area", [5, None], [1, 100], good)
    write("score", [5, 6], [1, 101], good)
    write("codec", [5, 6], [1, 2], good, "snappy")
    write("column", [5, 6], [1, 2], good, drop=("score",))
    write("shape", [5, 6], [1, 2], bow)
    (tmp_path / "torn.parquet").write_bytes(b"PAR1xx")
    got = {}
    for r in validation.file_problems(spark, str(tmp_path)).collect():
        got.setdefault(r.path.rsplit("/", 1)[1].split(".")[0], []).append(r.problem)
    assert set(got) == {"area", "score", "codec", "column", "shape", "torn"} and got["area"] == ["area not above 0 in sample"] and got["codec"] == ["compression SNAPPY"]


def test_zone_edges_and_frames(spark):
    rows = spark.createDataFrame([("31A-1", 5.99, 50.0, 6.01, 50.01), ("32A-1", 5.995, 50.0, 6.01, 50.01), ("32A-2", 7.0, 50.0, 7.01, 50.01), ("34A-1", 5.99, 50.0, 6.01, 50.01)], "id string, xmin double, ymin double, xmax double, ymax double")
    assert [(r.a, r.b) for r in validation.zone_edge_pairs(rows).collect()] == [("31A-1", "32A-1")]
    frame = validation.tile_frames(spark.createDataFrame([("31UFS_0_0", bytearray(wkb.write(wkb.box(3.0, 51.0, 4.0, 52.0))))], "tile_key string, geometry binary")).first()
    assert frame.west_x == pytest.approx(500_000, abs=1) and 5.75e6 < frame.top_y < 5.77e6
    near = [("t", 100.0, 9900.0)] * 40 + [("t", 100.0, 7000.0)] * 6 + [("u", 100.0, 7000.0)] * 120
    frames = spark.createDataFrame([("t", 10_000.0, 0.0), ("u", 10_000.0, 0.0)], "tile_key string, top_y double, west_x double")
    assert {r.tile_key: r.state for r in validation.north_edges(spark.createDataFrame(near, "tile_key string, x double, y double"), frames).collect()} == {"t": "pileup", "u": "gap"}


def _varint(n):
    out = b""
    while n >= 128:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def test_tile_archives(spark, tmp_path):
    entries = [(0, 1, 100, 0), (1, 3, 700, 100), (300, 1, 50, 0)]
    directory = _varint(3) + b"".join(map(_varint, [0, 1, 299])) + b"".join(_varint(e[1]) for e in entries) + b"".join(_varint(e[2]) for e in entries) + b"".join(map(_varint, [1, 0, 1]))
    packed = zlib.compressobj(wbits=31)
    packed = packed.compress(directory) + packed.flush()
    head = bytearray(127)
    head[:8] = b"PMTiles\x03"
    struct.pack_into("<2Q", head, 8, 127, len(packed))
    struct.pack_into("<3Q", head, 72, 5, 3, 3)
    head[97], head[100], head[101] = 2, 0, 9
    struct.pack_into("<4i", head, 102, -1_800_000_000, -850_000_000, 1_800_000_000, 850_000_000)
    (tmp_path / "a.pmtiles").write_bytes(bytes(head) + packed)
    r = formats.read_pmtiles(spark, str(tmp_path)).first()
    assert (r.tiles, r.entries, r.min_zoom, r.max_zoom, r.largest) == (5, 3, 0, 9, 700) and r.west == -180
    assert formats.pmtiles_directory(directory) == entries


def test_written_rasters_read_back(spark):
    from parcelspark.functions import arrays
    from parcelspark.plans import outlines

    x = np.random.default_rng(0).integers(0, 256, (2, 150, 203), dtype=np.uint8)
    data = formats.tiff_bytes(x, 64)
    assert (formats.tiff_pixels(data) == x).all()
    found = formats.tiff_directories(data)
    assert [(d["width"], d["height"]) for d in found] == [(203, 150), (51, 38), (26, 19), (13, 10), (7, 5), (4, 3)] and found[0]["samples"] == 2
    assert (formats.tiff_pixels(data, 1)[0] == arrays.area_mean(x[0], (38, 51))).all()
    df = spark.createDataFrame([("t", 150, 203, "|u1", bytearray(x.tobytes()))], "tile_key string, height int, width int, dtype string, data binary")
    assert (formats.tiff_pixels(bytes(outlines.score_rasters(df).first().tiff)) == x).all()
    one = df.withColumn("data", F.substring("data", 1, 150 * 203))
    png = formats.png_pixels(bytes(outlines.thumbnails(one, 64, ["#d73027", "#fee08b", "#1a9850"], [40, 80], 0.2).first().png))
    assert png.shape == (38, 51, 3)

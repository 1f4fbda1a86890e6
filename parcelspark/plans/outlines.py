"""From label rasters to parcels, models over raster blocks, coverage simplification by tile."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import arrays, wkb
from parcelspark.sources.readers import checked

#: Metres of a pixel.
PIXEL = 2.5


def block(values: np.ndarray) -> tuple[int, int, str, bytes]:
    """A two-dimensional array as (height, width, dtype, data)."""
    return values.shape[0], values.shape[1], values.dtype.str, np.ascontiguousarray(values).tobytes()


def unblock(height: int, width: int, dtype: str, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.dtype(dtype)).reshape(height, width)


def outlines(blocks: DataFrame, core: int, halo: int, layers: list[str]) -> DataFrame:
    """Parcels of window blocks (tile_key, row, col: the core's corner; row0, col0: the block's; height, width,
    dtype, labels, and a float64 layer of the same shape for each name in `layers`).

    A row for each label whose centroid its window's core holds: geometry (columns and rows as x and y, times
    the pixel), area, parts, extents, whether the window cuts it, and each layer's mean (NaN if any is NaN). A block that
    reaches further than `halo` beyond its core is an error.
    """
    schema = "tile_key string, row int, col int, label int, geometry binary, area_m2 double, n_parts int, ext_h_px int, ext_w_px int, touches_window_edge boolean" + "".join(f", {c} double" for c in layers)
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                labels = unblock(r["height"], r["width"], r["dtype"], r["labels"])
                kept = arrays.window_parcels(labels, (r["row0"], r["col0"]), (r["row"], r["col"], r["row"] + core, r["col"] + core))
                sums = arrays.zonal_sums(labels, {c: unblock(r["height"], r["width"], "<f8", r[c]) for c in layers})
                boxes = arrays.label_boxes(labels)
                for k, (polygons, cut) in kept.items():
                    a, b, c, d = boxes[k]
                    shape = [[ring * PIXEL for ring in p] for p in polygons]
                    out.append((r["tile_key"], r["row"], r["col"], k, wkb.write(shape), float(sums["n"][k]) * PIXEL**2, len(polygons), c - a + 1, d - b + 1, cut, *(float(sums[x][k] / sums["n"][k]) for x in layers)))
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), *[pa.float64()] * len(layers)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names)

    core_in = lambda corner, size: (F.col(corner[0]) >= F.col(corner[1])) & (F.col(corner[0]) - F.col(corner[1]) <= halo) & (F.col(corner[1]) + F.col(size) <= F.col(corner[0]) + core + halo)
    return checked(blocks, rows_of_core_and_halo=core_in(("row", "row0"), "height"), columns_of_core_and_halo=core_in(("col", "col0"), "width")).mapInArrow(run, schema)


def predicted(blocks: DataFrame, model: Callable[[np.ndarray], np.ndarray], patch: int, stride: int) -> DataFrame:
    """`blocks` (tile_key, height, width, dtype, data) with `scores`: the model run on overlapping patches, blended
    under a Hann window and written as bytes (round of 255 times the probability)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                x = unblock(r["height"], r["width"], r["dtype"], r["data"])
                starts = [(i, j) for i in arrays.patch_starts(x.shape[0], patch, stride) for j in arrays.patch_starts(x.shape[1], patch, stride)]
                blended = arrays.overlap_add(x.shape, [(i, j, model(x[i : i + patch, j : j + patch])) for i, j in starts])
                out.append(np.rint(blended * 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "scores"])

    return blocks.mapInArrow(run, blocks.withColumn("scores", F.lit(b"")).schema)


def simplified(rows: DataFrame, tolerance: float, geometry: str = "geometry", by: str = "tile_key") -> DataFrame:
    """Geometries (in metres) of each tile simplified as one coverage: shared edges stay shared. A tile is the
    unit that segmentation wrote, so its rows fit a task."""
    place = rows.columns.index(geometry)

    def run(table: pa.Table) -> pa.Table:
        shapes = [wkb.parse(x) for x in table[geometry].to_pylist()]
        flat = iter(arrays.simplify_shared([r for p in shapes for part in p for r in part], tolerance))
        new = [wkb.write([[next(flat) for _ in part] for part in p]) for p in shapes]
        return table.set_column(place, geometry, pa.array(new, pa.binary()))

    return rows.groupBy(by).applyInArrow(run, rows.schema)


def drift(before: DataFrame, after: DataFrame, key: str, area: str, limit: float = 0.25) -> DataFrame:
    """Rows whose area changed by more than a share."""
    a, b = before.select(key, F.col(area).alias("before")), after.select(key, F.col(area).alias("after"))
    return a.join(b, key).where(F.abs(F.col("after") - F.col("before")) > limit * F.col("before"))


def thumbnails(blocks: DataFrame, size: int, colours: list[str], edges: list[float], floor: float) -> DataFrame:
    """`(tile_key, png)`: score blocks (tile_key, height, width, dtype, data) as area means of at most `size`
    pixels a side, painted by the ramp."""
    from parcelspark.functions.colour import painted, ramp
    from parcelspark.sources.formats import png_bytes

    first, anchors = ramp(colours, edges, floor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                x = unblock(r["height"], r["width"], r["dtype"], r["data"])
                f = max(1, -(-max(x.shape) // size))
                out.append(png_bytes(painted(arrays.area_mean(x, (-(-x.shape[0] // f), -(-x.shape[1] // f))), first, anchors)))
            yield pa.RecordBatch.from_arrays([batch.column("tile_key"), pa.array(out, pa.binary())], ["tile_key", "png"])

    return blocks.mapInArrow(run, "tile_key string, png binary")


def score_rasters(blocks: DataFrame, tile: int = 256) -> DataFrame:
    """`(tile_key, tiff)`: two-band score blocks (tile_key, height, width, dtype, data with the bands one after
    the other) as tiled TIFFs with overviews, each read back before it is returned."""
    from parcelspark.sources.formats import tiff_bytes, tiff_pixels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                bands = np.frombuffer(r["data"], np.uint8).reshape(2, r["height"], r["width"])
                data = tiff_bytes(bands, tile)
                if not (tiff_pixels(data) == bands).all():
                    raise ValueError(f"{r['tile_key']} does not read back")
                out.append(data)
            yield pa.RecordBatch.from_arrays([batch.column("tile_key"), pa.array(out, pa.binary())], ["tile_key", "tiff"])

    return blocks.mapInArrow(run, "tile_key string, tiff binary")


def band_stacks(blocks: DataFrame, bands: int, tile: int = 256) -> DataFrame:
    """`(tile_key, tiff)`: blocks of `bands` bands one after the other (tile_key, height, width, dtype, data) as tiled TIFFs
    without overviews, each read back before it is returned. Another number of values is an error."""
    from parcelspark.sources.formats import tiff_bytes, tiff_pixels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                stack = np.frombuffer(r["data"], np.dtype(r["dtype"])).reshape(bands, r["height"], r["width"])
                data = tiff_bytes(stack, tile, ())
                if not (tiff_pixels(data) == stack).all():
                    raise ValueError(f"{r['tile_key']} does not read back")
                out.append(data)
            yield pa.RecordBatch.from_arrays([batch.column("tile_key"), pa.array(out, pa.binary())], ["tile_key", "tiff"])

    return blocks.mapInArrow(run, "tile_key string, tiff binary")

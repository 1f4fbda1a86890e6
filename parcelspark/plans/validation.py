"""Validation of released files and of a year's tables: every problem as a row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions import overlay, utm, wkb
from parcelspark.plans.release import SEAM_CELL
from parcelspark.operators import joins
from parcelspark.sources.readers import by_range

#: Columns of a released file, in order, and rows that a row group may have.
COLUMNS = ["id", "collection", "geometry", "bbox", "metrics:area", "metrics:perimeter", "score", "determination:datetime", "determination:method"]
MAX_ROWS = 2 * 8192


def file_problems(spark: SparkSession, root: str, columns: list[str] | None = None, max_rows: int = MAX_ROWS, sample: int = 200, seed: int = 0) -> DataFrame:
    """`(path, problem)` of Parquet files: columns, row-group sizes, compression, and in a seeded sample of
    one row group null ids, areas not above 0, scores beyond 0-100, invalid geometries. A file that cannot
    be read is a problem, not the end of the run."""
    columns = columns or COLUMNS

    def problems(file, size: int) -> list[str]:
        import pyarrow.parquet as pq

        f = pq.ParquetFile(file)
        out, meta = [], f.metadata
        if f.schema_arrow.names != columns:
            out.append(f"columns {','.join(f.schema_arrow.names)}")
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        out += [f"row group {i} has {g.num_rows} rows" for i, g in enumerate(groups) if g.num_rows > max_rows]
        codecs = {g.column(i).compression for g in groups for i in range(g.num_columns)} - {"ZSTD"}
        if codecs:
            out.append(f"compression {','.join(sorted(codecs))}")
        if out and out[0].startswith("columns") or not meta.num_rows:
            return out
        rng = np.random.default_rng([seed, size])
        t = f.read_row_group(int(rng.integers(len(groups))), columns=["id", "geometry", "metrics:area", "score"])
        t = t.take(pa.array(np.sort(rng.choice(len(t), min(sample, len(t)), replace=False))))
        area = t["metrics:area"].to_numpy(zero_copy_only=False)
        score = [x for x in t["score"].to_pylist() if x is not None]
        if t["id"].null_count:
            out.append("null ids")
        if not (area > 0).all():
            out.append("area not above 0 in sample")
        if score and not (min(score) >= 0 and max(score) <= 100):
            out.append("score out of range")
        shapes = [wkb.parse(x) for x in t["geometry"].to_pylist()]
        bad = sum(not p or abs(wkb.area(overlay.repaired(p)) - wkb.area(p)) > 1e-6 * wkb.area(p) for p in shapes)
        return [*out, *([f"{bad} invalid geometries in sample"] if bad else [])]

    def rows(path: str, file, size: int) -> list[tuple[str, str]]:
        try:
            return [(path, p) for p in problems(file, size)]
        except Exception as e:  # noqa: BLE001  (any unreadable file is one more row)
            return [(path, f"unreadable: {type(e).__name__}")]

    return by_range(spark, root, "*.parquet", rows, "path string, problem string")


def zone_edge_pairs(rows: DataFrame, share: float = 0.5) -> DataFrame:
    """Parcels of two neighbouring zones whose bounds overlap by at least a share of the smaller."""
    d = rows.withColumn("zone", F.substring("id", 1, 2).cast("int")).withColumnsRenamed({"xmin": "x0", "ymin": "y0", "xmax": "x1", "ymax": "y1"}).select("id", "zone", *joins.BOX)
    size = lambda k: (F.col(f"{k}.x1") - F.col(f"{k}.x0")) * (F.col(f"{k}.y1") - F.col(f"{k}.y0"))
    rule = (F.col("b.zone") == F.col("a.zone") % 60 + 1) & (joins.overlap_area("a", "b") >= share * F.least(size("a"), size("b")))
    return joins.grid_join(d, d, SEAM_CELL, rule).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def north_edges(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """`(tile_key, top, per_km, state)`: centres within a kilometre of a tile's north edge against those of the
    three kilometres from 1.5 on; 'pileup' or 'gap' where they differ threefold. `rows` has tile_key and a
    projected centre (x, y), `frames` each tile's top and west."""
    d = F.col("top_y") - F.col("y")
    west = (F.col("x") - F.col("west_x")) < 61_000
    counted = rows.join(frames, "tile_key").groupBy("tile_key").agg(F.count_if((d >= 0) & (d < 1000) & west).alias("top"), (F.count_if((d >= 1500) & (d < 4500) & west) / 3).alias("per_km"))
    state = F.when((F.col("top") >= 30) & (F.col("top") > 3 * F.col("per_km")), "pileup").when((F.col("per_km") >= 30) & (F.col("top") < F.col("per_km") / 3), "gap")
    return counted.withColumn("state", state)


def tile_frames(footprints: DataFrame) -> DataFrame:
    """`(tile_key, top_y, west_x)` of each tile's footprint in its own projection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                flat = utm.projected(wkb.parse(data), int(key[:2]), key[2] < "N")
                box = wkb.bounds(flat)
                out.append((key, box[3], box[0]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))], ["tile_key", "top_y", "west_x"])

    return footprints.select("tile_key", "geometry").mapInArrow(run, "tile_key string, top_y double, west_x double")

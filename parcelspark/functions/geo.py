"""Arrow-batched geometry columns: all that a row needs is measured in one pass over its WKB."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelspark.functions import overlay, wkb
from parcelspark.functions.codec import decode, encode
from parcelspark.functions.utm import forward, projected

#: Square metres below which holes are filled and parts dropped.
HOLE_M2, PART_M2 = 20.0, 900.0
#: The ellipsoid that positions refer to.
AXIS, FLATTENING = 6_378_137.0, 1 / 298.257223563
_METRICS = "area_m2 double, perimeter_m double, n_parts int, n_holes int, n_coordinates int, xmin double, ymin double, xmax double, ymax double, cx double, cy double"


def _mapped(df: DataFrame, schema: str, row) -> DataFrame:
    """`df` with the columns that `row(values by name)` gives, a batch at a time; a column that has one of
    their names is replaced."""
    names = [x.strip().split(" ")[0] for x in schema.split(", ")]
    kept = [c for c in df.columns if c not in names]
    out_schema = df.select(*kept).selectExpr("*", *(f"cast(null as {x.strip().split(' ', 1)[1]}) as {x.strip().split(' ')[0]}" for x in schema.split(", "))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(out_schema[n].dataType) for n in names]
        for batch in batches:
            rows = [row(r) for r in batch.to_pylist()]
            extra = [pa.array([r[i] if r is not None else None for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *extra], [*kept, *names])

    return df.mapInArrow(run, out_schema)


class Flat:
    """Polygons of a batch as one coordinate array: `points`, where each ring begins (and the end), whether a ring is a
    shell, and the row of each ring. Sums over rings are reductions over slices."""

    def __init__(self, shapes: list[wkb.Polygons]):
        rings = [(r, k == 0, row) for row, polygons in enumerate(shapes) for p in polygons for k, r in enumerate(p)]
        self.points = np.concatenate([r for r, _, _ in rings]) if rings else np.zeros((0, 2))
        self.starts = np.concatenate([[0], np.cumsum([len(r) for r, _, _ in rings])]).astype(np.int64)
        self.shell = np.array([s for _, s, _ in rings], bool)
        self.row = np.array([w for _, _, w in rings], np.int64)
        self.n = len(shapes)

    @classmethod
    def read(cls, column: pa.Array) -> Flat:
        """Of a column of WKB: polygons of one ring are taken together, others are parsed."""
        plain, points, n = wkb.plain_rings(column)
        other = np.ones(len(column), bool)
        other[plain] = False
        rest = np.flatnonzero(other)
        out = cls([wkb.parse(x) for x in column.take(pa.array(rest)).to_pylist()] if len(rest) else [])
        sizes, row = np.concatenate([np.diff(out.starts), n]), np.concatenate([rest[out.row], plain])
        order = np.argsort(row, kind="stable")
        if len(out.row):
            begin = (np.cumsum(sizes) - sizes)[order]
            at = np.repeat(begin - (np.cumsum(sizes[order]) - sizes[order]), sizes[order]) + np.arange(sizes.sum())
            points = np.concatenate([out.points, points])[at]
        out.points, out.row, out.n = points, row[order], len(column)
        out.shell = np.concatenate([out.shell, np.ones(len(plain), bool)])[order]
        out.starts = np.concatenate([[0], np.cumsum(sizes[order])]).astype(np.int64)
        return out

    def projected(self, zones: np.ndarray) -> np.ndarray:
        """Points in metres of each row's zone."""
        out, of = np.empty_like(self.points), np.repeat(zones[self.row], np.diff(self.starts))
        for z in np.unique(of).tolist():
            m = of == z
            out[m] = np.column_stack(forward(self.points[m, 0], self.points[m, 1], z))
        return out

    def shapes(self, points: np.ndarray) -> list[wkb.Polygons]:
        """The polygons again, with other coordinates."""
        out: list[wkb.Polygons] = [[] for _ in range(self.n)]
        for ring, shell, row in zip(np.split(points, self.starts[1:-1]), self.shell.tolist(), self.row.tolist(), strict=True) if len(self.row) else ():
            if shell:
                out[row].append([ring])
            else:
                out[row][-1].append(ring)
        return out

    def by_row(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=values, minlength=self.n)

    def rings(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each ring: the area, its first moments (from the ring's first point) and its length."""
        if not len(self.row):
            return (np.zeros(0),) * 4
        first = points[self.starts[:-1]]
        p = points - np.repeat(first, np.diff(self.starts), axis=0)
        inner = np.ones(len(p), bool)
        inner[self.starts[1:] - 1] = False  # a step ends in each point but a ring's first
        x0, y0, x1, y1 = p[:-1, 0], p[:-1, 1], p[1:, 0], p[1:, 1]
        held = inner[:-1]
        cross = np.append(np.where(held, x0 * y1 - x1 * y0, 0.0), 0.0)
        step = np.append(np.where(held, np.hypot(x1 - x0, y1 - y0), 0.0), 0.0)
        at = self.starts[:-1]
        area = np.add.reduceat(cross, at) / 2
        mx = np.add.reduceat(cross * np.append(x0 + x1, 0.0), at) / 6
        my = np.add.reduceat(cross * np.append(y0 + y1, 0.0), at) / 6
        return area, mx + first[:, 0] * area, my + first[:, 1] * area, np.add.reduceat(step, at)


def measure(df: DataFrame, geometry: str = "geometry", tile_key: str | None = "tile_key") -> DataFrame:
    """Area and perimeter in the zone's northern projection (or, without a tile key, as given), part,
    hole and coordinate counts, bounds and centroid. A null geometry has null measures."""
    names = [x.split(" ")[0] for x in _METRICS.split(", ")]
    kept = [c for c in df.columns if c not in names]
    schema = df.select(*kept).selectExpr("*", *(f"cast(null as {x.split(' ')[1]}) as {x.split(' ')[0]}" for x in _METRICS.split(", "))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = Flat.read(batch.column(geometry))
            none = np.bincount(flat.row, minlength=flat.n) == 0
            metres = flat.points if tile_key is None else flat.projected(_zones(batch, tile_key))
            sign = np.where(flat.shell, 1.0, -1.0)
            area, _, _, length = flat.rings(metres)
            degrees, mx, my, _ = flat.rings(flat.points)
            turned = sign * np.sign(np.where(degrees == 0, 1, degrees))
            total, cx, cy = (flat.by_row(turned * v) for v in (degrees, mx, my))
            box = [np.full(flat.n, k) for k in (np.inf, np.inf, -np.inf, -np.inf)]
            of = np.repeat(flat.row, np.diff(flat.starts))
            for i, f in enumerate((np.minimum, np.minimum, np.maximum, np.maximum)):
                f.at(box[i], of, flat.points[:, i % 2])
            line = np.flatnonzero(np.abs(total) < 1e-300)  # no area: the mean of the vertices
            with np.errstate(divide="ignore", invalid="ignore"):
                centre = [cx / total, cy / total]
            if len(line):
                shapes = flat.shapes(flat.points)
                for i in line.tolist():
                    centre[0][i], centre[1][i] = wkb.centroid(shapes[i]) or (np.nan, np.nan)
            found = [flat.by_row(sign * np.abs(area)), flat.by_row(length), flat.by_row(flat.shell), flat.by_row(~flat.shell), flat.by_row(np.diff(flat.starts)), *box, *centre]
            types = [f.dataType.typeName() for f in schema.fields[len(kept) :]]
            extra = [pa.array(v.astype(np.int32) if t == "integer" else v, mask=none) for v, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *extra], [*kept, *names])

    return df.mapInArrow(run, schema)


def _zones(batch: pa.RecordBatch, tile_key: str) -> np.ndarray:
    return np.array([int(k[:2]) if k else 0 for k in batch.column(tile_key).to_pylist()], np.int64)


def tidy(df: DataFrame, geometry: str = "geometry", tile_key: str = "tile_key", hole: float = HOLE_M2, part: float = PART_M2) -> DataFrame:
    """`geometry` without small holes, then without small parts, both measured in metres; what loses
    every part becomes null. Rings of a batch are measured at once; a geometry with nothing to lose is passed on as it is."""
    place = df.columns.index(geometry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = Flat.read(batch.column(place))
            size = np.abs(flat.rings(flat.projected(_zones(batch, tile_key)))[0])
            gone = ~flat.shell & (size < hole)
            polygon = np.cumsum(flat.shell) - 1  # the polygon of each ring
            left = np.bincount(polygon, weights=np.where(flat.shell, size, np.where(gone, 0.0, -size))) if len(polygon) else np.zeros(0)
            gone |= (left < part)[polygon] if len(polygon) else gone
            columns = [*batch.columns]
            if gone.any():
                data, shapes = batch.column(place).to_pylist(), flat.shapes(flat.points)
                for row in np.unique(flat.row[gone]).tolist():
                    low = np.searchsorted(flat.row, row)
                    rings = iter(gone[low:])
                    kept = [[r for r in p if not next(rings)] for p in shapes[row]]
                    data[row] = wkb.write([p for p in kept if p])
                columns[place] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return df.mapInArrow(run, df.schema)


def overlaps(pairs: DataFrame, a: str, b: str, tile_key: str | None = None) -> DataFrame:
    """Adds area_a, area_b and overlap of two geometry columns, in metres of the tile's zone or (without one) as given."""
    kept = [c for c in pairs.columns if c not in ("area_a", "area_b", "overlap")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides, areas = [], []
            for column in (a, b):
                flat = Flat.read(batch.column(column))
                points = flat.points if tile_key is None else flat.projected(_zones(batch, tile_key))
                areas.append(flat.by_row(np.where(flat.shell, 1.0, -1.0) * np.abs(flat.rings(points)[0])))
                sides.append(flat.shapes(points))
            over = overlay.intersection_areas(list(zip(*sides, strict=True)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(x, pa.float64()) for x in (*areas, over))], [*kept, "area_a", "area_b", "overlap"])

    return pairs.mapInArrow(run, pairs.select(*kept).selectExpr("*", "cast(0 as double) area_a", "cast(0 as double) area_b", "cast(0 as double) overlap").schema)


def overlaid(df: DataFrame, kernel: Callable[[list], list[wkb.Polygons]], *columns: str, name: str = "geometry") -> DataFrame:
    """`df` without geometry `columns`, with what a kernel for whole batches (overlay.unions, overlay.intersections) makes
    of each row's."""
    kept = [c for c in df.columns if c not in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c in columns:
                flat = Flat.read(batch.column(c))
                sides.append(flat.shapes(flat.points))
            made = kernel([list(x) for x in zip(*sides, strict=True)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(map(wkb.write, made), pa.binary())], [*kept, name])

    return df.mapInArrow(run, df.select(*kept).selectExpr("*", f"cast(null as binary) as {name}").schema)


def compact(df: DataFrame, geometry: str = "geometry", tile_key: str = "tile_key") -> DataFrame:
    """The geometry as start, deltas, ring and part counts on the zone's 2.5 m grid; a vertex off the grid is refused."""

    def row(r: dict):
        return encode(projected(wkb.parse(r[geometry]), int(r[tile_key][:2])))

    return _mapped(df, "x0 int, y0 int, dx array<int>, dy array<int>, ring_n array<int>, part_n array<int>", row)


def grid_box(x0: float, y0: float, w: int, h: int) -> bytes | None:
    """WKB of a box of w by h grid steps, for tests and examples."""
    return wkb.write(decode(int(x0), int(y0), np.array([w, 0, -w, 0]).tolist(), np.array([0, h, 0, -h]).tolist(), [5], [1]))


def _authalic(lat: np.ndarray) -> np.ndarray:
    """Square metres between the equator and a latitude, for a radian of longitude, on the ellipsoid."""
    e2 = FLATTENING * (2 - FLATTENING)
    e, s = np.sqrt(e2), np.sin(np.radians(lat))
    return AXIS**2 / 2 * (1 - e2) * (s / (1 - e2 * s * s) + np.arctanh(e * s) / e)


def ellipsoid_areas(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """`df` with `ellipsoid_m2`: the area of polygons in degrees on the ellipsoid itself, exact for edges that are straight
    in the equal-area projection (over a parcel, geodesics are)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [wkb.parse(x) for x in batch.column(geometry).to_pylist()]
            flat = Flat(shapes)
            area, _, _, _ = flat.rings(np.column_stack([np.radians(flat.points[:, 0]), _authalic(flat.points[:, 1])]))
            total = flat.by_row(np.where(flat.shell, 1.0, -1.0) * np.abs(area))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total, mask=np.array([not p for p in shapes], bool))], [*batch.schema.names, "ellipsoid_m2"])

    return df.mapInArrow(run, df.selectExpr("*", "cast(null as double) as ellipsoid_m2").schema)


def calibrated(df: DataFrame, area: str, limit: float = 0.02) -> DataFrame:
    """One row: median ratio of a column of areas to the ellipsoid's, and `spread` (99th less 1st percentile); a spread
    above `limit` is an error, since one factor would not do."""
    from pyspark.sql import functions as F

    r = F.percentile_approx(F.col(area) / F.col("ellipsoid_m2"), F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99)), 10_000)
    out = ellipsoid_areas(df).agg(r.alias("r")).select(F.col("r")[1].alias("ratio"), (F.col("r")[2] - F.col("r")[0]).alias("spread"))
    return out.where(F.when(F.col("spread") <= limit, True).otherwise(F.raise_error(F.lit("areas differ by no common factor"))))

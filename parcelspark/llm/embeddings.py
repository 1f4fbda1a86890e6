"""Embedding near-dedup: a subspace pigeonhole join of rotated vectors, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.simhash import join_sets
from parcelspark.llm.text import as_array
from parcelspark.operators.graph import connected_components
from parcelspark.session import materialise

COSINE = 0.93
BLOCKS = 4
#: Vectors that the rotation is fitted on, at most; rows of a cell that one task compares, about.
ROTATION_SAMPLE, CELL = 4096, 16_384
_WIDE = "label string, dim int, block int, cell string, home boolean, rep long, m long, v array<{}>"
_NARROW = "label string, dim int, block int, cell string, home boolean"


class Subspaces:
    """A rotation to principal axes, dealt to BLOCKS blocks in turn, and each block's share of the squared
    distance that linked unit vectors may have: two vectors within `budget` in all are within the block's
    share in one block at least, since the shares (in proportion to the blocks' energy) add up to it."""

    def __init__(self, sample: np.ndarray, dim: int, budget: float):
        if len(sample) >= 2 * dim:
            axes = np.linalg.eigh(np.cov(sample.T))[1][:, ::-1] if dim > 1 else np.ones((1, 1))
        else:
            axes = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]
        n = min(BLOCKS, dim)
        self.axes = [np.ascontiguousarray(axes[:, b::n]) for b in range(n)]
        energy = np.array([((sample @ a).var(0).sum() if len(sample) > 1 else a.shape[1]) + 1e-6 for a in self.axes])
        self.shares = budget * energy / energy.sum()

    def parts(self, unit: np.ndarray) -> list[np.ndarray]:
        return [unit @ a for a in self.axes]


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column (all of one length) as unit vectors, in double precision."""
    column = as_array(column)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1)[:, None]  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1))[:, None]


def _half(axes: int) -> list[tuple[int, ...]]:
    """Where a row goes: its own cell, and each neighbour that precedes it."""
    return [o for o in product((-1, 0, 1), repeat=axes) if o <= (0,) * axes]


def _cells(spaces: dict[int, Subspaces], vectors: bool):
    """Rows for each block and each cell that a vector is in (home) or visits. A cell is as wide as the
    block's reach along its first `axes` coordinates, so that vectors in reach are in one cell or neighbours."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, axes = batch.column("dim").to_numpy(), batch.column("axes").to_numpy()
            for dim, g in sorted(set(zip(dims.tolist(), axes.tolist(), strict=True))):
                rows = batch.filter(pa.array((dims == dim) & (axes == g)))
                space = spaces[dim]
                for b, part in enumerate(space.parts(_unit(rows.column("v")))):
                    k = min(g, part.shape[1])
                    cell = np.floor(part[:, :k] / np.sqrt(space.shares[b] + 1e-6)).astype(np.int64)  # no narrower than the slack in _compare
                    for offset in _half(k):
                        names = [".".join(map(str, c)) for c in (cell + np.array(offset)).tolist()]
                        n = len(names)
                        out = [rows.column("label"), rows.column("dim"), pa.array([b] * n, pa.int32()), pa.array(names), pa.array([not any(offset)] * n)]
                        out += [rows.column(c) for c in ("rep", "m", "v")] if vectors else []
                        yield pa.RecordBatch.from_arrays(out, [x.split(" ")[0] for x in (_WIDE if vectors else _NARROW).split(", ")])

    return dealt


def _compare(spaces: dict[int, Subspaces], cosine: float):
    """Links of one task: `(rep, links, root)` for each row with a link. A pair is counted in the first
    block whose share it keeps to, and there in one cell, so once in all."""

    def compare(group: pa.Table) -> pa.Table:
        space, b = spaces[group["dim"][0].as_py()], group["block"][0].as_py()
        side = group["side"].to_numpy()
        rep, m = group["rep"].to_numpy(), group["m"].to_numpy()
        unit = _unit(group["v"])
        part = unit @ space.axes[b]
        square = (part * part).sum(1)
        along, reach = part[:, 0], np.sqrt(space.shares[b] + 1e-6)
        order = np.argsort(along, kind="stable")
        left, right = order[(side[order] & 1) > 0], order[(side[order] & 2) > 0]
        links, parent = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for low in range(0, len(left), 256):
            rows = left[low : low + 256]
            # both sides are sorted along the first axis: only what is in reach there is compared
            begin, end = np.searchsorted(along[right], [along[rows[0]] - reach, along[rows[-1]] + reach])
            some = right[begin:end]
            near = square[rows][:, None] + square[some] - 2 * part[rows] @ part[some].T <= space.shares[b] + 1e-6
            i, j = np.nonzero(near)
            i, j = rows[i], some[j]
            # a row that is on both sides meets each other such row once, by id; sides 1 and 2 meet in any case
            once = (i != j) & ((side[i] != 3) | (side[j] != 3) | (rep[i] < rep[j]))
            i, j = i[once], j[once]
            for at in range(0, len(i), 1 << 16):
                p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                difference = unit[p] - unit[q]
                owner = np.full(len(p), -1)
                for k in range(len(space.axes) - 1, -1, -1):
                    moved = difference @ space.axes[k]
                    owner[(moved * moved).sum(1) <= space.shares[k] + 1e-9] = k
                mine = (owner == b) & ((unit[p] * unit[q]).sum(1) >= cosine)
                p, q = p[mine], q[mine]
                np.add.at(links, p, m[q])
                np.add.at(links, q, m[p])
                join_sets(parent, p, q)
        join_sets(parent, parent[:0], parent[:0])
        has = np.flatnonzero(links)
        return pa.table([pa.array(rep[has]), pa.array(links[has]), pa.array(rep[parent[has]])], names=["rep", "links", "root"])

    return compare


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """`(vec_id, n_links, component_id, kept)`, one row for each vector of `vectors` (vec_id, embedding, label
    of any type that has a text).

    Vectors of equal label and length link at `cosine` or more, computed in double precision from the
    given values. Null, empty and zero vectors, vectors with a null or non-finite component, and rows
    with a null label or null vec_id link with nothing (a null id has a null component and is not kept).
    Rows repeated in all three columns are one vector; an empty table gives no rows; other columns are not
    read.

    Equal vectors are merged first and count by their number. Each block of the rotated vectors is joined
    by range: cells along its first axes, one axis for small labels, more as a label grows; a cell of more
    than `cell` rows is cut into tiles that meet pairwise, so no task holds more than two, and a cell that is only
    visited is left out. What is in reach along the first axis is compared in the block's dimensions, what
    keeps to the block's share is checked in all. A task returns a row for each linked vector, never its pairs.
    """
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"  # nothing is rounded
    rows = vectors.select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast(f"array<{kind}>").alias("v")).distinct()
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    fit = F.coalesce((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = materialise(rows.select("vec_id", "label", F.when(fit, F.xxhash64("label", "v")).alias("k1"), F.when(fit, F.xxhash64(F.lit(1), "v", "label")).alias("k2"), F.when(fit, F.col("v")).alias("v")), "vectors")
    classes = rows.where("k1 is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.first("label").cast("string").alias("label"), F.first("v").alias("v"))
    classes = materialise(classes.withColumn("dim", F.size("v")), "vector-classes")
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(ROTATION_SAMPLE).select("dim", "v").toArrow()
    budget, spaces = 2 * (1 - cosine), {}
    for dim in (r["dim"] for r in classes.select("dim").distinct().collect()):
        mine = as_array(sample.filter(pa.compute.equal(sample["dim"], dim))["v"])
        spaces[dim] = Subspaces(_unit(mine) if len(mine) else np.zeros((0, dim)), dim, budget)
    # a further axis leaves about two fifths of a cell's pairs
    axes = F.greatest(F.lit(1), F.least(F.lit(3), F.ceil(F.log(F.col("n") / F.lit(8.0 * cell)) / F.log(F.lit(2.5))) + 1)).cast("int").alias("axes")
    sizes = materialise(classes.groupBy("label", "dim").agg(F.count("*").alias("n")).select("label", "dim", axes), "vector-labels")
    placed = classes.join(sizes, ["label", "dim"]).select("rep", "m", "label", "dim", "axes", "v")

    at = ["label", "dim", "block", "cell"]
    counts = placed.mapInArrow(_cells(spaces, False), _NARROW).groupBy(*at).agg(F.count("*").alias("rows"), F.count_if("home").alias("homes"))
    large = F.col("rows") > cell
    cells = counts.where((F.col("homes") > 0) & (F.col("rows") > 1)).select(*at, F.when(large, F.ceil(F.col("homes") / F.lit(cell / 2))).cast("int").alias("t"), F.when(large, F.ceil((F.col("rows") - F.col("homes")) / F.lit(cell / 2))).cast("int").alias("u"))
    cells = materialise(cells, "vector-cells")
    wide = placed.mapInArrow(_cells(spaces, True), _WIDE.format(kind)).join(cells, at)
    # tiles 0 .. t-1 are of the cell's own rows, t .. t+u-1 of visitors; a task is a pair (i, j), i < t, i <= j
    own = F.when(F.col("home"), F.pmod(F.xxhash64("rep"), F.col("t"))).otherwise(F.col("t") + F.pmod(F.xxhash64("rep"), F.greatest("u", F.lit(1)))).cast("int")
    tile = F.col("tile")
    pairs = F.when(F.col("t").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.when(F.col("home"), 3).otherwise(2).alias("side"))))
    firsts = F.transform(F.sequence(F.lit(0), F.least(tile, F.col("t") - 1)), lambda i: F.struct(i.alias("i"), tile.alias("j"), F.when(i == tile, 3).otherwise(2).alias("side")))
    seconds = F.filter(F.transform(F.sequence(F.lit(0), F.col("t") + F.col("u")), lambda j: F.struct(tile.alias("i"), j.alias("j"), F.lit(1).alias("side"))), lambda x: F.col("home") & (x["j"] > tile) & (x["j"] < F.col("t") + F.col("u")))
    tasks = wide.withColumn("tile", own).select("*", F.explode(pairs.otherwise(F.concat(firsts, seconds))).alias("task")).select(*at, "rep", "m", "v", "task.*")
    found = tasks.groupBy(*at, "i", "j").applyInArrow(_compare(spaces, cosine), "rep long, links long, root long")
    found = materialise(found, "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(found.where("rep <> root"), "rep", "root")
    known = classes.select("k1", "k2", "rep", "m").join(links, "rep", "left").join(components, F.col("rep") == F.col("node"), "left")
    known = materialise(known.select("k1", "k2", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "vector-known")
    out = rows.select("vec_id", "k1", "k2").join(known, ["k1", "k2"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = {
    "op2_embeddings": f"""
WITH RECURSIVE v AS (SELECT DISTINCT vec_id, label, cast(embedding AS double[]) AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(e) > 0
 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
 WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM links UNION SELECT node, b FROM reach JOIN links ON seen = a),
least AS (SELECT node, min(seen) AS component FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, cast(coalesce(degree.n, 0) AS bigint) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(coalesce(component, vec_id) = vec_id, false) AS kept
FROM v LEFT JOIN least ON node = vec_id LEFT JOIN degree ON a = vec_id"""
}

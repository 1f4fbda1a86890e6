"""SimHash near-dedup: BK-trees over shards of fingerprints, linked within a Hamming radius."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.text import Words, slices
from parcelspark.operators.graph import connected_components
from parcelspark.session import materialise

RADIUS = 3
SEED = 42
#: Fingerprints of one shard before it is split further, of one tile of a part that still has more, and
#: (query, node) pairs held at once.
SHARD, TILE, FRONTIER = 8192, 1 << 16, 1 << 20
#: Shingles whose bounds are Python numbers at once.
HASHED = 1 << 17
_LANES = np.uint64(0x0101010101010101)


def simhash(texts: pa.Array, words_each: int = 3) -> np.ndarray:
    """Unsigned 64-bit fingerprints: A-Z lowered, shingles of `words_each` words (repeats count), each
    hashed by XXH64 with seed 42; a bit is set if over half the hashes set it. A text with fewer words
    is one shingle; one without words (or null) has 0."""
    import xxhash

    words = Words(texts, lower=True)
    n, out = np.diff(words.starts), np.zeros(len(words.starts) - 1, np.uint64)
    if not len(words):
        return out
    raw, begin, _ = words.spaced()
    shingles = np.where(n == 0, 0, np.maximum(n - words_each + 1, 1))
    ends = np.cumsum(shingles)
    at = np.arange(ends[-1]) + np.repeat(words.starts[:-1] - (ends - shingles), shingles)
    last = at + np.repeat(np.minimum(n, words_each) - 1, shingles)
    digest = xxhash.xxh64_intdigest
    hashes = np.empty(len(at), np.uint64)
    for low in range(0, len(at), HASHED):
        s = slice(low, low + HASHED)
        hashes[s] = [digest(raw[a:b], SEED) for a, b in zip(begin[at[s]].tolist(), (begin[last[s] + 1] - 1).tolist(), strict=True)]
    # runs of at most 255 shingles: each byte of a word counts one bit without overflow
    has = np.flatnonzero(shingles)
    runs = -(-shingles[has] // 255)
    run_doc = np.repeat(np.arange(len(has)), runs)
    nth = np.arange(len(run_doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    run_start = (ends - shingles)[has][run_doc] + nth * 255
    counts = np.empty((len(has), 64), np.int64)
    doc_run = np.cumsum(runs) - runs
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, run_start).view(np.uint8).reshape(-1, 8)
        counts[:, k::8] = np.add.reduceat(lanes.astype(np.int64), doc_run, axis=0)
    out[has] = np.packbits(counts * 2 > shingles[has][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


class BKForest:
    """One BK-tree for each group of `groups` (sorted ids) over `prints`: a node's children are keyed by
    their integer distance to it. All trees are built and searched level by level."""

    def __init__(self, prints: np.ndarray, groups: np.ndarray):
        self.prints, n = prints, len(prints)
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if n else np.zeros(0, int)
        self.root = np.repeat(starts, np.diff(np.append(starts, n)))
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        items = np.setdiff1d(np.arange(n), starts, assume_unique=True)
        under = self.root[items]
        while len(items):
            d = np.bitwise_count(prints[items] ^ prints[under]).astype(np.int64)
            order = np.lexsort((items, d, under))
            items, under, d = items[order], under[order], d[order]
            head = np.concatenate([[True], (under[1:] != under[:-1]) | (d[1:] != d[:-1])])
            node = items[head][np.cumsum(head) - 1]
            parent[items[head]], edge[items[head]] = under[head], d[head]
            items, under = items[~head], node[~head]
        child = np.flatnonzero(parent >= 0)
        order = np.lexsort((edge[child], parent[child]))
        self.child = child[order]
        #: children sorted by (parent, distance), so the distances within a radius are one slice
        self.slot = parent[self.child] * 128 + edge[self.child]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (a, b) with b before a in the input, of one group, at `radius` or less."""
        for low in range(0, len(self.prints), 4096):
            item = np.arange(low, min(low + 4096, len(self.prints)))
            pending = [(item, self.root[item])]
            while pending:
                item, node = pending.pop()
                if len(item) > FRONTIER:
                    half = len(item) // 2
                    pending += [(item[:half], node[:half]), (item[half:], node[half:])]
                    continue
                d = np.bitwise_count(self.prints[item] ^ self.prints[node]).astype(np.int64)
                near = (d <= radius) & (node < item)
                if near.any():
                    yield item[near], node[near]
                begin = np.searchsorted(self.slot, node * 128 + np.maximum(d - radius, 0))
                count = np.searchsorted(self.slot, node * 128 + d + radius, side="right") - begin
                if count.any():
                    pos = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
                    nxt, item = self.child[pos], np.repeat(item, count)
                    # nodes are placed in input order along every path, so a node after the item has none before it below
                    ahead = nxt <= item
                    if ahead.any():
                        pending.append((item[ahead], nxt[ahead]))


def join_sets(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; parent[x] <= x throughout."""
    while True:
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        a, b = parent[a], parent[b]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _shard_links(radius: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            key, rep = table["key"].to_numpy(), table["rep"].to_numpy()
            prints = table["fp"].to_numpy().view(np.uint64)
            forest, parent = BKForest(prints, key), np.arange(len(key))
            for a, b in forest.links(radius):
                join_sets(parent, a, b)
            join_sets(parent, parent[:0], parent[:0])
            moved = np.flatnonzero(parent != np.arange(len(parent)))
            return pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[parent[moved]])], ["src", "dst"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut == 0 and (not held or held[-1].column("key")[-1].as_py() == key[0]):
                held.append(batch)
                continue
            if cut == 0:
                yield solve(pa.Table.from_batches(held))
                held = [batch]
                continue
            yield solve(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = [batch.slice(cut)]
        if held:
            yield solve(pa.Table.from_batches(held))

    return linked


def _bits(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def shard_keys(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`(key, fp, rep)`: two fingerprints within `radius` share at least one key.

    The 64 bits are radius + 2 blocks; at least two are equal, and a key is one choice of two blocks with
    their bits. Shards of more than SHARD rows are split by the rest of the bits, cut into radius + 1
    parts of which one is equal. A part that still has more than TILE rows is cut into tiles by a hash of the
    fingerprint, and each two tiles are a shard of their own, so none holds more than about 2 * TILE.
    Keys with a single row are left out.
    """
    n = radius + 2
    low = [64 * i // n for i in range(n + 1)]
    choices = []
    for i, (a, b) in enumerate(combinations(range(n), 2)):
        wa, wb = low[a + 1] - low[a], low[b + 1] - low[b]
        rest = [x for c in range(n) if c not in (a, b) for x in range(low[c], low[c + 1])]
        parts = []
        for j in range(radius + 1):
            positions = rest[len(rest) * j // (radius + 1) : len(rest) * (j + 1) // (radius + 1)]
            mask = sum(1 << x for x in positions)
            parts.append(F.xxhash64(F.lit(j), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
        key = F.shiftleft(_bits(F.col("fp"), low[a], wa), wb).bitwiseOR(_bits(F.col("fp"), low[b], wb)).bitwiseOR(F.lit(i << 40))
        choices.append(F.struct(key.alias("key"), F.array(*parts).alias("parts")))
    keyed = prints.select("fp", "rep", F.explode(F.array(*(c.getField("key") for c in choices))).alias("key"))
    sizes = materialise(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-shards")
    rows = keyed.join(sizes, "key")
    split = F.element_at(F.array(*(c.getField("parts") for c in choices)), F.shiftright("key", 40).cast("int") + 1)
    whole = rows.where(F.col("n") <= SHARD).select("key", "fp", "rep")
    large = rows.where(F.col("n") > SHARD).select(F.explode(split).alias("part"), "key", "fp", "rep")
    large = large.select(F.xxhash64("key", "part").alias("key"), "fp", "rep")
    parts = materialise(large.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / F.lit(TILE)).cast("int").alias("t")), "simhash-parts")
    tiled = large.join(parts, "key").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("t")).cast("int"))
    one = tiled.where("t = 1").select("key", "fp", "rep")
    pair = F.filter(F.sequence(F.lit(0), F.col("t") - 1), lambda j: j != F.col("i"))
    more = tiled.where("t > 1").select("key", "fp", "rep", "i", F.explode(pair).alias("j"))
    more = more.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp", "rep")
    return whole.unionByName(one).unionByName(more)


def text_hashes(text: str = "text") -> tuple[Column, Column]:
    """Two hashes that together tell texts apart; a null text is like none other."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words_each: int = 3, with_text: bool = False) -> DataFrame:
    """`(doc_id, fingerprint, component_id)`, one row for each row of `docs` (columns doc_id, text).

    Fingerprints at `radius` differing bits or less are linked; a component is what links reach, named
    by its smallest doc_id. Null and empty texts have fingerprint zero and link like others. A null
    doc_id names no component: such a row gets the smallest other id of its component, or null. Repeated
    rows give repeated rows. An empty table gives none; other columns are not read. `with_text` adds
    `text_hash`, `text_hash2` (see text_hashes) and `component`, a number that no two components share, for
    tables whose ids repeat.

    Equal fingerprints are merged first, so copies cost one row each. Each shard (see shard_keys) is one
    BK-tree searched by its own members; a shard emits one edge for each member that is not the first of its
    set, never its pairs. Trees of all fingerprints cannot be broadcast, as they grow with the corpus:
    shards go to their tasks by key instead.
    """

    extra = ["text_hash", "text_hash2"] if with_text else []
    schema = ", ".join(f"{c} long" for c in ["doc_id", *extra, "fp"])

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            fp = np.concatenate([simhash(x, words_each) for x in slices(batch.column(1))]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(fp)], ["doc_id", *extra, "fp"])

    hashes = [h.alias(c) for h, c in zip(text_hashes(), extra, strict=False)]
    found = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *hashes).mapInArrow(prints, schema), "simhash-prints")
    # a class without any id still needs a node: negative hash of its print, mapped back to null below
    classes = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-classes")
    nodes = classes.select("fp", F.col("fp").alias("rep"))
    keyed = shard_keys(nodes, radius).repartition("key").sortWithinPartitions("key")
    edges = keyed.mapInArrow(_shard_links(radius), "src long, dst long")
    components = connected_components(edges)
    joined = classes.join(components, classes.fp == components.node, "left").select("fp", "doc_id", F.coalesce("component", "fp").alias("component"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = materialise(joined.select("fp", "component").join(least, "component").select("fp", "component", "component_id"), "simhash-labels")
    return found.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *extra, *(["component"] if with_text else []))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

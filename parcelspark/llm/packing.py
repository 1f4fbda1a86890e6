"""Optimal length buckets: dynamic programming over the global histogram, then token-budget batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelspark.llm.text import word_count
from parcelspark.session import materialise

#: Documents that one task numbers, on average.
SHARD = 512


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Upper bounds of at most `n_buckets` buckets that minimise the padding of all documents, each
    padded to its bucket's bound. A bound is always an occurring length.

    dp[k][j], the least padded total of the j shortest lengths in k buckets, is the minimum over i of
    dp[k-1][i] + length[j] * (docs[j] - docs[i]). The best i never falls as j grows, so rows are halved: all
    middle rows of a level look between the best of their neighbours, at once. Time is n_buckets *
    lengths * log(lengths), memory a few arrays of the lengths.
    """
    order = np.argsort(lengths)
    x, c = lengths[order].astype(np.int64), np.concatenate([[0], np.cumsum(counts[order])]).astype(np.int64)
    n = len(x)
    if not n:
        return []
    if int(x[-1]) * int(c[-1]) >= 1 << 62:
        x, c = x.astype(object), c.astype(object)
    best = np.concatenate([c[:1], x * c[1:]])
    back = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(n_buckets, n)):
        new, came = best.copy(), np.zeros(n + 1, np.int64)
        low, high, first, last = (np.array([v]) for v in (1, n, 0, n - 1))
        while len(low):
            j = (low + high) // 2
            width = np.minimum(last, j - 1) - first + 1
            ends = np.cumsum(width)
            row = np.repeat(np.arange(len(j)), width)
            i = np.arange(ends[-1]) - (ends - width)[row] + first[row]
            value = best[i] + x[j - 1][row] * (c[j][row] - c[i])
            new[j] = np.minimum.reduceat(value, ends - width)
            found = np.flatnonzero(value == new[j][row])
            least = i[found[np.unique(row[found], return_index=True)[1]]]
            came[j] = least
            left, right = low < j, j < high
            low, high, first, last = (np.concatenate(v) for v in ((low[left], (j + 1)[right]), ((j - 1)[left], high[right]), (first[left], least[right]), (least[left], last[right])))
        best = new
        back.append(came)
    bounds, j = [], n
    for came in reversed(back):
        if j <= 0:
            break
        bounds.append(int(x[j - 1]))
        j = int(came[j])
    return sorted(set(bounds))


def pack(docs: DataFrame, n_buckets: int = 16, batch_tokens: int = 65_536, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`(doc_id, n_tokens, bucket, padded_to, batch, slot)`, one row for each row of `docs`.

    A document's length is its words and one end. Every batch of a bucket but its last holds
    batch_tokens // padded_to documents (at least one), so padded batches keep the token budget unless a
    single document exceeds it. Null and empty texts have length 1; null ids, repeated rows and ties
    are numbered like others; an empty table gives no rows. Of other columns nothing is read.

    Texts are read once, for their lengths; only ids and lengths are written and shuffled. The histogram that
    reaches the driver is exact: one row for each length that occurs, at most sqrt(2 * tokens) of them
    (5.7 million for 16 trillion tokens). Numbers inside a bucket are a shard's offset plus the place in the
    shard; shards have about SHARD rows and super-shards SHARD shards, so a bucket that holds most documents
    is still numbered by many tasks. Rows without an id are dealt by their place in the input.
    """
    own = F.xxhash64(F.col(doc_id), F.length(text), F.when(F.col(doc_id).isNull(), F.monotonically_increasing_id()))
    rows = materialise(docs.select(F.col(doc_id).alias("doc_id"), (word_count(F.col(text)) + 1).alias("n_tokens"), own.alias("key")), "pack-lengths")
    hist = rows.groupBy(F.col("n_tokens").alias("n")).agg(F.count("*").alias("c")).collect()
    lengths, counts = np.array([r["n"] for r in hist], np.int64), np.array([r["c"] for r in hist], np.int64)
    bounds = optimal_bounds(lengths, counts, n_buckets) or [1]
    inside = np.searchsorted(bounds, lengths)
    shards = [max(1, -(-int(counts[inside == b].sum()) // SHARD)) for b in range(len(bounds))]

    def by_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*(F.lit(int(v)) for v in values)), F.col("bucket") + 1)

    bucket = F.size(F.filter(F.array(*(F.lit(b) for b in bounds[:-1])), lambda b: b < F.col("n_tokens"))) if len(bounds) > 1 else F.lit(0)
    rows = rows.withColumn("bucket", bucket.cast("int"))
    rows = rows.withColumn("shard", F.pmod(F.col("key"), by_bucket(shards)).cast("int"))
    sizes = rows.groupBy("bucket", "shard").agg(F.count("*").alias("n")).withColumn("over", F.expr(f"shard div {SHARD}"))
    before = [Window.unboundedPreceding, -1]
    supers = sizes.groupBy("bucket", "over").agg(F.sum("n").alias("n"))
    supers = supers.select("bucket", "over", F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("over").rowsBetween(*before)), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("bucket", "over").orderBy("shard").rowsBetween(*before)), F.lit(0))
    offsets = sizes.withColumn("inner", inner).join(supers, ["bucket", "over"]).select("bucket", "shard", (F.col("base") + F.col("inner")).alias("offset"))
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("key", "doc_id", "n_tokens")) - 1
    fits = by_bucket([max(1, batch_tokens // b) for b in bounds])
    rows = rows.withColumn("place", place).join(offsets, ["bucket", "shard"]).withColumn("rank", F.col("offset") + F.col("place")).withColumn("fits", fits)
    return rows.select(
        "doc_id", "n_tokens", "bucket", by_bucket(bounds).cast("long").alias("padded_to"),
        F.expr("rank div fits").cast("long").alias("batch"), F.expr("rank % fits").cast("int").alias("slot"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Exact length histogram: documents by encoded length, and suffix sums over it."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelspark.session import materialise

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_ENCODINGS: dict = {}
#: Lengths whose rows one task sums; the longest text over this many groups are summed by another.
SPAN = 4096


def encoding(path: str):
    """The byte-level BPE whose ranks `path` holds, once for each worker."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding(f"bpe-{len(ranks)}", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def encoded_lengths(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text") -> DataFrame:
    """`n_tokens` of each row of `docs`; a null or empty text has 0. Whole texts are encoded."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(tokenizer).encode_ordinary
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(encode(x)) if x else 0 for x in (v.as_py() for v in batch.column(0))], pa.int64())], ["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(lengths, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """`(n_tokens, n_docs)`: pre-aggregated in each task, so at most one row for each task and length moves."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length L of `hist`: documents and tokens at L or more, documents at L or less, and the
    total when every document is cut to L tokens. No task holds more than SPAN lengths or, for the
    sums of spans, one row for each span up to the longest text. An empty histogram gives no rows."""
    spans = hist.withColumn("span", F.expr(f"n_tokens div {SPAN}"))
    sums = spans.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum(F.expr("n_docs * n_tokens")).alias("t"))
    above = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select("span", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"), F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"))
    within = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = spans.join(sums, "span").select(
        "n_tokens", "n_docs",
        (F.col("d_above") + F.sum("n_docs").over(within)).alias("docs_at_least"),
        (F.col("t_above") + F.sum(F.expr("n_docs * n_tokens")).over(within)).alias("tokens_at_least"),
        "all_docs", "all_tokens",
    )
    return out.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        F.expr("all_docs - docs_at_least + n_docs").alias("docs_at_most"),
        F.expr("all_tokens - tokens_at_least + n_tokens * docs_at_least").alias("tokens_cut_to"),
    )


def cut_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """`(context_limit, tokens)`: the total when documents are cut to each limit, whether or not a
    document has that length."""
    totals = hist.agg(*(F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(x)) * F.col("n_docs")), F.lit(0)).alias(str(i)) for i, x in enumerate(limits)))
    return totals.select(F.explode(F.array(*(F.struct(F.lit(x).cast("long").alias("context_limit"), F.col(str(i)).alias("tokens")) for i, x in enumerate(limits)))).alias("r")).select("r.*")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """`(share, n_tokens)`: the least length that at least this share of the documents does not exceed."""
    every = sums.agg(F.max("docs_at_most")).first()[0] or 0
    found = sums.agg(*(F.min(F.when(F.col("docs_at_most") >= F.lit(x) * every, F.col("n_tokens"))).alias(str(i)) for i, x in enumerate(shares)))
    return found.select(F.explode(F.array(*(F.struct(F.lit(float(x)).alias("share"), F.col(str(i)).alias("n_tokens")) for i, x in enumerate(shares)))).alias("r")).select("r.*")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = histogram(encoded_lengths(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return suffix_sums(materialise(hist, "lengths"))  # read twice: texts must not be encoded twice

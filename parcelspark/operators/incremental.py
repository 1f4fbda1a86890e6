"""Fingerprinted, resumable runs over partitions, and their state table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprints(inputs: DataFrame, by: str, rule: str) -> DataFrame:
    """`(by, fingerprint)`: a hash over each partition's inputs (name, size, modified, in order of name) and the
    text of the rule that is applied to them."""
    line = F.concat_ws(";", "name", F.col("size").cast("string"), F.col("modified").cast("string"))
    return inputs.groupBy(by).agg(F.sha2(F.concat_ws("\n", F.lit(rule), F.array_join(F.array_sort(F.collect_list(line)), "\n")).cast("binary"), 256).alias("fingerprint"))


def stale(current: DataFrame, state: DataFrame, by: str) -> DataFrame:
    """Partitions that are new or whose fingerprint differs from the recorded one."""
    return current.join(state.select(by, "fingerprint"), [by, "fingerprint"], "left_anti")


def carried(current: DataFrame, state: DataFrame, counts: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Figures of this run, with those of skipped partitions taken from the recorded state, and `skipped`."""
    old = state.select(by, *(F.col(c).alias(f"_old_{c}") for c in columns))
    joined = current.select(by).join(counts.withColumn("_new", F.lit(True)), by, "left").join(old, by, "left")
    return joined.select(by, *(F.coalesce(c, f"_old_{c}").alias(c) for c in columns), F.col("_new").isNull().alias("skipped"))


def mixed_neighbours(done: DataFrame, zone: str = "zone", skipped: str = "skipped") -> DataFrame:
    """Skipped zones beside a rewritten one (60 and 1 are neighbours): their seams would not match."""
    number = F.col(zone).cast("int")
    a = done.where(F.col(skipped)).select(F.col(zone), F.explode(F.array(F.pmod(number, F.lit(60)) + 1, F.pmod(number - 2, F.lit(60)) + 1)).alias("beside"))
    b = done.where(~F.col(skipped)).select(F.col(zone).cast("int").alias("beside"))
    return a.join(b, "beside").select(zone, "beside").distinct()


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, as a resumable append-only log is read."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c != key)), order).alias("_r")).select(key, "_r.*")


def run_stale(current: DataFrame, state: DataFrame, by: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work` on the stale partitions' keys; nothing when all are up to date."""
    return work(stale(current, state, by))


def changed_meanwhile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Names whose size or time differs between two listings (name, size, modified), or that one lacks: a run
    between them must be thrown away."""
    a, b = (d.select("name", F.struct("size", "modified").alias(n)) for d, n in ((before, "a"), (after, "b")))
    return a.join(b, "name", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("name")

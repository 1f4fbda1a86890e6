"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.session import materialise


def _are_stars(edges: DataFrame) -> bool:
    """Does every node name one smaller node, and that one none?"""
    if edges.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").take(1):
        return False
    return not edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi").take(1)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = both.join(least, "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    linked = edges.join(least, "hi").where(F.col("lo") > F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return linked.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """`(node, component)` of every node that `edges` names; the component is its smallest node.

    Each round is two joins and two distinct aggregations whose outputs never exceed the edge count;
    a hub is never gathered in one task (the join on it can be split, the minimum is pre-aggregated).
    Rounds grow with the logarithm of the longest path. A round's edges are written to the shared
    folder, so a lost executor costs one round at most. Null ends and self-loops are ignored; an edge
    table without rows gives none.
    """
    kept = edges.select(F.col(src).cast("long").alias("a"), F.col(dst).cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    now = materialise(kept.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    rounds = 0
    while not _are_stars(now):
        if (rounds := rounds + 1) > max_rounds:
            raise RuntimeError(f"no stars after {max_rounds} rounds")
        now = materialise(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def named_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """`(node, component)` for nodes of any type: each gets a number of its own, written once, and none is known by
    a hash. A component is the least number in it."""
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    numbers = materialise(ends.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct().withColumn("n", F.monotonically_increasing_id()), "node-numbers")
    a, b = (numbers.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    found = connected_components(ends.join(a, "a").join(b, "b"), "n_a", "n_b")
    return numbers.join(found.withColumnRenamed("node", "n"), "n").select("node", "component")

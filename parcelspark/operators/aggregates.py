"""Aggregations: conditional totals, extents, complete sets, pivots, weighted merges, roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.session import materialise


def totals(df: DataFrame, keep: Column, area: str, *by: str, more: Sequence[Column] = ()) -> DataFrame:
    """Rows and area, in all and of those that `keep` holds for (null counts as not kept), and `more` of the same pass."""
    held = F.coalesce(keep, F.lit(False))
    out = [F.count("*").alias("n_in"), F.count_if(held).alias("n_out"), F.sum(area).alias("area_in"), F.sum(F.when(held, F.col(area))).alias("area_out"), *more]
    return df.groupBy(*by).agg(*out) if by else df.agg(*out)


def extents(df: DataFrame, *by: str, more: Sequence[Column] = ()) -> DataFrame:
    out = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), *more]
    return df.groupBy(*by).agg(*out) if by else df.agg(*out)


def complete_sets(df: DataFrame, by: list[str], member: str, wanted: list[str]) -> DataFrame:
    """Groups that have every wanted member, and each group's members as one sorted text."""
    found = df.where(F.col(member).isin(wanted)).groupBy(*by).agg(F.array_sort(F.collect_set(member)).alias("s"))
    return found.select(*by, F.array_join("s", ",").alias("members"), (F.size("s") == len(set(wanted))).alias("complete"))


def pivot_values(df: DataFrame, by: list[str], column: str, values: list[str], measure: Column) -> DataFrame:
    """One column for each value, listed in advance so that no pass looks for them."""
    return df.groupBy(*by).agg(*(F.max(F.when(F.col(column) == v, measure)).alias(v) for v in values))


def merge_groups(df: DataFrame, group: str, key: str, weight: str, value: str) -> DataFrame:
    """One row for each group: least key, members, summed weight, and the weighted mean of the value
    (the plain mean where weights sum to nothing)."""
    mean = F.coalesce(F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0)), F.avg(value))
    return df.groupBy(group).agg(F.min(key).alias(key), F.count("*").alias("members"), F.sum(weight).alias(weight), mean.alias(value))


def longest_run(df: DataFrame, by: list[str], order: list[str], flag: Column) -> DataFrame:
    """`by`, longest: the most consecutive rows for which `flag` holds (gaps and islands)."""
    w = Window.partitionBy(*by).orderBy(*order)
    held = df.withColumn("_f", F.coalesce(flag, F.lit(False))).withColumn("_island", F.sum(F.when(F.col("_f"), 0).otherwise(1)).over(w))
    runs = held.groupBy(*by, "_island").agg(F.count_if("_f").alias("n"))
    return runs.groupBy(*by).agg(F.max("n").alias("longest"))


def relative_change(new: DataFrame, old: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """Full comparison by key: change, and status moved / same / added / gone."""
    a, b = new.select(key, F.col(value).alias("new")), old.select(key, F.col(value).alias("old"))
    both = a.join(b, key, "full")
    change = (F.col("new") - F.col("old")) / F.col("old")
    status = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone").when(F.abs(change) > tolerance, "moved").otherwise("same")
    return both.select(key, "new", "old", status.alias("status"))


def size_outliers(df: DataFrame, size: str, hard: tuple[float, float] = (0.05, 10.0), warn: tuple[float, float] = (0.2, 5.0)) -> DataFrame:
    """`size_ratio` to the median of all, with `size_flag` 'size' or 'size_warn' beyond the limits."""
    middle = exact_quantiles(df, size, [0.5], continuous=True).select(F.col("value").alias("_median"))
    rated = df.crossJoin(F.broadcast(middle)).withColumn("size_ratio", F.col(size) / F.col("_median")).drop("_median")
    beyond = lambda lim: (F.col("size_ratio") < lim[0]) | (F.col("size_ratio") > lim[1])
    return rated.withColumn("size_flag", F.when(beyond(hard), "size").when(beyond(warn), "size_warn"))


def exact_quantiles(df: DataFrame, value: str, shares: list[float], by: tuple[str, ...] = (), continuous: bool = False) -> DataFrame:
    """`(by, share, value)`: the least value that at least this share of a group's values do not exceed, or with
    `continuous` interpolated between the two beside the place share * (n - 1). Nulls are left out.

    Values are counted first; counts are summed in order on two levels, values within ranges of an approximate
    quantile sketch and the ranges themselves (at most RANGES), so that no task holds a group's distinct values.
    """
    counts = materialise(df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c")), "quantile-counts")
    cuts = counts.agg(F.percentile_approx("_v", F.array(*(F.lit(i / RANGES) for i in range(1, RANGES))), 10_000)).first()[0] or []
    edges = F.array(*(F.lit(x) for x in sorted(set(cuts)))) if cuts else None
    # places in a sorted array: an element's own place, or where it would go
    at = F.lit(0) if edges is None else F.size(F.filter(edges, lambda e: e < F.col("_v")))
    counts = materialise(counts.withColumn("_range", at.cast("int")), "quantile-ranges")
    ranges = counts.groupBy(*by, "_range").agg(F.sum("_c").alias("_in"))
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_in").over(ahead), F.lit(0))).withColumn("_n", F.sum("_in").over(Window.partitionBy(*by)))
    upto = F.sum("_c").over(Window.partitionBy(*by, "_range").orderBy("_v"))
    run = counts.withColumn("_upto", upto).join(ranges, [*by, "_range"]).withColumn("_upto", F.col("_before") + F.col("_upto"))
    if not continuous:
        return _at_ranks(run, by, {q: F.col("_n") * F.lit(q) for q in shares}).select(*by, "share", "value")
    place = {q: (F.col("_n") - 1) * F.lit(q) for q in shares}
    low = _at_ranks(run, by, {q: F.floor(p) + 1 for q, p in place.items()}).select(*by, "share", F.col("value").alias("_low"), "_n")
    high = _at_ranks(run, by, {q: F.ceil(p) + 1 for q, p in place.items()}).select(*by, "share", F.col("value").alias("_high"))
    part = (F.col("_n") - 1) * F.col("share") - F.floor((F.col("_n") - 1) * F.col("share"))
    return low.join(high, [*by, "share"]).select(*by, "share", (F.col("_low") + (F.col("_high") - F.col("_low")) * part).alias("value"))


#: Ranges that exact_quantiles sums values in.
RANGES = 64


def _at_ranks(run: DataFrame, by: tuple[str, ...], ranks: dict[float, Column]) -> DataFrame:
    """`(by, _n, share, value)`: the least value with at least this many values up to it."""
    each = run.groupBy(*by).agg(F.max("_n").alias("_n"), *(F.min(F.when(F.col("_upto") >= r - 1e-9, F.col("_v"))).alias(f"_{i}") for i, r in enumerate(ranks.values())))
    rows = F.array(*(F.struct(F.lit(q).alias("share"), F.col(f"_{i}").alias("value")) for i, q in enumerate(ranks)))
    return each.select(*by, "_n", F.explode(rows).alias("_r")).select(*by, "_n", "_r.*")


def flags(**conditions: Column) -> Column:
    """Names of the conditions that hold, in order, joined by commas; null does not hold."""
    return F.array_join(F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in conditions.items())), lambda x: x.isNotNull()), ",")


def flag_counts(df: DataFrame, column: str) -> DataFrame:
    each = df.where(F.length(column) > 0).select(F.explode(F.split(column, ",")).alias("flag"))
    return each.groupBy("flag").agg(F.count("*").alias("n"))


def cell_aggregate(df: DataFrame, size: int, x: str = "cx", y: str = "cy") -> DataFrame:
    """Mergeable sums by square cell (n, area, score_sum): pre-aggregated in each task before the shuffle."""
    cell = lambda c: F.floor(F.col(c) / size).cast("long")
    return df.groupBy(cell(x).alias("cell_x"), cell(y).alias("cell_y")).agg(F.count("*").alias("n"), F.sum("area").alias("area"), F.sum("score").alias("score_sum"))


def cell_rollup(cells: DataFrame, size: int, to: int) -> DataFrame:
    """Coarser cells from finer ones' sums, each fine cell dealt by its centre."""
    centre = lambda c: F.floor((F.col(c) * size + size // 2) / to).cast("long")
    return cells.groupBy(centre("cell_x").alias("cell_x"), centre("cell_y").alias("cell_y")).agg(*(F.sum(c).alias(c) for c in ("n", "area", "score_sum")))


def cell_metrics(cells: DataFrame, cell_area: float, area_unit: float = 1.0) -> DataFrame:
    """Final figures of cells from their sums: density, mean score, covered share in percent (at most 100).
    `area_unit` is what one unit of summed area is in that of the cell's."""
    return cells.select(
        "cell_x", "cell_y", "n", (F.col("n") / F.lit(float(cell_area))).alias("density"), (F.col("score_sum") / F.col("n")).alias("avg_score"),
        F.least(F.lit(100.0), F.col("area") * F.lit(100.0 * area_unit) / F.lit(float(cell_area))).alias("pct_covered"),
    )


def seeded_sample(df: DataFrame, key: str, most: int, seed: int, *by: str) -> DataFrame:
    """At most `most` rows of each group, those whose keys' seeded hashes are least. (Spark keeps no more than that
    many of a group in each task before anything moves.)"""
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(mark, key))
    return df.withColumn("_n", nth).where(F.col("_n") <= most).drop("_n")

"""Joins: grid-partitioned spatial joins, membership, set differences, joins with contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")


def boxes_meet(a: str, b: str) -> Column:
    """Do box columns x0..y1 of relation aliases `a` and `b` overlap or touch?"""
    return (F.col(f"{a}.x0") <= F.col(f"{b}.x1")) & (F.col(f"{a}.x1") >= F.col(f"{b}.x0")) & (F.col(f"{a}.y0") <= F.col(f"{b}.y1")) & (F.col(f"{a}.y1") >= F.col(f"{b}.y0"))


def overlap_area(a: str, b: str) -> Column:
    side = lambda lo, hi: F.greatest(F.least(F.col(f"{a}.{hi}"), F.col(f"{b}.{hi}")) - F.greatest(F.col(f"{a}.{lo}"), F.col(f"{b}.{lo}")), F.lit(0))
    return side("x0", "x1") * side("y0", "y1")


def with_cells(df: DataFrame, cell: float) -> DataFrame:
    """A row for each grid cell that a box reaches."""
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    return df.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))


def grid_join(left: DataFrame, right: DataFrame, cell: float, on: Column | None = None) -> DataFrame:
    """Pairs of boxes that meet, aliased a and b, each pair once.

    Both sides are dealt to grid cells and joined on the cell, so the join is a hash join whose keys
    spread with the data (and whose hot cells AQE can split); a pair that shares several cells belongs to
    the one that holds the corner of its greatest minima.
    """
    a, b = with_cells(left, cell).alias("a"), with_cells(right, cell).alias("b")
    corner = lambda k: F.floor(F.greatest(F.col(f"a.{k}"), F.col(f"b.{k}")) / cell)
    owned = (F.col("a.cx") == corner("x0")) & (F.col("a.cy") == corner("y0"))
    same = (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    joined = a.join(b, same & boxes_meet("a", "b") & owned & (F.lit(True) if on is None else on))
    return joined


def self_pairs(df: DataFrame, cell: float, key: str = "id", on: Column | None = None) -> DataFrame:
    """Pairs (a before b by `key`) of one relation whose boxes meet."""
    before = F.col(f"a.{key}") < F.col(f"b.{key}")
    return grid_join(df, df, cell, before if on is None else before & on)


def in_any_box(df: DataFrame, strips: DataFrame, cell: float, key: str = "id", keep: bool = True, on: list[str] | None = None) -> DataFrame:
    """Rows (named by `key`) whose box meets a row of `strips`, or with keep=False none; `on` are equal columns.
    Both sides are dealt to grid cells, so strips may be many; only keys and boxes are, and the rows
    themselves join by key."""
    if on:
        cond = boxes_meet("d", "s")
        for c in on:
            cond = cond & (F.col(f"d.{c}") == F.col(f"s.{c}"))
        return df.alias("d").join(strips.alias("s"), cond, "left_semi" if keep else "left_anti")
    hit = grid_join(df.select(key, *BOX), strips.select(*BOX), cell).select(F.col(f"a.{key}").alias(key)).distinct()
    return df.join(hit, key, "left_semi" if keep else "left_anti")


def flag_members(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """A boolean column: is `key` among the members? (An existence join: never null, never more rows.)"""
    marked = members.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(marked, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def unique_keys(df: DataFrame, *keys: str) -> DataFrame:
    """One row: n_rows, n_keys, is_unique."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*keys)).alias("n_keys")).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def join_attributes(df: DataFrame, aux: DataFrame, on: list[str]) -> DataFrame:
    """Left join of attributes that refuses a side with repeated keys (which would add rows)."""
    if not unique_keys(aux, *on).first()["is_unique"]:
        raise ValueError(f"attribute rows repeat a key of {on}")
    return df.join(aux, on, "left")


def set_difference(have: DataFrame, want: DataFrame, *keys: str) -> DataFrame:
    """Keys on one side alone, with `status` 'missing' (wanted, not there) or 'unexpected'."""
    h, w = have.select(*keys).distinct(), want.select(*keys).distinct()
    return w.join(h, list(keys), "left_anti").withColumn("status", F.lit("missing")).unionByName(h.join(w, list(keys), "left_anti").withColumn("status", F.lit("unexpected")))


def upsert_partition(main: DataFrame, part: DataFrame, column: str, allow_shrink: bool = False) -> DataFrame:
    """`main` with the partitions of `part` replaced; refuses to lose rows unless told so."""
    values = part.select(column).distinct()
    if not allow_shrink:
        new = part.groupBy(column).agg(F.count("*").alias("new"))
        old = main.join(values, column, "left_semi").groupBy(column).agg(F.count("*").alias("old"))
        if shrunk := old.join(new, column).where("new < old").take(1):
            raise ValueError(f"partition {shrunk[0][column]} would shrink from {shrunk[0]['old']} to {shrunk[0]['new']} rows")
    return main.join(values, column, "left_anti").unionByName(part)


def override(df: DataFrame, by: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`df` with `columns` replaced where `by` has a row for the key and a value that is not null."""
    named = by.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    return df.join(named, key, "left").select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns))


def count_gate(counted: DataFrame, published: DataFrame, key: str, tolerance: float = 0.0) -> DataFrame:
    """`(key, counted, published, problem)` of published figures (key, n) that the counted ones (key, n) do not bear
    out: 'unpublished', 'uncounted', or 'differs' by more than a share."""
    a, b = counted.select(key, F.col("n").alias("counted")), published.select(key, F.col("n").alias("published"))
    both = a.join(b, key, "full")
    apart = F.abs(F.col("counted") - F.col("published")) > F.lit(tolerance) * F.col("counted")
    problem = F.when(F.col("published").isNull(), "unpublished").when(F.col("counted").isNull(), "uncounted").when(apart, "differs")
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull())


def trusted(objects: DataFrame, *sources: DataFrame, key: str = "key", value: str = "digest") -> DataFrame:
    """`objects` (key, size) with the value of the first source (key, size, value) that speaks of an object of this size;
    null where none does, for a value of another size is of another object."""
    out, found = objects, []
    for i, source in enumerate(sources):
        named = source.select(key, F.col("size").alias(f"_size{i}"), F.col(value).alias(f"_value{i}"))
        out = out.join(named, key, "left")
        found.append(F.when(F.col("size") == F.col(f"_size{i}"), F.col(f"_value{i}")))
    return out.select(*objects.columns, F.coalesce(*found).alias(value))


def index_problems(new: DataFrame, old: DataFrame, expected: DataFrame, zone: str = "zone", year: str = "year") -> DataFrame:
    """`(problem, zone, year)` that forbid publishing an index (rows of zone and year): an expected zone that a year lacks,
    a year that is gone, a partition with fewer rows than before."""
    count = lambda d, n: d.groupBy(zone, year).agg(F.count("*").alias(n))
    a, b = count(new, "_new"), count(old, "_old")
    years = new.select(year).distinct()
    lacks = years.crossJoin(F.broadcast(expected.select(zone).distinct())).join(a, [zone, year], "left_anti").select(F.lit("zone missing").alias("problem"), zone, year)
    gone = old.select(year).distinct().join(years, year, "left_anti").select(F.lit("year gone").alias("problem"), F.lit(None).cast("string").alias(zone), year)
    shrunk = a.join(b, [zone, year]).where("_new < _old").select(F.lit("shrunk").alias("problem"), zone, year)
    return lacks.unionByName(gone).unionByName(shrunk)

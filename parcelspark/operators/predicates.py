"""Retention rules, as columns and as the SQL text that is kept for provenance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def retention_sql(max_area: float, max_water: float | None = None) -> str:
    """The rule's text: what is written beside its results, and part of their fingerprint."""
    text = f"in_utm_zone AND in_mgrs_square AND area <= {max_area}"
    return text if max_water is None else f"{text} AND coalesce(frac_water, 0) < {max_water}"


def retention(max_area: float, max_water: float | None = None) -> Column:
    return F.expr(retention_sql(max_area, max_water))


def quantised_score(share: Column) -> Column:
    """A share as a score from 0 to 100."""
    return F.least(F.lit(100), F.greatest(F.lit(0), F.round(share * 100))).cast("short")


def step_class(value: Column, edges: list[float], classes: list) -> Column:
    """Class of a value between n edges (n + 1 classes; a value equal to an edge is above it)."""
    if len(classes) != len(edges) + 1:
        raise ValueError("a step has one class more than edges")
    out = F.lit(classes[0])
    for edge, c in zip(edges, classes[1:], strict=True):
        out = F.when(value >= edge, F.lit(c)).otherwise(out)
    return out


def all_positive(value: Column) -> Column:
    """Aggregate: is every value above 0? Null and NaN are not."""
    return F.bool_and(F.coalesce((value > 0) & ~F.isnan(value), F.lit(False)))


def hash_shard(name: Column, shards: int) -> Column:
    return F.pmod(F.crc32(name.cast("string").cast("binary")), F.lit(shards)).cast("int")


def near_line(lon: Column, lat: Column, line: float, width: float, south: float, north: float) -> Column:
    """Within `width` degrees of a meridian, between two latitudes."""
    return (F.abs(lon - line) <= width) & lat.between(south, north)

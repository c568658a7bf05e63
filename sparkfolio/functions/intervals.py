"""Intervals of one group: union by gaps and islands, clusters, coverage counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, keys: list[str], start: str, end: str, touching: bool) -> DataFrame:
    """rows with `island`, the number of its cluster of overlapping intervals in its group; touching ones join if asked."""
    before = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(end).over(before)
    new = F.when(reach.isNull() | (F.col(start) > reach if touching else F.col(start) >= reach), 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("island", F.sum("_new").over(upto).cast("long")).drop("_new")


def merge(rows: DataFrame, keys: list[str], start: str, end: str, touching: bool = True) -> DataFrame:
    """(keys, island, start, end, n_members)."""
    marked = islands(rows, keys, start, end, touching)
    return marked.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n_members"))


def coverage(spans: DataFrame, units: DataFrame, keys: list[str], first: str, last: str, unit: str) -> DataFrame:
    """(keys, n_units, uncovered, overlapping): units that no span, or more than one, has (first and last in)."""
    hits = spans.select(*keys, F.explode(F.sequence(first, last)).alias(unit)).groupBy(*keys, unit).agg(F.count(F.lit(1)).alias("hits"))
    both = units.join(hits, [*keys, unit], "left")
    n = F.coalesce("hits", F.lit(0))
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_units"), F.count_if(n == 0).alias("uncovered"), F.count_if(n > 1).alias("overlapping"))

"""Dedupe of evidence, events built from dated evidence, chronology and peers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark prunes each group before the shuffle (group limit)."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def nested_top_k(rows: DataFrame, inner: list[str], outer: list[str], order: list[Column], k_inner: int, k_outer: int) -> DataFrame:
    return top_k(top_k(rows, inner, order, k_inner), outer, order, k_outer)


def best(rows: DataFrame, keys: list[str], rank: list[Column], keep: list[str]) -> DataFrame:
    """The row of least rank of each group, by an aggregate: no group meets in one task."""
    first = F.min(F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)], *[F.col(c).alias(f"k_{c}") for c in keep]))
    return rows.groupBy(*keys).agg(first.alias("x"), F.count(F.lit(1)).alias("n_merged")).select(*keys, *[F.col(f"x.k_{c}").alias(c) for c in keep], "n_merged")


def events(evidence: DataFrame, subject: str, kind: str, day: str, formal: str, within: int) -> DataFrame:
    """(subject, anchor_day, n_formal, n_attached, historical): formal evidence makes an event a day; other evidence goes to the
    nearest one, the earlier on ties, unless all are more than `within` days off, where it makes an event of its own day."""
    anchors = evidence.where(F.col(kind) == formal).groupBy(subject, F.col(day).alias("anchor_day")).agg(F.count(F.lit(1)).alias("n_formal"))
    others = evidence.where(F.col(kind) != formal).groupBy(subject, day).agg(F.count(F.lit(1)).alias("n"))
    sides = anchors.select(subject, F.col("anchor_day").alias(day), F.col("anchor_day").alias("a"), F.lit(0).cast("long").alias("n")).unionByName(others.select(subject, day, F.lit(None).cast("date").alias("a"), "n"))
    # nearest anchor on either side, by two running values: no join of all pairs
    w = Window.partitionBy(subject).orderBy(day)
    near = sides.withColumn("prev", F.last("a", True).over(w.rangeBetween(Window.unboundedPreceding, 0)))
    near = near.withColumn("next", F.first("a", True).over(w.rangeBetween(0, Window.unboundedFollowing))).where("a is null")
    back, ahead = F.datediff(F.col(day), "prev"), F.datediff("next", F.col(day))
    pick = F.when(F.col("next").isNull() | (back <= ahead), F.col("prev")).otherwise(F.col("next"))
    near = near.withColumn("anchor", F.when(F.col("prev").isNull(), F.col("next")).otherwise(pick))
    far = F.col("anchor").isNull() | (F.abs(F.datediff(F.col(day), "anchor")) > within)
    attached = near.withColumn("anchor_day", F.when(far, F.col(day)).otherwise(F.col("anchor"))).groupBy(subject, "anchor_day").agg(F.sum("n").alias("n_attached"))
    both = anchors.join(attached, [subject, "anchor_day"], "full")
    n = F.coalesce("n_formal", F.lit(0))
    return both.select(subject, "anchor_day", n.alias("n_formal"), F.coalesce("n_attached", F.lit(0)).alias("n_attached"), (n == 0).alias("historical"))


def precedence(rows: DataFrame, subject: str, kind: str, ladder: list[tuple[str, str]], default: str, alias: str = "status") -> DataFrame:
    """(subject, counts by kind, status): the first rung (kind, status) that a subject has evidence for."""
    per = rows.groupBy(subject).agg(*(F.count_if(F.col(kind) == k).alias(f"n_{k}") for k, _ in ladder))
    out = None
    for k, s in ladder:
        out = F.when(F.col(f"n_{k}") > 0, s) if out is None else out.when(F.col(f"n_{k}") > 0, s)
    return per.withColumn(alias, out.otherwise(default))


def after_all(rows: DataFrame, subject: str, kind: str, day: str, place: str, later: str, earlier: str) -> DataFrame:
    """(subject, holds): some `later` row is at or after every `earlier` row. Days are ISO, of day or month precision, which makes
    a partial order: other months decide, then days where both have one, equal ones by their place, a day and its month not.
    A subject's `earlier` rows count by three maxima (months, days of the last month, places of its last day), so that no
    pairs are made."""
    d, month = F.col(day), F.substring(F.col(day), 1, 7)
    first, second = rows.where(F.col(kind) == later), rows.where(F.col(kind) == earlier)
    full = F.length(d) == 10
    ahead = second.groupBy(subject).agg(F.max(month).alias("_m"))
    top = second.join(ahead, subject).where(month == F.col("_m"))
    top = top.groupBy(subject).agg(
        F.max("_m").alias("_m"), F.max(F.when(full, d)).alias("_d"), F.bool_or(~full).alias("_vague"), F.max_by(F.col(place), F.struct(d, F.col(place))).alias("_p"), F.max(F.when(~full, F.col(place))).alias("_q"),
    )
    both = first.select(subject, d.alias("_x"), F.col(place).alias("_y")).join(top, subject, "left")
    x_full, x_month = F.length("_x") == 10, F.substring("_x", 1, 7)
    in_month = F.when(x_full, ~F.col("_vague") & ((F.col("_x") > F.col("_d")) | (F.col("_x") == F.col("_d")) & (F.col("_y") >= F.col("_p")))).otherwise(F.col("_d").isNull() & (F.col("_y") >= F.col("_q")))
    ok = F.when(F.col("_m").isNull() | (x_month > F.col("_m")), True).when(x_month < F.col("_m"), False).otherwise(F.coalesce(in_month, F.lit(False)))
    held = both.groupBy(subject).agg(F.bool_or(ok).alias("holds"))
    return rows.where(F.col(kind).isin(later, earlier)).select(subject).distinct().join(held, subject, "left").select(subject, F.coalesce("holds", F.lit(False)).alias("holds"))


def near(rows: DataFrame, keys: list[str], at: str, is_anchor: Column, is_action: Column, distance: int) -> DataFrame:
    """Actions with an anchor of the same group within `distance`: nearest anchors by running values, not a range join."""
    w = Window.partitionBy(*keys).orderBy(at)
    place = F.when(is_anchor, F.col(at))
    out = rows.withColumn("_p", F.max(place).over(w.rangeBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.min(place).over(w.rangeBetween(0, Window.unboundedFollowing)))
    gap = F.least(F.col(at) - F.col("_p"), F.col("_n") - F.col(at))
    return out.withColumn("gap", gap).where(is_action & (F.col("gap") <= distance)).drop("_p", "_n")


def peers(rows: DataFrame, document: str, section: str, day: str, subtype: Column) -> DataFrame:
    """(document, section, day, n_rows, n_peers): rows of the same section, or of the same document and day with a listed subtype,
    the row itself among them. Rows are counted by (document, section, day) first; then sums over two windows, less what
    both count, take the place of an OR join, after one shuffle by document."""
    per = rows.groupBy(document, section, day).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(subtype).alias("_s"))
    same, today = Window.partitionBy(document, section), Window.partitionBy(document, day)
    return per.repartition(document).select(document, section, day, "n_rows", (F.sum("n_rows").over(same) + F.sum("_s").over(today) - F.col("_s")).alias("n_peers"))

"""Judgments, review queues, selection, bounded context and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(rules: list[tuple[str, Column]]) -> Column:
    """The codes of the rules that hold, in order."""
    return F.array_compact(F.array(*(F.when(c, code) for code, c in rules)))


def judge(rows: DataFrame, positive: Column, clinical: Column, chars: Column, enough: int) -> DataFrame:
    """judgment: yes on positive evidence in the right context, uncertain on other positive evidence, no on enough text without any."""
    out = F.when(positive & clinical, "yes").when(positive, "uncertain").when(clinical & (chars >= enough), "no").otherwise("uncertain")
    return rows.withColumn("judgment", out)


def select(rows: DataFrame, policy: str, status: str, flagged: Column, routed: Column) -> DataFrame:
    """Rows under a policy: all, unknown, review_required or ambiguous."""
    known = {"all": F.lit(True), "unknown": F.col(status) == "unknown", "review_required": flagged, "ambiguous": routed}
    if policy not in known:
        raise ValueError(f"unknown policy {policy}")
    return rows.where(F.coalesce(known[policy], F.lit(False)))


def budget(rows: DataFrame, keys: list[str], order: str, text: str, most: int) -> DataFrame:
    """(keys, n_taken, chars): passages in order while their running length stays below a budget; one that does not fit is
    skipped and shorter ones may follow, hence a fold and not a running sum."""
    each = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.length(text).alias("n")))).alias("x"))
    start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("c"))
    taken = F.aggregate("x", start, lambda a, x: F.when(a.c + x.n <= most, F.struct((a.k + 1).alias("k"), (a.c + x.n).alias("c"))).otherwise(a))
    return each.select(*keys, taken.alias("t")).select(*keys, F.col("t.k").alias("n_taken"), F.col("t.c").alias("chars"))


def reconcile(rows: DataFrame, answers: DataFrame, key: str, ours: str, theirs: str) -> DataFrame:
    """rows with their answer and agreement; an answer never overrides."""
    out = rows.join(answers, key, "left")
    state = F.when(F.col(theirs).isNull(), "no_response").when(F.col(ours) == F.col(theirs), "agree").otherwise("disagree")
    return out.withColumn("agreement", state)

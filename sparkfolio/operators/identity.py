"""Which records are the same: canonical choice, duplicates, conflicts, evidence-set matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical(records: DataFrame, content: Column, key: str, order: list[Column]) -> DataFrame:
    """records with content_key, is_canonical and duplicate_of: the first of each content in the given order stands for it.
    A null content is the content of its own record alone: what could not be read never collapses."""
    keyed = records.withColumn("content_key", content).withColumn("_own", F.coalesce(F.col("content_key"), F.concat(F.lit("unreadable_"), F.col(key).cast("string"))))
    # an aggregate finds the leader, so that a content that many records share is no single task
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(key).alias("leader"))
    lead = keyed.groupBy("_own").agg(F.min(rank).alias("first")).select("_own", F.col("first.leader").alias("leader"))
    joined = keyed.join(lead, "_own")
    return joined.withColumn("is_canonical", F.col(key) == F.col("leader")).withColumn("duplicate_of", F.when(~F.col("is_canonical"), F.col("leader"))).drop("leader", "_own")


def duplicate_groups(records: DataFrame, content: Column, key: str) -> DataFrame:
    """(content_key, n, leader) of the contents that several records have."""
    keyed = records.select(F.col(key).alias("_k"), content.alias("content_key")).where("content_key is not null")
    return keyed.groupBy("content_key").agg(F.count(F.lit(1)).alias("n"), F.min("_k").alias("leader")).where("n > 1")


def duplicate_members(records: DataFrame, content: Column, key: str) -> DataFrame:
    """(key, content_key, n, leader): a row for each record of a repeated content; members are never gathered."""
    return records.select(key, content.alias("content_key")).join(duplicate_groups(records, content, key), "content_key")


def identity_conflicts(records: DataFrame, content: Column, owner: str) -> DataFrame:
    """Contents that several owners claim."""
    grouped = records.groupBy(content.alias("content_key")).agg(F.count_distinct(owner).alias("n_owners"), F.concat_ws("|", F.array_sort(F.collect_set(owner))).alias("owners"))
    return grouped.where("n_owners > 1")


def duplicate_suffix(records: DataFrame, name: Column, order: str, alias: str) -> DataFrame:
    """records with an id that is the name, and name_duplicate_2 and so on for its later bearers."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return records.withColumn(alias, F.when(n == 1, name).otherwise(F.concat(name, F.lit("_duplicate_"), n.cast("string"))))


def resolve_matches(evidence: DataFrame, files: DataFrame, key: str, method: str = "method", candidate: str = "candidate") -> DataFrame:
    """(key, n_methods, n_candidates, match_status, matched): the candidates that all methods with evidence agree on, counted by
    candidate and never gathered. One is a match; none, or several, is ambiguous; a file without evidence is unmatched."""
    each = evidence.select(key, method, candidate).distinct()
    methods = each.groupBy(key).agg(F.count_distinct(method).alias("n_methods"))
    shared = each.groupBy(key, candidate).agg(F.count(F.lit(1)).alias("n")).join(methods, key).where("n = n_methods")
    common = shared.groupBy(key).agg(F.count(F.lit(1)).alias("n_candidates"), F.min(candidate).alias("one"))
    out = files.select(key).distinct().join(methods, key, "left").join(common, key, "left")
    status = F.when(F.col("n_methods").isNull(), "unmatched").when(F.col("n_candidates") == 1, "matched").otherwise("ambiguous")
    return out.select(key, F.coalesce("n_methods", F.lit(0)).alias("n_methods"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), status.alias("match_status"), F.when(status == "matched", F.col("one")).alias("matched"))


def header_references(files: DataFrame, key: str, text: str, patterns: dict[str, str], head: int = 20_000) -> DataFrame:
    """(key, method, reference): identifiers that labelled patterns find in the head of a text."""
    parts = [files.select(key, F.lit(m).alias("method"), F.explode(F.regexp_extract_all(F.substring(F.col(text), 1, head), F.lit(p), F.lit(1))).alias("reference")) for m, p in patterns.items()]
    return reduce(DataFrame.unionByName, parts).distinct()

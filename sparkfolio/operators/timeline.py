"""Reliable dated records of a subject, cut-offs and date buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BAD_STATUS = ("failed", "text_layer_unusable", "empty", "identity_conflict")


def reliable(sections: DataFrame, subject: str, date: str, uncertain: Column | None = None, status: Column | None = None) -> DataFrame:
    """Sections of a known subject with a valid ISO date that no flag puts in doubt."""
    keep = F.col(subject).isNotNull() & (F.coalesce(F.col(subject).cast("string"), F.lit("")) != "")
    keep = keep & F.try_to_date(F.substring(F.col(date), 1, 10), "yyyy-MM-dd").isNotNull()
    if uncertain is not None:
        keep = keep & ~F.coalesce(uncertain, F.lit(False))
    if status is not None:
        keep = keep & ~F.coalesce(status.isin(list(BAD_STATUS)), F.lit(False))
    return sections.where(keep)


def make(sections: DataFrame) -> DataFrame:
    """The timeline of all subjects, in order of subject, date, document and section; a minute's date stands before its day's."""
    kept = reliable(sections, "patient_id", "section_date", F.col("date_uncertain"), F.col("parse_status"))
    date = F.when(F.coalesce("document_timestamp", F.lit("")) != "", F.col("document_timestamp")).otherwise(F.col("section_date"))
    rows = kept.select(
        "patient_id", date.alias("date"), "date_precision", F.col("section_type").alias("event_type"), F.col("section_subtype").alias("event_subtype"), "document_id", "section_id", "source_pdf", F.col("page_start").alias("page"), "page_end",
        "date_source", "date_evidence", "date_page", "parse_status", "clinical_stage", "leakage_risk", F.lit("").alias("available_at"), F.lit(True).alias("cutoff_review_required"), "text_source", "date_requires_review",
        "date_evidence_confidence", "flags", "leakage_flags",
    )
    return rows.orderBy("patient_id", "date", "document_id", "section_id")


def before_cutoff(timeline: DataFrame, date: str, cutoff: str, subject: str | None = None, value=None, review: str = "date_requires_review") -> DataFrame:
    """Strictly before the cut-off day, of one subject if given; dates that still need a review stay out."""
    out = timeline.where(F.substring(F.col(date), 1, 10) < cutoff)
    if review in timeline.columns:
        out = out.where(~F.coalesce(F.lower(F.col(review).cast("string")).isin("true", "1"), F.lit(False)))
    return out if subject is None else out.where(F.col(subject) == value)


def years(rows: DataFrame, date: Column) -> DataFrame:
    return rows.groupBy(F.substring(date, 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def section_ranges(starts: DataFrame, document: str, ordinal: str) -> DataFrame:
    """Each section runs to the next boundary, exclusive; the last to the end of its document (null)."""
    return starts.withColumn("next_start", F.lead(ordinal).over(Window.partitionBy(document).orderBy(ordinal)))


def section_date(candidates: DataFrame, keys: list[str], priority: str, date: str) -> DataFrame:
    """(keys, date, date_status, n_candidates): the one date of the best priority; several conflict and leave it unknown."""
    per = candidates.groupBy(*keys, priority).agg(F.count_distinct(date).alias("n_dates"), F.min(date).alias("first_date"), F.count(F.lit(1)).alias("n_candidates"))
    best = per.groupBy(*keys).agg(F.min(F.struct(priority, "n_dates", "first_date", "n_candidates")).alias("x")).select(*keys, "x.*")
    one = F.col("n_dates") == 1
    return best.select(*keys, F.when(one, F.col("first_date")).otherwise("").alias("date"), F.when(one, "known").otherwise("conflicting_dates").alias("date_status"), "n_candidates")

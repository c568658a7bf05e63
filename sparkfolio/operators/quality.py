"""Manifests, counts and text quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def manifest(subjects: DataFrame, documents: DataFrame, subject: str, owner: str, status: str, date: str, statuses: list[str], good: str) -> DataFrame:
    """One row a subject, also without documents: counts by status, first and last date, parse_status."""
    counts = [F.count_if(F.col(status) == s).alias(f"n_{s.lower()}") for s in statuses]
    per = documents.groupBy(F.col(owner).alias(subject)).agg(F.count(F.lit(1)).alias("n_documents"), *counts, F.min(date).alias("earliest"), F.max(date).alias("latest"))
    out = subjects.select(subject).join(per, subject, "left")
    names = ["n_documents", *(f"n_{s.lower()}" for s in statuses)]
    out = out.withColumns({n: F.coalesce(n, F.lit(0)) for n in names})
    state = F.when(F.col("n_documents") == 0, "no_documents").when(F.col(f"n_{good.lower()}") == F.col("n_documents"), "complete").when(F.col(f"n_{good.lower()}") > 0, "partial").otherwise("pending")
    return out.withColumn("parse_status", state)


def summary(metrics: dict[str, Column], rows: DataFrame) -> DataFrame:
    """(metric, value): all aggregates in one pass."""
    one = rows.agg(*(c.cast("double").alias(n) for n, c in metrics.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in metrics))).alias("x")).select("x.*")


def counts(rows: DataFrame, *kinds: str) -> DataFrame:
    """(kind, value, n) of several columns."""
    return reduce(DataFrame.unionByName, [rows.groupBy(F.col(k).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "value", "n") for k in kinds])


def flag_counts(rows: DataFrame, flags: Column) -> DataFrame:
    return rows.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def page_quality(text: Column, glyphs: Column | None = None, paints: Column | None = None, image_area: Column | None = None, off_page: Column | None = None) -> Column:
    """(status, flags) of a page: ok, partial, empty or text_layer_unusable, by its text and by what its drawing shows: paths of
    the size of glyphs, paint operations, the largest image's share, characters off the page. Few ideographs are no fault."""
    zero = F.lit(0)
    glyphs, paints, image_area, off_page = (zero if x is None else F.coalesce(x, zero) for x in (glyphs, paints, image_area, off_page))
    t = F.coalesce(text, F.lit(""))
    count = F.length(F.regexp_replace(t, "^[\\s\\x85\\xA0\\u3000]+|[\\s\\x85\\xA0\\u3000]+$", ""))
    cjk = F.length(F.regexp_replace(t, "[^\\u3400-\\u4dbf\\u4e00-\\u9fff\\x{20000}-\\x{2fa1f}]", ""))
    bad = F.length(t) - F.length(F.replace(t, F.lit("\ufffd"), F.lit("")))
    empty = count == 0
    outlined = (glyphs >= 20) & (cjk < 5)
    mixed = ~outlined & (glyphs >= 100) & (glyphs > cjk * 2)
    image = (image_area >= 0.25) & ((cjk < 5) | (count < 80))
    broken, tiny = (bad >= 3) & (bad / F.greatest(count, F.lit(1)) >= 0.02), ~empty & (count < 40)
    flags = [
        (empty, "empty_text"), (empty & (paints == 0), "blank_page"), (empty & (paints > 0), "text_layer_missing"), (tiny, "suspiciously_tiny_text"), (~empty & (cjk == 0), "no_cjk_text"),
        (outlined & ~(empty & (paints == 0)), "vector_outlined_text_suspected"), (mixed, "mixed_vector_and_text_content_suspected"), (image, "image_based_content_suspected"), (broken, "possible_encoding_issue"), (off_page > 0, "off_page_text"),
    ]
    status = F.when(empty & (paints == 0), "empty").when(outlined | empty, "text_layer_unusable").when(mixed | image | broken | tiny, "partial").otherwise("ok")
    only = F.when(empty & (paints == 0), F.array(F.lit("empty_text"), F.lit("blank_page"))).otherwise(F.array_compact(F.array(*(F.when(hit, n) for hit, n in flags))))
    return F.struct(status.alias("status"), only.alias("flags"))


#: Views of what needs a look, by name: the table that each is drawn from and its condition.
ISSUES = {
    "unmatched_files": ("documents", "coalesce(patient_id, '') = ''"),
    "patients_without_pdf": ("manifest", "n_pdf = 0"),
    "parse_failures": ("documents", "coalesce(duplicate_of, '') = '' and parse_status <> 'ok'"),
    "empty_or_tiny_text": ("pages", "coalesce(char_count, 0) < 80"),
    "tiny_nonempty_pages": ("pages", "char_count > 0 and char_count < 80"),
    "page_issues": ("pages", "size(flags) > 0 or coalesce(extraction_status, '') not in ('ok', 'success')"),
    "uncertain_documents": ("sections", "section_type <> 'nonclinical' and (section_type = 'unknown' or coalesce(section_date, '') = '' or coalesce(date_uncertain, false) or parse_status <> 'ok')"),
    "dates_requiring_review": ("sections", "section_type <> 'nonclinical' and (coalesce(date_requires_review, false) or coalesce(date_uncertain, false))"),
}


def issues(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    source, condition = ISSUES[name]
    return tables[source].where(condition)


def cohort_summary(manifest: DataFrame, documents: DataFrame, sections: DataFrame, pages: DataFrame, timeline: DataFrame, matching_issues: DataFrame) -> DataFrame:
    """(metric, value): counts over all tables, and counters by status, flag, type and issue as metric.value rows."""
    canonical = documents.where("coalesce(duplicate_of, '') = ''")
    dated = (F.coalesce("section_date", F.lit("")) != "") & ~F.coalesce("date_uncertain", F.lit(False))
    matched = F.coalesce("patient_id", F.lit("")) != ""
    own = F.coalesce("duplicate_of", F.lit("")) == ""
    one = F.count(F.lit(1))
    parts = [
        summary({"cohort_patients": one, "patients_with_pdf": F.count_if(F.col("n_pdf") > 0), "patients_without_pdf": F.count_if(F.col("n_pdf") == 0)}, manifest),
        summary({
            "source_pdf_files": one, "unique_pdf_contents": F.count_if(own), "exact_duplicate_copies": F.count_if(~own), "matched_unique_pdfs": F.count_if(own & matched), "unmatched_unique_pdfs": F.count_if(own & ~matched),
            "total_unique_pdf_pages": F.coalesce(F.sum(F.when(own, F.col("page_count"))), F.lit(0)), "total_extracted_characters": F.coalesce(F.sum(F.when(own, F.col("extracted_character_count"))), F.lit(0)),
        }, documents),
        summary({"sections": one, "sections_with_date": F.count_if(dated), "sections_without_date": F.count_if(~dated)}, sections),
        summary({"empty_pages": F.count_if(F.coalesce("char_count", F.lit(0)) == 0), "tiny_nonempty_pages": F.count_if((F.col("char_count") > 0) & (F.col("char_count") < 80))}, pages),
        summary({"timeline_events": one, "patients_with_timeline": F.count_distinct("patient_id")}, timeline),
    ]

    def counter(name: str, rows: DataFrame, value: Column) -> DataFrame:
        return rows.select(value.alias("v")).where("v is not null").groupBy("v").agg(one.alias("n")).select(F.concat(F.lit(f"{name}."), F.col("v").cast("string")).alias("metric"), F.col("n").cast("double").alias("value"))

    parts += [
        counter("pdf_parse_status", canonical, F.col("parse_status")), counter("pdf_flags", canonical, F.explode("flags")), counter("page_status", pages, F.col("extraction_status")), counter("page_flags", pages, F.explode("flags")),
        counter("section_types", sections, F.col("section_type")), counter("matching_issue_types", matching_issues, F.col("issue_type")),
    ]
    return reduce(DataFrame.unionByName, parts)


def patient_manifest(cohort: DataFrame, documents: DataFrame, sections: DataFrame, timeline: DataFrame) -> DataFrame:
    """One row a subject of the cohort, with document counts by status (canonical ones; n_source_pdf counts copies too),
    sections, first and last date, and a status over all."""
    own = F.coalesce("duplicate_of", F.lit("")) == ""

    def count(*status: str) -> Column:
        return F.count_if(own & F.col("parse_status").isin(*status))

    per = documents.groupBy("patient_id").agg(
        F.count_if(own).alias("n_pdf"), F.count(F.lit(1)).alias("n_source_pdf"), count("ok").alias("n_parsed_pdf"), count("partial").alias("n_partial_pdf"), count("ok", "partial").alias("n_readable_pdf"),
        F.count_if(own & (F.coalesce("ocr_recovered_page_count", F.lit(0)) > 0)).alias("n_ocr_pdf"), count("text_layer_unusable").alias("n_unusable_pdf"), count("failed").alias("n_failed_pdf"), count("empty").alias("n_empty_pdf"),
    )
    parts = sections.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_sections"))
    span = timeline.groupBy("patient_id").agg(F.min("date").alias("earliest_document_date"), F.max("date").alias("latest_document_date"))
    rows = cohort.select("patient_id", "has_inpatient_id", "has_outpatient_id").join(per, "patient_id", "left").join(parts, "patient_id", "left").join(span, "patient_id", "left").fillna(0).fillna("", ["earliest_document_date", "latest_document_date"])
    status = F.when(F.col("n_pdf") == 0, "no_pdf_in_scope").when(F.col("n_parsed_pdf") == F.col("n_pdf"), "ok").when(F.col("n_readable_pdf") == 0, "unusable").otherwise("partial")
    return rows.withColumn("parse_status", status)

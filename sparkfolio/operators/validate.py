"""Integrity checks: each is a query for offenders; none means that the data hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, foreign: str, key: str, artifact: Column) -> DataFrame:
    return child.join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti").select(artifact.cast("string").alias("artifact_id"))


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return grouped.select(F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("artifact_id"))


def offenders(rows: DataFrame, bad: Column, artifact: Column) -> DataFrame:
    return rows.where(bad).select(artifact.cast("string").alias("artifact_id"))


def report(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """(code, artifact_id) of all offenders."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(code).alias("code"), "artifact_id") for code, df in checks])


def counts(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """(code, n_errors, passed), also of checks without offenders."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n_errors")).select(F.lit(code).alias("code"), "n_errors", (F.col("n_errors") == 0).alias("passed")) for code, df in checks])


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) == ""


def _named(code: str, rows: DataFrame, bad: Column, artifact: str) -> tuple:
    return code, rows, bad, artifact


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut, so that several checks of it do not compute it anew: a reliable checkpoint where the session names
    a folder for those, else a cache."""
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        return df.checkpoint()
    return df.cache()


def _report(checks: list[tuple]) -> DataFrame:
    """(code, artifact_id) of all offenders; the checks of one table's rows are one pass over it."""
    parts = [df.select(F.lit(c[0]).alias("code"), "artifact_id") for c in checks if len(c) == 2 for df in [c[1]]]
    tables: dict[tuple[int, str], list[tuple]] = {}
    for c in checks:
        if len(c) == 4:
            tables.setdefault((id(c[1]), c[3]), []).append(c)
    for (_, artifact), own in tables.items():
        codes = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), code) for code, _, bad, _ in own)))
        parts.append(own[0][1].select(F.explode(codes).alias("code"), F.col(artifact).cast("string").alias("artifact_id")))
    return reduce(DataFrame.unionByName, parts)


def output_errors(manifest: DataFrame, documents: DataFrame, pages: DataFrame, sections: DataFrame, timeline: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """(code, artifact_id) of what does not hold in a run: ids, references, canonical copies, pages, section texts and offsets,
    line coverage, provenance of dates, the timeline, and counts that do not follow from their rows."""
    from sparkfolio.operators import segment

    own, who = ~_blank("patient_id"), "patient_id"
    target = documents.select(F.col("document_id").alias("duplicate_of"), F.col("duplicate_of").alias("_its"), F.col("sha256").alias("_hash"))
    copies = documents.where(~_blank("duplicate_of")).join(target, "duplicate_of", "left")
    leads = documents.where(~_blank("sha256")).groupBy("sha256").agg(F.count_if(_blank("duplicate_of")).alias("n"))
    canonical = documents.where(_blank("duplicate_of"))
    per_page = pages.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("lo"), F.max("page").alias("hi"), F.sum(F.length("text")).alias("chars"))
    counted = canonical.join(per_page, "document_id", "left").join(sections.groupBy("document_id").agg(F.count(F.lit(1)).alias("_sections")), "document_id", "left")
    lines = pages.select("document_id", F.col("page").cast("long").alias("page"), F.split(F.coalesce("normalized_text", F.lit("")), "\n").alias("_lines"))
    spans = sections.select("document_id", "section_id", "text", F.posexplode("page_spans").alias("_k", "s")).select("*", F.col("s.page").cast("long").alias("page")).join(lines, ["document_id", "page"], "left")
    inside = (F.col("s.start_line") >= 1) & (F.col("s.end_line") >= F.col("s.start_line")) & (F.col("s.end_line") <= F.size("_lines"))
    piece = F.struct("_k", F.array_join(F.when(inside, F.slice("_lines", F.col("s.start_line"), F.col("s.end_line") - F.col("s.start_line") + 1)), "\n").alias("t"))
    rebuilt = spans.groupBy("section_id").agg(F.first("text").alias("text"), F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x.t), "\n").alias("_again"))
    sure = sections.where(~_blank("section_date") & ~F.coalesce("date_uncertain", F.lit(False)))
    base = F.regexp_replace("date_source", "^local_ocr:", "")
    event = timeline.join(sections.select("section_id", *(F.col(c).alias(f"_{c}") for c in (who, "section_date", "date_uncertain"))), "section_id", "left")
    docs = documents.where(own).groupBy(who).agg(F.count_if(_blank("duplicate_of")).alias("_pdf"), F.count(F.lit(1)).alias("_source"), F.count_if(_blank("duplicate_of") & (F.col("parse_status") == "ok")).alias("_ok"))
    dates = timeline.groupBy(who).agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    book = manifest.join(docs, who, "left").join(sections.groupBy(who).agg(F.count(F.lit(1)).alias("_n")), who, "left").join(dates, who, "left")

    def differs(stored: str, found: str) -> Column:
        return F.coalesce(F.col(stored), F.lit(0)) != F.coalesce(F.col(found), F.lit(0))

    checks = [
        ("duplicate_document_id", repeated(documents, "document_id")), ("duplicate_section_id", repeated(sections, "section_id")), ("duplicate_manifest_patient_id", repeated(manifest, who)),
        ("document_patient_not_in_manifest", orphans(documents.where(own), manifest, who, who, F.col("document_id"))), _named("ambiguous_document_assigned_patient", documents, F.col("match_status").startswith("ambiguous") & own, "document_id"),
        _named("duplicate_target_not_canonical", copies, F.col("_its").isNull() | (F.col("_its") != ""), "document_id"), _named("duplicate_target_hash_mismatch", copies, ~F.col("sha256").eqNullSafe(F.col("_hash")) | _blank("sha256"), "document_id"),
        _named("sha256_group_multiple_canonicals", leads, F.col("n") != 1, "sha256"), _named("page_count_mismatch", counted, differs("page_count", "n"), "document_id"),
        _named("noncontiguous_page_numbers", per_page, (F.col("lo") != 1) | (F.col("hi") != F.col("n")), "document_id"), _named("extracted_character_count_mismatch", counted, differs("extracted_character_count", "chars"), "document_id"),
        _named("document_section_count_mismatch", counted, differs("n_sections", "_sections"), "document_id"), ("section_uses_noncanonical_document", orphans(sections, canonical, "document_id", "document_id", F.col("section_id"))),
        _named("section_span_page_missing", spans, F.col("_lines").isNull(), "section_id"), _named("section_span_line_out_of_bounds", spans, F.col("_lines").isNotNull() & ~inside, "section_id"),
        _named("section_text_not_equal_to_normalized_spans", rebuilt, F.col("text") != F.col("_again"), "section_id"),
        _named("reliable_date_unsupported_provenance", sure, ~base.isin("title_timestamp", "test_timestamp_column") & ~base.startswith("explicit_field:"), "section_id"),
        _named("date_evidence_not_in_section", sure, _blank("date_evidence") | ~F.contains("text", "date_evidence"), "section_id"), _named("ocr_date_missing_review_flag", sure, F.col("date_source").startswith("local_ocr:") & ~F.array_contains("flags", "date_requires_review"), "section_id"),
        _named("invalid_section_date", sure, F.try_to_date("section_date", "yyyy-MM-dd").isNull(), "section_id"),
        _named("date_page_outside_section", sure, ~F.exists("page_spans", lambda s: s.page == F.col("date_page")), "section_id"), _named("section_line_coverage_failure", segment.coverage(pages, sections), (F.col("uncovered_lines") > 0) | (F.col("overlapping_lines") > 0), "document_id"),
        ("duplicate_timeline_section", repeated(timeline, "section_id")), ("timeline_section_missing", orphans(timeline, sections, "section_id", "section_id", F.col("section_id"))), ("timeline_uses_duplicate_source", orphans(timeline, canonical, "document_id", "document_id", F.col("section_id"))),
        _named("timeline_patient_mismatch", event, F.col(f"_{who}").isNotNull() & (_blank(who) | (F.col(who) != F.col(f"_{who}"))), "section_id"), _named("timeline_uses_uncertain_date", event, F.col("_date_uncertain") | _blank("_section_date") & F.col(f"_{who}").isNotNull(), "section_id"),
        _named("timeline_date_mismatch", event, F.substring("date", 1, 10) != F.col("_section_date"), "section_id"), _named("timeline_uses_unusable_section", timeline, F.col("parse_status").isin("failed", "empty", "text_layer_unusable", "identity_conflict"), "section_id"),
        _named("timeline_cutoff_review_contract_broken", timeline, ~_blank("available_at") | ~F.coalesce("cutoff_review_required", F.lit(False)), "section_id"),
        _named("manifest_count_mismatch", book, differs("n_pdf", "_pdf") | differs("n_source_pdf", "_source") | differs("n_parsed_pdf", "_ok") | differs("n_sections", "_n"), who),
        _named("manifest_date_range_mismatch", book, (F.col("earliest_document_date") != F.coalesce("_first", F.lit(""))) | (F.col("latest_document_date") != F.coalesce("_last", F.lit(""))), who),
    ]
    if inventory is not None:
        known = inventory.join(documents.select("document_id", F.col("sha256").alias("_hash")), "document_id", "left")
        checks += [_named("source_inventory_hash_mismatch", known, ~F.col("sha256").eqNullSafe(F.col("_hash")), "document_id"), _named("source_integrity_claim_not_supported", inventory, ~F.col("unchanged"), "document_id")]
    return _report(checks)


def relevance_errors(cases: DataFrame, evidence: DataFrame, complete: bool = False) -> DataFrame:
    """(code, artifact_id) of a review package: subjects, evidence without a case, statuses and final judgments."""
    status, final = F.coalesce("review_status", F.lit("")), F.coalesce("final_aaoca_judgment", F.lit(""))
    checks = [
        ("invalid_or_duplicate_exception_patient_id", repeated(cases, "patient_id")), _named("missing_exception_patient_id", cases, _blank("patient_id"), "patient_id"),
        ("evidence_patient_not_in_exception_cases", orphans(evidence, cases, "patient_id", "patient_id", F.col("patient_id"))), _named("invalid_review_status", cases, ~status.isin("not_reviewed", "in_review", "reviewed"), "patient_id"),
        _named("invalid_final_judgment", cases, ~final.isin("", "yes", "no", "uncertain"), "patient_id"), _named("final_judgment_without_reviewed_status", cases, (final != "") & (status != "reviewed"), "patient_id"),
    ]
    if complete:
        checks.append(_named("review_incomplete", cases, (status != "reviewed") | (final == ""), "patient_id"))
    return _report(checks)


def import_reviews(cases: DataFrame, reviews: DataFrame) -> DataFrame:
    """cases with the human fields of reviews (patient_id, review_status, final_aaoca_judgment, reviewer_notes); both must have
    the same subjects, once each, and the result must pass relevance_errors."""
    fields = ["review_status", "final_aaoca_judgment", "reviewer_notes"]
    ids = [df.select("patient_id") for df in (cases, reviews)]
    if not ids[0].exceptAll(ids[1]).isEmpty() or not ids[1].exceptAll(ids[0]).isEmpty():
        raise ValueError("reviews and cases have different subjects")
    out = cases.drop(*fields).join(reviews.select("patient_id", *fields), "patient_id")
    bad = relevance_errors(out, cases.select("patient_id").limit(0)).limit(10).collect()
    if bad:
        raise ValueError("; ".join(f"{r.artifact_id}: {r.code}" for r in bad))
    return out


def span_errors(evidence: DataFrame, sections: DataFrame, code: str = "evidence_span_text_mismatch") -> DataFrame:
    """Evidence whose text is not what its section has at its offsets."""
    both = evidence.join(sections.select("section_id", F.col("text").alias("_text")), "section_id")
    low, size = F.col("char_start"), F.col("char_end") - F.col("char_start")
    bad = (low < 0) | (size <= 0) | (F.col("char_end") > F.length("_text")) | (F.substring("_text", low + 1, size) != F.col("evidence_text"))
    return _report([_named(code, both, bad, "evidence_id")])


def management_errors(selection: DataFrame, sections: DataFrame, evidence: DataFrame, events: DataFrame, summary: DataFrame) -> DataFrame:
    """(code, artifact_id) of a management package: enumerations, references, spans, dates' shapes, and everything that can be
    derived again: flags and counts of the summary, events from the evidence."""
    from sparkfolio.operators import management

    who = "patient_id"
    rest = cut(management.events(evidence))
    again = cut(management.summary(selection, evidence, rest))
    derived = ["observed_management", "overall_treatment_status", "actual_aaoca_surgery", "n_surgery_events", "surgery_event_count_status", "has_completed_surgery_evidence", "has_surgical_intent_evidence", "has_conservative_evidence",
               "n_management_evidence_rows", "other_cardiac_procedure_status", "aaoca_handling_during_other_procedure", "complex_case_review_priority", "review_required"]
    both = summary.join(again.select(who, *(F.col(c).alias(f"_{c}") for c in derived)), who, "left")
    part = events.select(who, "surgery_event_id", F.explode("supporting_evidence_ids").alias("evidence_id"))
    day = F.col("surgery_date")
    shape = F.when(F.col("surgery_date_precision") == "day", day.rlike("^\\d{4}-\\d{2}-\\d{2}$")).when(F.col("surgery_date_precision") == "month", day.rlike("^\\d{4}-\\d{2}$")).otherwise(day == "")
    listed = summary.where(F.col("primary_evidence_id") != "")
    checks = [
        ("summary_patient_set_mismatch", orphans(selection, summary, who, who, F.col(who))), ("summary_patient_not_selected", orphans(summary, selection, who, who, F.col(who))), ("duplicate_summary_patient", repeated(summary, who)),
        ("duplicate_evidence_id", repeated(evidence, "evidence_id")), ("duplicate_surgery_event_id", repeated(events, "surgery_event_id")), ("evidence_section_not_found", orphans(evidence, sections, "section_id", "section_id", F.col("evidence_id"))),
        ("evidence_patient_not_selected", orphans(evidence, selection, who, who, F.col("evidence_id"))), ("event_evidence_not_found", orphans(part, evidence, "evidence_id", "evidence_id", F.col("surgery_event_id"))),
        ("summary_primary_evidence_not_found", orphans(listed, evidence, "primary_evidence_id", "evidence_id", F.col(who))),
        _named("invalid_assertion", evidence, ~F.col("assertion").isin("completed", "intended", "cancelled_or_declined", "conservative", "diagnostic_completed", "unrelated_completed", "context_only"), "evidence_id"),
        _named("invalid_strength", evidence, ~F.col("strength").isin("high", "medium", "low"), "evidence_id"), _named("non_completed_row_counts_as_surgery", evidence, F.col("counts_as_aaoca_surgery") & (F.col("assertion") != "completed"), "evidence_id"),
        _named("assertion_outside_window", evidence, (F.col("assertion_char_start") < F.col("char_start")) | (F.col("assertion_char_end") > F.col("char_end")), "evidence_id"), _named("invalid_observed_management", summary, ~F.col("observed_management").isin("surgery", "intended_surgery", "conservative", "unknown"), who),
        _named("invalid_actual_surgery", summary, ~F.col("actual_aaoca_surgery").isin("yes", "no", "unknown"), who), _named("management_actual_mismatch", summary, (F.col("observed_management") == "surgery") != (F.col("actual_aaoca_surgery") == "yes"), who),
        _named("event_date_shape", events, ~shape, "surgery_event_id"), _named("historical_event_flag", events, F.col("historical_only") != (~F.col("formal_surgery_record_present") & ~F.col("postoperative_evidence_present")), "surgery_event_id"),
        ("event_not_derivable", orphans(events, rest, "surgery_event_id", "surgery_event_id", F.col("surgery_event_id"))), ("derived_event_missing", orphans(rest, events, "surgery_event_id", "surgery_event_id", F.col("surgery_event_id"))),
        *(_named(f"summary_{c}_mismatch", both, ~F.col(c).eqNullSafe(F.col(f"_{c}")), who) for c in derived),
    ]
    return _report(checks).unionByName(span_errors(evidence, sections))


def followup_errors(sources: DataFrame, sections: DataFrame, evidence: DataFrame, classified: DataFrame) -> DataFrame:
    """(code, artifact_id) of a follow-up package: references, spans, enumerations, axes that contradict each other, and paths that
    do not follow from the evidence."""
    from sparkfolio.operators import followup

    who = "patient_id"
    again = cut(followup.classify(sources, evidence)).select(who, *(F.col(c).alias(f"_{c}") for c in ("decision_path", "surgery_indication", "complex_heart_disease_status", "n_followup_evidence_rows")))
    both = classified.join(again, who, "left")
    cited = classified.select(who, F.explode(F.concat("supporting_evidence_ids", "conflicting_evidence_ids")).alias("evidence_id"))
    excluded = F.col("followup_management") == "excluded_complex_heart_disease"
    checks = [
        ("followup_patient_set_mismatch", orphans(sources, classified, who, who, F.col(who))), ("followup_patient_not_in_source", orphans(classified, sources, who, who, F.col(who))), ("duplicate_followup_patient", repeated(classified, who)),
        ("duplicate_evidence_id", repeated(evidence, "evidence_id")), ("evidence_section_not_found", orphans(evidence, sections, "section_id", "section_id", F.col("evidence_id"))), ("cited_evidence_not_found", orphans(cited, evidence, "evidence_id", "evidence_id", F.col(who))),
        _named("invalid_surgery_indication", classified, ~F.col("surgery_indication").isin("yes", "no", "unclear"), who), _named("invalid_complex_status", classified, ~F.col("complex_heart_disease_status").isin("confirmed", "suspected", "none"), who),
        _named("invalid_condition_status", evidence, (F.col("domain") == "complex_condition") & ~F.col("condition_status").isin("confirmed", "suspected", "mention", "ruled_out"), "evidence_id"),
        _named("exclusion_without_confirmed_condition", classified, excluded != (F.col("complex_heart_disease_status") == "confirmed"), who),
        _named("completed_outcome_without_surgery", classified, (F.col("observed_aaoca_treatment_outcome") == "aaoca_surgery_completed") & (F.col("followup_management") != "surgery"), who),
        _named("review_flag_mismatch", classified, F.col("review_required") != (F.size("review_reasons") > 0), who),
        *(_named(f"followup_{c}_mismatch", both, ~F.col(c).eqNullSafe(F.col(f"_{c}")), who) for c in ("decision_path", "surgery_indication", "complex_heart_disease_status", "n_followup_evidence_rows")),
    ]
    return _report(checks).unionByName(span_errors(evidence, sections))

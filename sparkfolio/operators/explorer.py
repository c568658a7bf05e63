"""Read-only queries over a snapshot: overview, listings, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_LIMIT = 250


def overview(rows: DataFrame, kind: str, subject: str, dated: Column) -> DataFrame:
    """(kind, n, n_subjects, n_dated), the largest first."""
    return rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(subject).alias("n_subjects"), F.count_if(dated).alias("n_dated")).orderBy(F.desc("n"), kind)


SORTS = {
    "latest_desc": lambda: [F.desc("latest_date"), F.desc("patient_id")], "latest_asc": lambda: [F.when(F.col("latest_date") == "", "9999").otherwise(F.col("latest_date")), F.asc("patient_id")],
    "sections_desc": lambda: [F.desc("n_sections"), F.desc("patient_id")], "sections_asc": lambda: [F.asc("n_sections"), F.asc("patient_id")], "patient_asc": lambda: [F.asc("patient_id")],
}


def listing(rows: DataFrame, search: dict[str, str] | None, equal: dict, order: list[Column], offset: int, limit: int) -> DataFrame:
    """A page of rows: substring search without case, equality filters (None: no filter), order, offset and limit within bounds."""
    out = rows
    for c, needle in (search or {}).items():
        out = out.where(F.lower(F.col(c)).contains(needle.lower()))
    for c, v in equal.items():
        if v is not None:
            out = out.where(F.col(c).eqNullSafe(F.lit(v)))
    return out.orderBy(*order).offset(max(0, offset)).limit(min(PAGE_LIMIT, max(1, limit)))


def search(rows: DataFrame, key: str, text: str, needle: str, offset: int, limit: int) -> DataFrame:
    """(key, place, n_hits) of the texts that contain a needle, a page of them in order of key."""
    low = F.lower(F.col(text))
    place = F.locate(needle.lower(), low) - 1
    hits = ((F.length(low) - F.length(F.replace(low, F.lit(needle.lower()), F.lit("")))) / len(needle)).cast("long")
    return rows.where(low.contains(needle.lower())).select(key, place.cast("long").alias("place"), hits.alias("n_hits")).orderBy(key).offset(offset).limit(limit)


def _dated(prefer: str = "section_date") -> Column:
    return F.coalesce(*(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)) for c in (prefer, "document_timestamp", "document_date")), F.lit(""))


def patient_rows(manifest: DataFrame, documents: DataFrame, sections: DataFrame, timeline: DataFrame, management: DataFrame | None = None) -> DataFrame:
    """One row a subject: documents, sections by type and text source, undated sections, dates to review, and its management."""
    docs = documents.groupBy("patient_id").agg(F.count_if(F.coalesce("duplicate_of", F.lit("")) == "").alias("n_documents"), F.count(F.lit(1)).alias("n_source_documents"))
    undated, review = F.count_if(_dated() == "").alias("undated_sections"), F.count_if(F.coalesce("date_requires_review", F.lit(False))).alias("date_review_sections")
    parts = sections.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_sections"), undated, review)
    kinds = [sections.groupBy("patient_id", F.coalesce(c, F.lit("unknown")).alias("k")).agg(F.count(F.lit(1)).alias("n")).groupBy("patient_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias(a)) for c, a in (("section_type", "section_types"), ("text_source", "text_sources"))]
    events = timeline.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_timeline_events"))
    out = manifest.select("patient_id", "parse_status", F.coalesce("earliest_document_date", F.lit("")).alias("earliest_date"), F.coalesce("latest_document_date", F.lit("")).alias("latest_date"))
    for part in (docs, parts, *kinds, events):
        out = out.join(part, "patient_id", "left")
    out = out.fillna(0)
    if management is not None:
        cols = ["observed_management", "overall_treatment_status", "actual_aaoca_surgery", "other_cardiac_procedure_status", "complex_case_review_priority", "management_confidence", "review_required"]
        out = out.join(management.select("patient_id", *cols), "patient_id", "left")
    return out


def list_patients(rows: DataFrame, query: str = "", section_type: str = "", equal: dict[str, str] | None = None, review_required: str = "", sort: str = "latest_desc", offset: int = 0, limit: int = 50) -> tuple[int, DataFrame]:
    """(number of all that fit, a page of them): search, a section type that occurs, equal values, a review flag that is true,
    false or unknown, in one of five orders; bounds are clamped, an unknown order is the latest first."""
    out = rows
    if query.strip():
        out = out.where(F.lower("patient_id").contains(query.strip().lower()))
    if section_type:
        out = out.where(F.coalesce(F.try_element_at("section_types", F.lit(section_type)), F.lit(0)) > 0)
    for c, v in (equal or {}).items():
        out = out.where(F.col(c) == v) if v else out
    if review_required in ("true", "false"):
        out = out.where(F.col("review_required").eqNullSafe(F.lit(review_required == "true")))
    return out.count(), out.orderBy(*SORTS.get(sort, SORTS["latest_desc"])()).offset(max(0, offset)).limit(min(PAGE_LIMIT, max(1, limit)))


def derived_timeline(sections: DataFrame) -> DataFrame:
    """A timeline from sections alone, for runs without one: any dated section that is not nonclinical, uncertain ones too."""
    rows = sections.withColumn("date", _dated()).where((F.col("date") != "") & (F.coalesce("section_type", F.lit("")) != "nonclinical"))
    kept = [c for c in ("patient_id", "date", "date_precision", "document_id", "section_id", "date_source", "date_evidence", "text_source", "parse_status", "date_requires_review") if c in rows.columns]
    return rows.select(*kept, F.col("section_type").alias("event_type"), F.col("section_subtype").alias("event_subtype"), F.col("page_start").alias("page")).orderBy("patient_id", "date", "section_id")


#: The columns of a section that every run has; others are extra.
SECTION_COLUMNS = ["section_id", "document_id", "patient_id", "source_pdf", "section_type", "section_subtype", "section_title", "section_date", "document_date", "document_timestamp", "date_source", "date_precision", "date_evidence", "date_page",
                   "date_line", "date_uncertain", "page_start", "page_end", "line_start", "line_end", "page_spans", "text", "mentioned_dates", "flags", "parse_status", "clinical_stage", "leakage_flags", "leakage_risk", "segmentation_rule", "text_source",
                   "date_requires_review", "date_evidence_confidence", "available_at", "cutoff_review_required"]


def section_public(sections: DataFrame) -> DataFrame:
    """Sections without their bodies, with date, title and the columns that this version does not know, as a map of texts."""
    extra = [c for c in sections.columns if c not in SECTION_COLUMNS]
    entries = F.array_compact(F.array(*(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v"))) for c in extra))) if extra else F.array().cast("array<struct<k:string,v:string>>")
    title = F.coalesce(F.when(F.coalesce("section_title", F.lit("")) != "", F.col("section_title")), F.col("section_type"))
    kept = [c for c in sections.columns if c in SECTION_COLUMNS and c not in ("text", "mentioned_dates", "page_spans")]
    return sections.select(*kept, _dated().alias("date"), title.alias("title"), F.map_from_entries(entries).alias("extra_fields"))


class Snapshot:
    """The tables of one run for the explorer: manifest, documents, sections, timeline (derived if absent), and management,
    events and evidence where there are any. Lookups are filters that reach the scan; single records come to the driver."""

    def __init__(self, tables: dict[str, DataFrame]):
        if missing := {"manifest", "documents", "sections"} - tables.keys():
            raise ValueError(f"the run lacks {', '.join(sorted(missing))}")
        self.tables = tables
        self.timeline = tables["timeline"] if "timeline" in tables else derived_timeline(tables["sections"])
        self.rows = patient_rows(tables["manifest"], tables["documents"], tables["sections"], self.timeline, tables.get("management"))

    def bootstrap(self) -> dict:
        """Totals, the values that filters may take, and what the run can do."""
        t = self.tables
        values = {c: [r[0] for r in t["sections"].select(c).distinct().orderBy(c).collect() if r[0]] for c in ("section_type", "text_source", "parse_status") if c in t["sections"].columns}
        kinds = overview(t["sections"], "section_type", "patient_id", _dated() != "").collect()
        totals = {"patients": t["manifest"].count(), "documents": t["documents"].count(), "sections": t["sections"].count(), "timeline_events": self.timeline.count()}
        return {"totals": totals, "values": values, "section_types": [r.asDict() for r in kinds], "capabilities": {k: k in t for k in ("timeline", "management", "events", "evidence")}}

    def patient_detail(self, patient_id: str) -> dict:
        """All about one subject, sections by date (undated last), page and id; KeyError for an unknown one."""
        own = F.col("patient_id") == patient_id
        head = self.tables["manifest"].where(own).first()
        if head is None:
            raise KeyError(patient_id)
        public = section_public(self.tables["sections"].where(own))
        sections = public.orderBy(F.when(F.col("date") == "", "9999").otherwise(F.col("date")), "page_start", "section_id").collect()
        events = self.timeline.where(own).select("section_id", F.col("date").alias("event_date"), "event_type")
        merged = events.join(public.drop("patient_id"), "section_id", "left").withColumn("date", F.coalesce("event_date", "date")).orderBy("date", "section_id").collect()
        more = {k: [r.asDict(True) for r in self.tables[k].where(own).collect()] for k in ("management", "events", "evidence") if k in self.tables}
        return {"manifest": head.asDict(True), "documents": [r.asDict(True) for r in self.tables["documents"].where(own).collect()], "sections": [r.asDict(True) for r in sections], "timeline": [r.asDict(True) for r in merged], **more}

    def section_detail(self, section_id: str) -> dict:
        """One section with its body; KeyError for an unknown one."""
        rows = self.tables["sections"].where(F.col("section_id") == section_id)
        body = rows.select("text", *(c for c in ("mentioned_dates", "page_spans") if c in rows.columns)).first()
        if body is None:
            raise KeyError(section_id)
        return section_public(rows).first().asDict(True) | body.asDict(True)


class Registry:
    """The runs below a folder; one is open. A reload that fails keeps the last good one."""

    def __init__(self, discover, load):
        self.discover, self.load, self.current, self.snapshot = discover, load, None, None

    def select(self, path: str) -> Snapshot:
        fresh = self.load(path)
        self.current, self.snapshot = path, fresh
        return fresh

    def reload(self) -> bool:
        """Opens the latest run if it is another; whether it did."""
        runs = self.discover()
        if not runs or runs[0]["path"] == self.current:
            return False
        try:
            self.select(runs[0]["path"])
        except (ValueError, OSError):
            return False
        return True


def matching_sidecar(candidates: list[dict], hashes: dict[str, str]) -> dict | None:
    """The newest package whose source hashes are all those of the run."""
    fit = [c for c in candidates if all(c.get(k) == v for k, v in hashes.items())]
    return max(fit, key=lambda c: (c.get("finished_at", ""), c.get("path", "")), default=None)

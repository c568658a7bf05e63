"""Files to subjects: evidence from names and headers, intersected; conflicts are quarantined and reported.

References of all kinds become rows (document, kind, field, value) and meet the cohort in one equi-join; what a document's
kinds of evidence agree on is a count by candidate, not a product of sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.functions.text import MISSING, PLACEHOLDERS, nfkc, normalize_identifier, strip

# --- fixed values: routes and labels that carry identifiers ---
URL_IDS = (
    "/(?:BasicInfo|Allergy|VisitHistory|DignosisHistory|SurgeryHistory|Medication|MedicationRecord|NonMedication|Expense|LabTest|Rad|EMR|"
    "EMROutDoc|Nursing|PathologyDetail|RopAppointMent|TreatmentFor|TreatmentRecord)/(\\d{4,16})/(\\d{4,16})(?=[/\\s\\)])"
)
LABELS = {
    "inpatient_id": "(?:住院号|住院编号|病案号)[ \\t]*[:：]?[ \\t]*([A-Za-z0-9]{4,24})(?![A-Za-z0-9./-])",
    "outpatient_id": "(?:门诊号|门诊编号)[ \\t]*[:：]?[ \\t]*([A-Za-z0-9]{4,24})(?![A-Za-z0-9./-])",
}
NUMBER = "(?<![A-Za-z0-9])\\d{4,16}(?![A-Za-z0-9])"
# --- end of fixed values ---
HEAD = 20_000
FIELDS = ("inpatient_id", "outpatient_id")
_ISSUE = "struct<issue_type:string,severity:string,field:string,patient_id:string>"


def cohort_ids(cohort: DataFrame, inpatient: str = "inpatient_id", outpatient: str = "outpatient_id", name: str = "name") -> DataFrame:
    """cohort with normalised identifiers, patient_id and cohort_issue_types. The id comes from the inpatient number if it is
    unique, else the outpatient number if unique, else from all three; later bearers of one get _duplicate_2 and so on, in
    the order of csv_row."""
    source = {"inpatient_id": F.col(inpatient), "outpatient_id": F.col(outpatient)}
    given = {f"_given_{k}": strip(nfkc(F.coalesce(v.cast("string"), F.lit("")))) != "" for k, v in source.items()}
    c = cohort.withColumns(given | {k: normalize_identifier(v) for k, v in source.items()} | {"name": strip(nfkc(F.coalesce(F.col(name), F.lit(""))))})
    for k in (*FIELDS, "name"):
        c = c.withColumn(f"_n_{k}", F.when(F.col(k) != "", F.count(F.lit(1)).over(Window.partitionBy(k))).otherwise(0))
    basis = F.when(F.col("_n_inpatient_id") == 1, F.concat(F.lit("inpatient:"), "inpatient_id")).when(F.col("_n_outpatient_id") == 1, F.concat(F.lit("outpatient:"), "outpatient_id"))
    basis = basis.otherwise(F.concat(F.lit("identity:"), F.concat_ws("|", "inpatient_id", "outpatient_id", "name")))
    c = c.withColumn("_id", F.concat(F.lit("p_"), F.substring(F.sha2(basis, 256), 1, 16)))
    c = c.withColumn("_k", F.row_number().over(Window.partitionBy("_id").orderBy("csv_row")))
    issues = [F.when(F.col(f"_given_{k}") & (F.col(k) == ""), "placeholder_identifier") for k in FIELDS]
    issues += [F.when(F.col(f"_n_{k}") > 1, "identifier_conflict") for k in FIELDS] + [F.when(F.col("_n_name") > 1, "duplicate_cohort_name")]
    none = (F.col("inpatient_id") == "") & (F.col("outpatient_id") == "")
    issues += [F.when(none, "missing_identifiers"), F.when(F.col("_k") > 1, "duplicate_cohort_row")]
    named = F.when(F.col("_k") == 1, F.col("_id")).otherwise(F.concat("_id", F.lit("_duplicate_"), F.col("_k").cast("string")))
    out = c.withColumns({"patient_id": named, "cohort_issue_types": F.array_compact(F.array(*issues)), **{f"has_{k}": F.col(k) != "" for k in FIELDS}})
    return out.drop("_id", "_k", *given, *(f"_n_{k}" for k in (*FIELDS, "name")))


def cohort_issues(cohort: DataFrame) -> DataFrame:
    """(issue_type, severity, patient_id, csv_row) of cohort_ids()."""
    each = cohort.select("patient_id", "csv_row", F.explode("cohort_issue_types").alias("issue_type"))
    return each.select("issue_type", F.when(F.col("issue_type") == "duplicate_cohort_row", "error").otherwise("warning").alias("severity"), "patient_id", "csv_row")


def _known(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda v: ~F.lower(v).isin(MISSING) & ~v.isin(PLACEHOLDERS)))


def references(files: DataFrame, path: str = "source_pdf", header: str = "header_text") -> DataFrame:
    """files with name_token, numbers, url and labelled identifiers, and header identifiers: a URL's come before labels."""
    stem = strip(nfkc(F.regexp_replace(F.regexp_extract(path, "([^/\\\\]*)$", 1), "\\.[^.]*$", "")))
    head = F.coalesce(F.col(header), F.lit(""))
    url = {f: _known(F.regexp_extract_all(head, F.lit(URL_IDS), F.lit(g))) for f, g in (("outpatient_id", 1), ("inpatient_id", 2))}
    label = {f: _known(F.regexp_extract_all(F.substring(head, 1, HEAD), F.lit(p), F.lit(1))) for f, p in LABELS.items()}
    out = files.withColumns({"name_token": strip(F.regexp_extract(stem, "^[^-－—_]*", 0)), "numbers": F.array_distinct(F.regexp_extract_all(stem, F.lit(NUMBER), F.lit(0)))})
    out = out.withColumns({f"url_{f}": c for f, c in url.items()} | {f"labelled_{f}": c for f, c in label.items()})
    return out.withColumns({f"header_{f}": F.when(F.size(f"url_{f}") > 0, F.col(f"url_{f}")).otherwise(F.col(f"labelled_{f}")) for f in FIELDS})


def candidates(found: DataFrame, cohort: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, kind, patient_id): whom each kind of evidence names."""

    def rows(kind: str, field: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), F.lit(field).alias("field"), v.alias("value")))

    parts = [rows("name", "name", F.array("name_token")), *(rows("number", f, F.col("numbers")) for f in FIELDS)]
    parts += [rows(f"{how}_{f}", f, F.col(f"{how}_{f}")) for how in ("header", "labelled") for f in FIELDS]
    refs = found.select(key, F.explode(F.array_distinct(F.concat(*parts))).alias("r")).select(key, "r.*").where("value <> ''")
    fields = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in (*FIELDS, "name"))))
    ids = cohort.select("patient_id", fields.alias("i")).select("patient_id", "i.*").where("value <> ''")
    return refs.join(ids, ["field", "value"]).select(key, "kind", "patient_id").distinct()


def resolve(files: DataFrame, cohort: DataFrame, key: str = "document_id") -> DataFrame:
    """files with patient_id ('' where none is sure), candidate_patient_ids, match_status, match_method, identifier_conflict,
    header_crosschecked and match_issues. One candidate that all kinds of evidence share is a match; none in common, several
    header identifiers of one field, or another inpatient number than the subject's own is a conflict."""
    found = references(files)
    per = candidates(found, cohort, key).groupBy(key, "patient_id").agg(F.collect_set("kind").alias("kinds"))
    joint = per.groupBy(key).agg(F.collect_list(F.struct("patient_id", "kinds")).alias("_c"))
    n_kinds = F.size(F.array_distinct(F.flatten(F.transform("_c", lambda c: c.kinds))))
    common = F.transform(F.filter("_c", lambda c: F.size(c.kinds) == F.col("_n")), lambda c: c.patient_id)
    rows = found.join(joint, key, "left").withColumn("_n", F.when(F.col("_c").isNull(), 0).otherwise(n_kinds))
    empty = F.array().cast("array<string>")
    rows = rows.withColumns({"_common": F.coalesce(common, empty), "candidate_patient_ids": F.coalesce(F.array_sort(F.transform("_c", lambda c: c.patient_id)), empty)})
    several = (F.size("header_inpatient_id") > 1) | (F.size("header_outpatient_id") > 1)
    clash = (F.col("_n") > 0) & (F.size("_common") == 0)
    rows = rows.withColumns({"_several": several, "_hard": clash | several})
    rows = rows.withColumn("_picked", F.when((F.size("_common") == 1) & ~F.col("_hard"), F.get("_common", F.lit(0))))
    own = cohort.select(F.col("patient_id").alias("_picked"), *(F.col(f).alias(f"_own_{f}") for f in FIELDS))
    rows = rows.join(own, "_picked", "left")

    def differs(f: str) -> Column:
        return F.coalesce((F.size(f"header_{f}") > 0) & (F.col(f"_own_{f}") != "") & ~F.array_contains(f"header_{f}", F.coalesce(f"_own_{f}", F.lit(""))), F.lit(False))

    rows = rows.withColumns({f"_differs_{f}": differs(f) for f in FIELDS})
    rows = rows.withColumn("_conflict", F.col("_hard") | F.col("_differs_inpatient_id"))
    rows = rows.withColumn("patient_id", F.when(F.col("_conflict") | F.col("_picked").isNull(), "").otherwise(F.col("_picked")))
    status = F.when(F.col("_conflict"), "ambiguous").when(F.col("patient_id") != "", "matched").when(F.size("_common") > 1, "ambiguous").otherwise("unmatched")
    kinds = F.coalesce(F.filter("_c", lambda c: c.patient_id == F.col("patient_id"))[0].kinds, empty)
    rows = rows.withColumns({"match_status": status, "_kinds": F.when(F.col("patient_id") != "", kinds).otherwise(empty)})
    methods = [("name", "filename_exact_name"), ("number", "filename_exact_identifier"), ("header_inpatient_id", "header_inpatient_id"), ("header_outpatient_id", "header_outpatient_id")]
    method = F.concat_ws("+", F.array_compact(F.array(*(F.when(F.array_contains("_kinds", k), m) for k, m in methods))))
    mismatch = {f: (F.size(f"url_{f}") > 0) & (F.size(F.array_except(f"labelled_{f}", f"url_{f}")) > 0) for f in FIELDS}
    every, picked = F.concat_ws("|", "candidate_patient_ids"), F.coalesce("_picked", F.lit(""))
    crossed = (F.size("header_inpatient_id") > 0) | (F.size("header_outpatient_id") > 0)

    def issue(hit: Column, kind: str, severity: str, who: Column, field: str = "") -> Column:
        return F.when(hit, F.struct(F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), F.lit(field).alias("field"), who.alias("patient_id")).cast(_ISSUE))

    header_hit = F.exists(F.coalesce("_c", F.array().cast("array<struct<patient_id:string,kinds:array<string>>>")), lambda c: F.arrays_overlap(c.kinds, F.array(F.lit("header_inpatient_id"), F.lit("header_outpatient_id"))))
    issues = [
        issue(F.col("_several"), "multiple_header_identifiers", "error", every),
        *(issue(mismatch[f], "document_identifier_mismatch", "warning", picked, f) for f in FIELDS),
        issue(F.col("_differs_inpatient_id"), "header_identifier_mismatch", "error", picked, "inpatient_id"),
        issue(F.col("_differs_outpatient_id") & ~F.col("_differs_inpatient_id"), "header_identifier_mismatch", "warning", picked, "outpatient_id"),
        issue(F.col("_conflict"), "file_multiple_patients", "error", every),
        issue(~F.col("_conflict") & (F.size("_common") > 1), "file_multiple_patients", "error", F.concat_ws("|", F.array_sort("_common"))),
        issue(status == "unmatched", "unmatched_file", "warning", F.lit("")),
        issue((F.col("patient_id") != "") & (F.col("name_token") != "") & ~F.array_contains("_kinds", "name") & header_hit, "filename_name_mismatch", "warning", F.col("patient_id")),
    ]
    conflict = mismatch["inpatient_id"] | mismatch["outpatient_id"] | F.col("_conflict") | F.col("_differs_outpatient_id")
    rows = rows.withColumns({
        "match_method": F.when(method == "", "none").otherwise(method), "identifier_conflict": conflict, "header_crosschecked": crossed, "match_issues": F.array_compact(F.array(*issues)),
    })
    return rows.drop(*(c for c in rows.columns if c.startswith("_")))


def issues(matched: DataFrame, key: str = "document_id") -> DataFrame:
    """(issue_type, severity, key, field, patient_id) of resolve()."""
    each = matched.select(key, F.explode("match_issues").alias("i"))
    return each.select("i.issue_type", "i.severity", key, "i.field", "i.patient_id")


def content_groups(matched: DataFrame, content: str = "content_key", order: tuple[str, ...] = ("root_order", "source_pdf")) -> DataFrame:
    """matched with duplicate_of; contents that several subjects claim lose their subject (ambiguous_duplicate_identity).
    The canonical row has a subject if any has one, then comes first in the order; found by aggregates, so that a content
    that many files share is no single task. A null content is a content of its own file."""
    rows = matched.withColumn(content, F.coalesce(content, F.concat(F.lit("unreadable_"), "document_id")))
    rank = F.struct((F.col("patient_id") == "").alias("o"), *(F.col(c).alias(f"o_{c}") for c in order), "document_id")
    owner = F.when(F.col("patient_id") != "", F.col("patient_id"))
    lead = rows.groupBy(content).agg(F.min(rank).alias("_first"), F.min(owner).alias("_low"), F.max(owner).alias("_high"))
    rows = rows.join(lead, content)
    clash = F.coalesce(F.col("_low") != F.col("_high"), F.lit(False))
    return rows.withColumns({
        "duplicate_of": F.when(F.col("document_id") == F.col("_first.document_id"), "").otherwise(F.col("_first.document_id")),
        "patient_id": F.when(clash, "").otherwise(F.col("patient_id")), "match_status": F.when(clash, "ambiguous_duplicate_identity").otherwise(F.col("match_status")),
    }).drop("_first", "_low", "_high")

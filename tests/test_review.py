"""Gold scores, casework, explorer, sources and validators on small inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F
from tests.test_rules import SECTION, _section

from sparkfolio.operators import casework, evidence, explorer, gold, identity, management, quality, segment, timeline, validate
from sparkfolio.sources import extract, readers, sinks


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distance_and_boundaries():
    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choice("AB中") for _ in range(r.randint(0, 9))) for _ in "ab")
        assert gold.distance(a, b) == _levenshtein(a, b)
    assert gold.boundaries({3, 7}, [4, 8, 20], 1) == (2, 1, 0) and gold.boundaries({3, 7}, [4, 8], 0) == (0, 2, 2)
    assert gold.paired_sections([{1, 2, 3}, {4, 5}], [{1, 2}, {3, 4, 5}]) == [(0, 0, 2 / 3), (1, 1, 2 / 3)]
    assert gold.align(["手术记录", "正文甲", "正文乙"], ["手术记录", "正文乙"]) == {1: 1, 2: 3}


def _annotation(**more):
    known = lambda v: {"status": "known", "value": v}
    first = {"start_line": 1, "end_line": 2, "type": known("procedure"), "subtype": known("surgery_record"), "date": known("2024-01-02") | {"role": "document", "other_dates": [{"value": "2024-01-09", "role": "print"}]}}
    second = {"start_line": 3, "end_line": 4, "type": known("progress"), "subtype": known("round"), "date": {"status": "absent"}}
    text = "2024-01-02 手术记录\n正文12.5甲\n查房\n正文乙"
    return {"unit_id": "u", "source_sha256": "s", "page": 1, "sample_id": "x", "status": "complete", "reviewer": "r", "text": {"status": "ok", "gold_text": text}, "sections": [first, second]} | more


def test_scores(spark):
    a = _annotation()
    found = [{"start_line": 1, "end_line": 2, "section_type": "procedure", "section_subtype": "x", "section_date": "2024-01-09", "date_source": "title_timestamp"}, {"start_line": 3, "end_line": 4, "section_type": "progress", "section_subtype": "round", "section_date": ""}]
    one = [{**found[0], "end_line": 4, "section_date": "2024-01-02", "date_source": "test_timestamp_column"}]
    rows = [("u1", "native_record", json.dumps(a), a["text"]["gold_text"], json.dumps(found)), ("u2", "ocr_lab", json.dumps(a), a["text"]["gold_text"].replace("12.5", "12"), json.dumps(one)), ("u3", "ocr_lab", json.dumps(_annotation(text={"status": "uncertain", "gold_text": ""})), "", "[]")]
    scored = gold.score_units(spark.createDataFrame(rows, "unit_id string, stratum string, annotation string, page_text string, found string")).cache()
    value = {(r.stratum, r.metric): r.value for r in gold.evaluation(scored).collect()}
    assert value["native_record", "text_cer"] == 0 and value["native_record", "boundary_tolerant_f1"] == 1 and value["ocr_lab", "section_match_recall"] == 0.5 and value["all", "type_accuracy"] == 1
    assert value["native_record", "date_value_accuracy_known"] == 0 and value["ocr_lab", "numeric_token_recall"] < 1 and value["ocr_lab", "date_role_accuracy"] == 0
    assert {r["mode"] for r in gold.failure_counts(scored).collect()} == {"transcription_difference", "missed_boundary", "missed_section", "wrong_subtype", "date_confused_with_print", "wrong_date_role"}


def test_annotations_and_sample(spark):
    unit = {"unit_id": "u", "source_sha256": "s", "page": 1}
    assert gold.annotation_errors(_annotation(), unit, "x") == []
    assert gold.annotation_errors(_annotation(page=2, reviewer=""), unit, "y") == ["source mismatch", "sample_id mismatch", "no reviewer"]
    broken = _annotation()
    broken["sections"][1]["end_line"] = 3
    assert gold.annotation_errors(broken, unit, "x") == ["each line with text must be in one section"]
    r = random.Random(2)
    pages = [{"unit_id": f"pg{k}", "stratum": s, "tags": r.sample(list(gold.WEIGHTS), r.randint(0, 3)), "patient_id": f"p{k // 2}", "source_sha256": f"f{k}"} for s in gold.STRATA for k in range(20 * gold.STRATA.index(s), 20 * gold.STRATA.index(s) + 20)]
    chosen = gold.draw(pages, 6)
    assert chosen == gold.draw(list(reversed(pages)), 6) and len(chosen) == 24 and sum(c["sampling_arm"] == "routine" for c in chosen) == 12
    with pytest.raises(ValueError):
        gold.draw(pages, 21)
    manifest = gold.sample_manifest(chosen, {"run_id": "r"}, 6, 1)
    assert "patient_id" not in manifest["units"][0]
    with pytest.raises(ValueError):
        gold.freeze(manifest, {})
    done = {u["unit_id"]: {"status": "complete"} for u in manifest["units"]}
    assert gold.freeze(manifest, done)["revision"] == gold.freeze(manifest, done)["revision"]
    sections = spark.createDataFrame([("d", 1, 3, "progress", "", False, ["conflicting_document_dates"], []), ("d", 3, 3, "procedure", "2024-01-02", False, [], ["outcome_information_possible"]), ("d", 3, 4, "procedure", "2024-01-02", False, [], [])],
                                     "document_id string, page_start int, page_end int, section_type string, section_date string, date_uncertain boolean, flags array<string>, leakage_flags array<string>")
    facts = spark.createDataFrame([("d", 2, 0, 0, []), ("d", 3, 2000, 1, ["off_page_text"])], "document_id string, page int, normalized_character_count int, ocr_low_confidence_line_count int, flags array<string>")
    tags = {r.page: r.tags for r in gold.candidate_tags(facts, sections).collect()}
    assert tags[2] == ["cross_page", "date_conflict_or_review", "date_unknown_or_uncertain", "empty_text", "type:progress"] and "multiple_starts" in tags[3] and "off_page_text" in tags[3] and "low_ocr_confidence" in tags[3]


@pytest.fixture(scope="module")
def charts(spark):
    rows = [
        _section("p1", "a_s0001", "手术记录。手术时间：2022-03-01。诊断AAOCA。手术名称：冠脉异常起源纠治术 手术医生：测试。", "procedure", "surgery_record", "2022-03-01"),
        _section("p2", "b_s0001", "术中探查右冠状动脉，予松解。" + "无关内容。" * 300 + "既往未接受过手术。", "procedure", "round", "2023-01-01"), _section("p3", "c_s0001", "门诊记录，一般情况可。", "outpatient"),
        _section("p4", "d_s0001", "诊断AAOCA，原计划外科手术治疗，家属拒绝手术，暂予出院。", "discharge", day="2023-05-05"),
    ]
    sections = spark.createDataFrame(rows, SECTION)
    found = validate.cut(management.evidence(sections))
    events = validate.cut(management.events(found))
    selection = sections.select("patient_id").distinct()
    return sections, found, events, selection, validate.cut(management.summary(selection, found, events))


def test_routing_and_requests(spark, charts):
    sections, found, _, _, summary = charts
    routed = {r.patient_id: (r.route, r.reasons) for r in casework.route(summary, found, sections).collect()}
    assert routed["p1"][0] == "rules_sufficient" and routed["p3"] == ("insufficient_documentation", []) and routed["p2"][0] == "needs_llm" and "coronary_action_without_resolved_target" in routed["p2"][1]
    passages = validate.cut(casework.passages(sections, found, 400))
    both = passages.join(sections.select("section_id", F.col("text").alias("t")), "section_id")
    assert both.where("substring(t, section_char_start + 1, section_char_end - section_char_start) <> text").count() == 0
    assert passages.groupBy("section_id").agg(F.sum(F.length("text")).alias("n")).where("n > 400").count() == 0 and passages.where("patient_id = 'p3'").count() == 1
    asked = validate.cut(casework.requests(summary, found, passages))
    assert casework.request_errors(asked).count() == 0 and casework.request_errors(asked.withColumn("payload", F.concat("payload", F.lit(" ")))).count() == 4
    assert casework.selected(summary, "unknown").count() == 2 and casework.selected(summary, "all").count() == 4
    windows = casework.case_windows(sections, found, 200)
    assert windows.groupBy("patient_id").agg(F.sum(F.length("text")).alias("n")).where("n > 200").count() == 0
    answers = casework.answered(asked, lambda p: json.dumps({"patient_id": json.loads(p)["patient_id"]}) if "p3" not in p else None)
    assert answers.where("response is null").count() == 1

    ids = {r.patient_id: r.request_id for r in asked.collect()}
    ev = {r.patient_id: r.evidence_id for r in found.collect()}
    quote = passages.where("patient_id = 'p4'").first()
    good = (ids["p4"], "p4", "intended_surgery", "unknown", "medium", "r", False, [ev["p4"]], [(quote.passage_id, 0, 4, quote.text[:4])], [("cancelled_or_declined", "related", "2023-05", "month", [ev["p4"]])])
    bad = (ids["p3"], "p3", "surgery", "no", "sure", " ", False, ["nothing"], [("none", 0, 4, "abcd")], [("completed", "related", "2023-13", "month", [])])
    rows = spark.createDataFrame([good, bad, ("odd", *bad[1:])], casework._ANSWER)
    errors = casework.response_errors(rows, asked, found, passages, summary, complete=True).collect()
    assert {r.code for r in errors if r.artifact_id == ids["p4"]} == set() and ("response_request_not_found", "odd") in {(r.code, r.artifact_id) for r in errors}
    wanted = {"response_confidence_invalid", "response_rationale_invalid", "response_evidence_id_not_allowed", "citation_quote_mismatch", "response_event_date_invalid", "response_management_actual_mismatch",
              "response_actual_no_without_conservative_state", "new_surgery_claim_requires_human_review", "llm_disagreement_requires_human_review"}
    assert wanted <= {r.code for r in errors if r.artifact_id == ids["p3"]} and sum(r.code == "response_missing" for r in errors) == 2
    h = {r.patient_id: (r.agreement, r.observed_management) for r in casework.hybrid(summary, rows.where("request_id <> 'odd'")).collect()}
    assert h["p4"] == ("agree", "intended_surgery") and h["p3"] == ("disagree", "unknown") and h["p1"][0] == "no_response"


def test_case_tools(charts):
    rows = [r.asDict() for r in charts[0].collect()]
    tools = casework.CaseTools.of("p2", rows, [])
    assert tools.get_section("a_s0001") == {"error": "section_not_in_current_patient"} and tools.get_section("b_s0001", -1) == {"error": "invalid_offset"}
    hits = tools.invoke("search_sections", {"query": "未接受过"})
    assert hits["total_matches"] == 1 and tools.invoke("search_sections", {"query": "(", "mode": "regex"}) == {"error": "invalid_regex"} and tools.invoke("x", {}) == {"error": "unknown_tool"} and tools.invoke("get_section", {"y": 1}) == {"error": "invalid_tool_arguments"}
    assert tools.search_sections("无关", "keyword") == {"error": "too_many_matches_refine_query", "scanned_all_sections": False}
    answer = {"observed_management": "conservative", "actual_aaoca_surgery": "no", "overall_treatment_status": "conservative", "aaoca_handling": "unclear", "rationale": "r", "citations": [{"section_id": "b_s0001", "quote": "既往 未接受过 手术"}], "uncertainties": []}
    errors, citations = casework.assessment_errors(answer, tools)
    assert errors == [] and citations[0]["match_method"] == "whitespace_only" and citations[0]["quote"] == "既往未接受过手术"
    assert casework.assessment_errors({**answer, "citations": [{"section_id": "b_s0001", "quote": "术中探查"}]}, tools)[0] == ["citation_not_exact_or_not_seen", "actual_no_requires_direct_negative_surgical_history"]
    assert casework.assessment_errors({**answer, "observed_management": "surgery", "citations": []}, tools)[0] == ["management_actual_overall_inconsistent", "factual_conclusion_without_citation", "actual_no_requires_direct_negative_surgical_history"]
    assert casework.final_object('x {"a": 1} then ```json\n{"b": {"c": 2}}\n```') == {"b": {"c": 2}}
    with pytest.raises(ValueError):
        casework.final_object('{"a": {"b": 1}, "c"')


def test_management_errors(charts):
    sections, found, events, selection, summary = charts
    clean = validate.management_errors(selection, sections, found, events, summary)
    assert clean.collect() == []
    moved = found.withColumn("char_start", F.when(F.col("patient_id") == "p4", F.col("char_start") + 1).otherwise(F.col("char_start")))
    assert {r.code for r in validate.span_errors(moved, sections).collect()} == {"evidence_span_text_mismatch"}
    worse = summary.withColumn("observed_management", F.when(F.col("patient_id") == "p4", "conservative").otherwise(F.col("observed_management")))
    assert {r.code for r in validate.management_errors(selection, sections, found, events, worse).collect()} == {"summary_observed_management_mismatch"}


@pytest.fixture(scope="module")
def run(spark):
    pages = spark.createDataFrame([("d1", 1, "导航\n2024-01-02 08:30 日常病程\n甲", "ok", "p1"), ("d1", 2, "2024-01-03 09:15 手术记录\n丙", "ok", "p1"), ("d2", 1, "门诊记录\n乙", "ok", "p2")], "document_id string, page int, text string, extraction_status string, patient_id string")
    pages = pages.withColumn("normalized_text", F.col("text")).withColumns({"char_count": F.length("text"), "flags": F.array().cast("array<string>")}).cache()
    sections = validate.cut(segment.with_page_facts(segment.sections(pages), pages))
    line = validate.cut(timeline.make(sections))
    docs = segment.documents(sections).select("document_id", "n_sections").join(pages.groupBy("document_id", "patient_id").agg(F.count(F.lit(1)).alias("page_count"), F.sum("char_count").alias("extracted_character_count")), "document_id")
    docs = docs.withColumns({"sha256": F.sha2("document_id", 256), "duplicate_of": F.lit(""), "match_status": F.lit("matched"), "parse_status": F.lit("ok"), "flags": F.array().cast("array<string>"), "ocr_recovered_page_count": F.lit(0)})
    copy = docs.where("document_id = 'd1'").withColumns({"document_id": F.lit("d3"), "duplicate_of": F.lit("d1")})
    docs = validate.cut(docs.unionByName(copy))
    cohort = spark.createDataFrame([("p1", True, False), ("p2", True, True), ("p3", False, True)], "patient_id string, has_inpatient_id boolean, has_outpatient_id boolean")
    return validate.cut(quality.patient_manifest(cohort, docs, sections, line)), docs, pages, sections, line


def test_output_errors(run):
    manifest, docs, pages, sections, line = run
    assert validate.output_errors(*run).collect() == []
    assert {r.patient_id: (r.n_pdf, r.n_source_pdf, r.parse_status) for r in manifest.collect()} == {"p1": (1, 2, "ok"), "p2": (1, 1, "ok"), "p3": (0, 0, "no_pdf_in_scope")}
    bad = sections.withColumn("text", F.when(F.col("ordinal") == 2, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    late = line.withColumn("date", F.lit("2030-01-01"))
    codes = {r.code for r in validate.output_errors(manifest, docs.withColumn("page_count", F.lit(9)), pages, bad, late).collect()}
    assert codes == {"page_count_mismatch", "section_text_not_equal_to_normalized_spans", "timeline_date_mismatch", "manifest_date_range_mismatch"}


def test_quality_tables(run):
    manifest, docs, pages, sections, line = run
    tables = {"manifest": manifest, "documents": docs, "pages": pages, "sections": sections}
    n = {k: quality.issues(k, tables).count() for k in quality.ISSUES}
    assert n["patients_without_pdf"] == 1 and n["unmatched_files"] == 0 and n["empty_or_tiny_text"] == 3 and n["uncertain_documents"] == 2 and n["parse_failures"] == 0
    value = {r.metric: r.value for r in quality.cohort_summary(manifest, docs, sections, pages, line, docs.select(F.lit("unmatched_file").alias("issue_type")).limit(1)).collect()}
    assert value["exact_duplicate_copies"] == 1 and value["sections"] == 4 and value["section_types.progress"] == 1 and value["timeline_events"] == 2 and value["matching_issue_types.unmatched_file"] == 1
    q = lambda t, **k: quality.page_quality(F.lit(t), **{a: F.lit(b) for a, b in k.items()})
    got = sections.limit(1).select(q("1 " * 60, glyphs=800, paints=9).alias("a"), q("血常规 " + "1.2 " * 60, paints=9).alias("b"), q("", paints=0).alias("c"), q(" ", paints=30).alias("d"), q("中文" * 30 + "�" * 5).alias("e")).first()
    assert [x.status for x in got] == ["text_layer_unusable", "ok", "empty", "text_layer_unusable", "partial"] and got.c.flags == ["empty_text", "blank_page"]


def test_explorer(run):
    manifest, docs, pages, sections, line = run
    s = explorer.Snapshot({"manifest": manifest, "documents": docs, "sections": sections.withColumn("strange", F.lit("x"))})
    total, page = explorer.list_patients(s.rows, section_type="progress", sort="sections_desc", limit=999)
    assert total == 1 and page.first().patient_id == "p1" and explorer.list_patients(s.rows, query="P", sort="nonsense")[0] == 3
    d = s.patient_detail("p1")
    assert [x["date"] for x in d["sections"]] == ["2024-01-02", "2024-01-03", ""] and len(d["documents"]) == 2 and d["sections"][0]["extra_fields"]["strange"] == "x" and len(d["timeline"]) == 2
    assert s.section_detail("d1_s0002")["text"].endswith("甲") and s.bootstrap()["totals"]["sections"] == 4 and not s.bootstrap()["capabilities"]["timeline"]
    for lookup in (s.patient_detail, s.section_detail):
        with pytest.raises(KeyError):
            lookup("nobody")

    def load(path):
        if path == "broken":
            raise ValueError
        return path

    found = [{"path": "one"}]
    r = explorer.Registry(lambda: found, load)
    assert r.reload() and not r.reload()
    found.insert(0, {"path": "broken"})
    assert not r.reload() and r.current == "one"
    assert explorer.matching_sidecar([{"a": "1", "finished_at": "1"}, {"a": "1", "finished_at": "2"}, {"a": "2", "finished_at": "3"}], {"a": "1"})["finished_at"] == "2"


def test_reviews(spark):
    cases = spark.createDataFrame([("a", "not_reviewed", "", ""), ("b", "not_reviewed", "", "")], "patient_id string, review_status string, final_aaoca_judgment string, reviewer_notes string")
    rows = lambda *r: spark.createDataFrame(list(r), cases.schema)
    done = validate.import_reviews(cases, rows(("b", "reviewed", "no", "n"), ("a", "in_review", "", "")))
    assert {r.patient_id: r.final_aaoca_judgment for r in done.collect()} == {"a": "", "b": "no"}
    for wrong in (rows(("a", "reviewed", "no", "")), rows(("a", "in_review", "no", ""), ("b", "reviewed", "", ""))):
        with pytest.raises(ValueError):
            validate.import_reviews(cases, wrong)
    assert {r.code for r in validate.relevance_errors(done, cases.select("patient_id"), complete=True).collect()} == {"review_incomplete"}


def test_packages_that_fail(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "cast(id as string) AS artifact_id", "'bad' AS code")
    with pytest.raises(ValueError):
        sinks.write_package(str(tmp_path / "run"), {"t": df}, {}, check=lambda t: t["t"].select("code", "artifact_id"))
    assert not (tmp_path / "run").exists() and json.loads((tmp_path / "run.failed" / "run_metadata.json").read_text())["status"] == "failed"
    receipt = sinks.write_package(str(tmp_path / "run"), {"t": df}, {}, check=lambda t: t["t"].where("id > 5").select("code", "artifact_id"), verify=lambda: True)
    assert receipt["source_hash_verification"] == "passed" and receipt["hashes"]["t"] and readers.read_run(spark, str(tmp_path / "run"), ("t",))["t"].count() == 3
    assert sinks.write_package(str(tmp_path / "other"), {"t": df}, {}, verify=lambda: False)["status"] == "failed_source_integrity" and not (tmp_path / "other").exists()


def test_extraction_and_enrichment(spark, tmp_path):
    def reader(content: bytes):
        if content == b"broken":
            raise ValueError
        return [extract.Page(k, t) for k, t in enumerate(content.decode().split("|"), 1)] if content else []

    files = spark.createDataFrame([("h1", b"a|b"), ("h1", b"a|b"), ("h2", b"broken"), ("h3", b"")], "sha256 string, content binary")
    for _ in range(2):
        got = sorted((r.sha256, r.page, r.extraction_status) for r in extract.cached(spark, files, reader, str(tmp_path / "cache"), extract.fingerprint(reader)).collect())
        assert got == [("h1", 1, "ok"), ("h1", 2, "ok"), ("h2", 0, "failed"), ("h3", 0, "empty")]
    pages = spark.createDataFrame([("d", 1, "", "empty"), ("d", 2, "x", "ok"), ("d", 3, "", "failed")], "document_id string, page int, text string, extraction_status string")
    again = spark.createDataFrame([("d", 1, "found", 0.9)], "document_id string, page int, ocr_text string, ocr_mean_confidence double")
    assert {r.page: (r.analysis_text, r.ocr_status) for r in extract.recovered(pages, again).collect()} == {1: ("found", "recovered"), 2: ("x", "not_needed"), 3: ("", "pending")}

    class Words:
        def extract(self, section):
            return [extract.Candidate("first", section["text"][:2], 0, 2, 0.5)]

    assert extract.enrich(spark.createDataFrame([("s", "甲乙丙")], "section_id string, text string"), Words()).first().evidence_text == "甲乙"


def test_small_rules(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, "x")], "id int, text string")
    c = {r.id: (r.is_canonical, r.duplicate_of) for r in identity.canonical(rows, F.sha2("text", 256), "id", []).collect()}
    assert c == {1: (True, None), 2: (True, None), 3: (True, None), 4: (False, 1)} and identity.duplicate_groups(rows, F.sha2("text", 256), "id").count() == 1
    t = spark.createDataFrame([("p", "2024-01-01", False), ("p", "2024-01-02", True), ("p", "2024-01-09", False)], "patient_id string, date string, date_requires_review boolean")
    assert [r.date for r in timeline.before_cutoff(t, "date", "2024-01-05").collect()] == ["2024-01-01"]
    e = spark.createDataFrame([("a", "v", "2024-02", 1), ("a", "s", "2024-02-10", 0), ("b", "v", "2024-02-11", 1), ("b", "s", "2024-02-10", 9), ("c", "v", "2024-03", 1), ("c", "s", "2024-02", 2), ("d", "v", "2024-02-10", 5), ("d", "s", "2024-02-10", 4), ("d", "s", "2024-01", 9), ("e", "s", "2024", 1)], "u string, k string, d string, n int")
    assert {r.u: r.holds for r in evidence.after_all(e, "u", "k", "d", "n", "v", "s").collect()} == {"a": False, "b": True, "c": True, "d": True, "e": False}


def test_sources(spark, tmp_path, monkeypatch):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nnot json\n\n[1]\n')
    assert [(r.line, r.error) for r in readers.jsonl_errors(spark, str(tmp_path / "x.jsonl")).orderBy("line").collect()] == [(2, "invalid JSON"), (4, "no object")]
    (tmp_path / "c.json").write_text('{"raw_root": "$HOMEDIR/raw", "cohort_csv": "c.csv", "n": 1, "roots": ["a"]}')
    monkeypatch.setenv("HOMEDIR", "/base")
    assert readers.read_config(str(tmp_path / "c.json"), {"n": 2, "x": None}) == {"raw_root": "/base/raw", "cohort_csv": str(tmp_path / "c.csv"), "n": 2, "roots": ["a"]}
    s = spark.createDataFrame([("a", "s1"), ("a", "s1"), ("b", "s2")], "patient_id string, section_id string")
    with pytest.raises(ValueError):
        readers.sections_of(s, s.where("patient_id = 'a'").select("patient_id").distinct())
    assert readers.sections_of(s, s.where("patient_id = 'b'").select("patient_id")).count() == 1
    (tmp_path / "Ä b").mkdir()
    (tmp_path / "Ä b" / "1+.PDF").write_bytes(b"x")
    import hashlib

    got = readers.scan_documents(spark, [str(tmp_path / "Ä b")]).first()
    want = str(tmp_path / "Ä b" / "1+.PDF")
    assert (got.source_pdf, got.document_id) == (want, "doc_" + hashlib.sha256(want.casefold().encode()).hexdigest()[:20])

"""Matching, relevance and management on small synthetic charts."""

import pytest

from sparkfolio.operators import management, matching, relevance, validate

COHORT = "csv_row int, inpatient_id string, outpatient_id string, name string"
FILE = "document_id string, source_pdf string, header_text string"


@pytest.fixture(scope="module")
def cohort(spark):
    rows = [(2, "001234", "01000001", "测试甲"), (3, "005678", "01000002", "测试乙"), (4, "009999", "01000001", "测试丙"), (5, "", "-", "测试丁"), (6, "", "无", "测试丁"), (7, "77.0", "", "ａｂ")]
    return matching.cohort_ids(spark.createDataFrame(rows, COHORT)).cache()


def test_cohort_ids(cohort):
    rows = {r.csv_row: r for r in cohort.collect()}
    assert rows[6].patient_id == rows[5].patient_id + "_duplicate_2" and len({r.patient_id for r in rows.values()}) == 6
    assert rows[7].inpatient_id == "77" and rows[7].name == "ab" and "identifier_conflict" in rows[2].cohort_issue_types
    assert set(rows[6].cohort_issue_types) == {"placeholder_identifier", "duplicate_cohort_name", "missing_identifiers", "duplicate_cohort_row"}
    kinds = {(r.issue_type, r.severity) for r in matching.cohort_issues(cohort).collect()}
    assert ("duplicate_cohort_row", "error") in kinds and ("identifier_conflict", "warning") in kinds


def test_matching(spark, cohort):
    ids = {r.csv_row: r.patient_id for r in cohort.collect()}
    files = [
        ("name", "/x/测试乙-病历.pdf", ""), ("shared", "/x/测试甲-病历.pdf", "/BasicInfo/01000001/001234)"), ("conflict", "/x/测试甲-病历.pdf", "/BasicInfo/01000002/005678)"),
        ("typo", "/x/测试申-病历.pdf", "/BasicInfo/01000002/005678)"), ("body", "/x/某某.pdf", "检验结果001234 正常"), ("number", "/x/报告 005678.pdf", None), ("outpatient", "/x/某某.pdf", "门诊号: 01000001"),
        ("two", "/x/测试甲.pdf", "/BasicInfo/01000001/001234) /BasicInfo/01000001/008888)"), ("label", "/x/测试乙.pdf", "/BasicInfo/01000002/005678) 住院号:004444"),
    ]
    m = validate.cut(matching.resolve(spark.createDataFrame(files, FILE), cohort))
    got = {r.document_id: (r.match_status, r.patient_id, r.match_method) for r in m.collect()}
    assert got["name"] == ("matched", ids[3], "filename_exact_name") and got["shared"][:2] == ("matched", ids[2]) and got["typo"] == ("matched", ids[3], "header_inpatient_id+header_outpatient_id")
    assert got["conflict"][:2] == ("ambiguous", "") and got["body"][:2] == ("unmatched", "") and got["number"][:2] == ("matched", ids[3]) and got["outpatient"][:2] == ("ambiguous", "")
    assert got["two"][:2] == ("ambiguous", "") and got["label"][0] == "matched"
    kinds = {}
    for r in matching.issues(m).collect():
        kinds.setdefault(r.document_id, set()).add(r.issue_type)
    assert kinds["typo"] == {"filename_name_mismatch"} and kinds["body"] == {"unmatched_file"} and "multiple_header_identifiers" in kinds["two"] and kinds["label"] == {"document_identifier_mismatch"}


def test_contents_of_several_subjects(spark):
    rows = [("d1", "k", "p1", "matched", 0, "/a"), ("d2", "k", "p2", "matched", 1, "/b"), ("d3", "q", "", "unmatched", 0, "/c"), ("d4", "q", "p1", "matched", 1, "/d"), ("d5", None, "", "unmatched", 0, "/e"), ("d6", None, "", "unmatched", 0, "/f")]
    df = spark.createDataFrame(rows, "document_id string, content_key string, patient_id string, match_status string, root_order int, source_pdf string")
    got = {r.document_id: (r.duplicate_of, r.patient_id, r.match_status) for r in matching.content_groups(df).collect()}
    assert got == {"d1": ("", "", "ambiguous_duplicate_identity"), "d2": ("d1", "", "ambiguous_duplicate_identity"), "d3": ("d4", "", "unmatched"), "d4": ("", "p1", "matched"), "d5": ("", "", "unmatched"), "d6": ("", "", "unmatched")}


SECTION = "patient_id string, document_id string, section_id string, text string, section_type string, section_subtype string, section_date string, text_source string, date_requires_review boolean"


def _section(patient, section, text, kind="progress", subtype="", day="2024-05-02"):
    return (patient, section.split("_s")[0], section, text, kind, subtype, day, "pdf_text_layer", False)


@pytest.fixture(scope="module")
def judged(spark):
    rows = [
        _section("p_typical", "d1_s0001", "诊断：右冠状动脉异常起源于左冠窦，拟完善冠脉 CTA。"), _section("p_header", "d2_s0001", "返回查询页面 2024-01-01 冠状动脉起源异常（心胸外科）", "nonclinical"),
        _section("p_tentative", "d3_s0001", "心超提示冠脉起源异常可能，建议增强 CT 进一步明确。", "consultation"), _section("p_conflict", "d4_s0001", "首次 CTA：右冠状动脉起源于左冠窦。复查报告：右冠状动脉起源于右冠窦。"),
        _section("p_pulmonary", "d5_s0001", "鉴别诊断包括 ALCAPA，即左冠状动脉异常起源于肺动脉。"), _section("p_unrelated", "d6_s0001", "因肺炎入院。病程中无胸痛、晕厥或心脏相关诊疗。" * 80),
        _section("p_excluded", "d7_s0001", "经专科会诊及增强 CT 检查后排除冠状动脉起源异常。"), _section("p_short", "d8_s0001", "右冠起自左冠，近端壁内走行。左右冠状动脉起源正常。"), _section("p_branch", "d9_s0001", "右冠状动脉异常起源，起自左前降支。"),
    ]
    sections = spark.createDataFrame(rows, SECTION)
    manifest = spark.createDataFrame([(r[0], 1) for r in rows] + [("p_missing", 0)], "patient_id string, n_pdf long")
    found = validate.cut(relevance.signals(sections))
    return found, validate.cut(relevance.judge(manifest, sections, found))


def test_relevance(judged):
    found, verdicts = judged
    by = {r.patient_id: r for r in verdicts.collect()}
    assert {p: r.judgment for p, r in by.items()} == {
        "p_typical": "yes", "p_header": "uncertain", "p_tentative": "yes", "p_conflict": "yes", "p_pulmonary": "yes", "p_unrelated": "no", "p_excluded": "yes", "p_short": "yes", "p_branch": "yes", "p_missing": "uncertain",
    }
    assert by["p_typical"].reasons == [] and by["p_excluded"].reasons == [] and "tentative_evidence_only" in by["p_tentative"].reasons and by["p_missing"].reasons == ["missing_source_documentation"]
    assert "conflicting_coronary_origin_descriptions" in by["p_conflict"].reasons and "pulmonary_origin_scope_boundary" in by["p_pulmonary"].reasons and by["p_unrelated"].priority == "required"
    queue = [r.patient_id for r in relevance.queue(verdicts).collect()]
    assert queue[:4] == ["p_header", "p_missing", "p_unrelated", "p_branch"] and "p_typical" not in queue
    facts = {(r.patient_id, r.target, r.origin) for r in found.where("origin <> ''").collect()}
    assert ("p_short", "right_coronary", "left_sinus") in facts and ("p_branch", "right_coronary", "left_anterior_descending") in facts
    assert {r.patient_id for r in relevance.review_evidence(found, relevance.queue(verdicts)).collect()} <= set(queue)
    lines = {r.patient_id: r.relevant_evidence_summary for r in relevance.summaries(found).collect()}
    assert lines["p_pulmonary"].startswith("[formal_origin_anomaly/affirmed]")


@pytest.fixture(scope="module")
def managed(spark):
    rows = [
        _section("p_surgery", "a1_s0001", "手术记录\n手术时间：2024-05-02 08:30--11:00\n术前诊断：AAOCA\n手术名称：1.冠状动脉修补术2.肺动脉补片扩大成形术\n手术经过：术顺。", "procedure", "surgery_record"),
        _section("p_surgery", "a1_s0002", "术后首次病程录。患儿因AAOCA已行冠状动脉修补术，现术后第1天。", "progress", "postop_progress", "2024-05-03"),
        _section("p_history", "a2_s0001", "既往史：2020-01-02于外院行冠脉异常起源纠治术，术后恢复可。", "admission", day="2024-06-01"),
        _section("p_intent", "a3_s0001", "术前讨论：诊断AAOCA。拟施手术名称和方式：1.冠状动脉修补术 拟施麻醉方式：全身麻醉。", "procedure", "preoperative_discussion"),
        _section("p_diagnostic", "a4_s0001", "手术记录。术前诊断：冠状动脉起源异常。手术名称：多根导管冠状动脉造影 手术医生：测试。手术经过：造影完成。", "procedure", "surgery_record"),
        _section("p_followup", "a5_s0001", "右冠状动脉起源于左冠窦，运动试验正常。会诊意见：心内科门诊随访。", "consultation"),
        _section("p_untreated", "a6_s0001", "手术记录。手术名称：ASD补片修补 手术医生：测试。术中见右冠起源于左冠窦，术前家属已沟通，本次未予处理。", "procedure", "surgery_record"),
        _section("p_cancelled", "a7_s0001", "诊断AAOCA，原计划外科手术治疗，家属拒绝手术，暂予出院。", "discharge"),
        _section("p_multi", "a8_s0001", "手术记录。手术时间：2022-03-01。手术名称：冠脉异常起源纠治术 手术医生：测试。", "procedure", "surgery_record", "2022-03-01"),
        _section("p_multi", "a9_s0001", "手术记录。手术时间：2023-04-02。手术名称：冠状动脉开口成形术 手术医生：测试。", "procedure", "surgery_record", "2023-04-02"),
        _section("p_declined", "b1_s0001", "出院诊断：冠状动脉起源异常，左冠脉起源于右冠窦。经内外科讨论，患儿病情危重，考虑手术风险极大，经反复告知家属后，家属决定自动出院，拒绝手术。", "discharge"),
        _section("p_observe", "b2_s0001", "右冠状动脉起源于左冠窦伴心肌缺血可能需手术治疗。冠脉造影示左右冠脉未见明显受压。后进行心脏内外科讨论，讨论结束后胸外科医生与家属沟通，家属要求先出院观察，心血管内科门诊随访，定期复查。", "discharge"),
        _section("p_pending", "b3_s0001", "右冠状动脉起源于左冠窦。今日完成心导管检查，待结果回报后心脏内外科讨论进一步诊疗计划。患儿一般情况可，予出院，普通门诊随访。", "discharge"),
        _section("p_deferred", "b4_s0001", "出院诊断：冠状动脉起源异常。患儿心内外科讨论建议手术，家属表示再考虑，办理出院，心外科门诊随访。", "discharge"),
        _section("p_other_untreated", "b5_s0001", "手术记录。术中诊断：房间隔缺损、冠状动脉畸形。手术名称：ASD修补术。术中探查见冠状动脉开口未见明显异常，未处理。术顺。", "procedure", "surgery_record"),
        _section("p_other_only", "b6_s0001", "手术记录。术前诊断：VSD/PFO/单支左冠。手术名称：1.VSD修补2.PFO修补。术后食道超声无残余分流，术顺。", "procedure", "surgery_record"),
        _section("p_other_lesion", "b7_s0001", "诊断包括右冠状动脉起源于左冠窦。患儿主动脉瓣重度狭窄，心胸外科考虑急诊手术，告知风险后家长拒绝手术，自动出院。", "discharge"),
        _section("p_declined_followup", "b8_s0001", "出院诊断：右冠状动脉起源于左冠窦。经心脏内外科讨论，考虑手术风险，家属拒绝手术并要求自动出院，嘱心内科门诊随访观察。", "discharge"),
        _section("p_later", "b9_s0001", "右冠状动脉起源于左冠窦。经心脏内外科讨论后决定先门诊随访观察。", "progress"),
        _section("p_later", "b9_s0002", "右冠状动脉起源于左冠窦。心脏内外科讨论建议手术，家属表示再考虑并办理出院。", "discharge"),
    ]
    sections = spark.createDataFrame(rows, SECTION)
    found = validate.cut(management.evidence(sections))
    operations = validate.cut(management.events(found))
    selection = spark.createDataFrame(sorted({(r[0],) for r in rows} | {("p_none",)}), "patient_id string")
    return sections, found, operations, validate.cut(management.summary(selection, found, operations))


def test_management(managed):
    _, found, operations, summary = managed
    by = {r.patient_id: r for r in summary.collect()}
    assert {p: r.observed_management for p, r in by.items()} == {
        "p_surgery": "surgery", "p_history": "surgery", "p_intent": "intended_surgery", "p_diagnostic": "unknown", "p_followup": "conservative", "p_untreated": "conservative", "p_cancelled": "intended_surgery", "p_multi": "surgery",
        "p_declined": "intended_surgery", "p_observe": "conservative", "p_pending": "unknown", "p_deferred": "intended_surgery", "p_other_untreated": "conservative", "p_other_only": "unknown", "p_other_lesion": "unknown",
        "p_declined_followup": "intended_surgery", "p_later": "intended_surgery", "p_none": "unknown",
    }
    assert by["p_surgery"].n_surgery_events == 1 and by["p_history"].first_surgery_date == "2020-01-02" and by["p_multi"].n_surgery_events == 2 and by["p_untreated"].has_unrelated_surgery_evidence
    assert by["p_observe"].actual_aaoca_surgery == "unknown" and by["p_other_untreated"].actual_aaoca_surgery == "no" and by["p_other_only"].overall_treatment_status == "surgery"
    assert "unrelated_completed_operation_not_aaoca_management" in by["p_other_only"].review_reasons and by["p_other_only"].primary_evidence_id
    assert by["p_other_only"].other_procedure_modes == ["cardiac_surgery"] and by["p_other_only"].aaoca_handling_during_other_procedure == "not_documented"
    queue = {(r.patient_id, r.issue_type) for r in management.review_queue(summary).collect()}
    assert ("p_other_only", "unrelated_operation_without_aaoca_management") in queue and ("p_intent", "completion_not_proven") in queue and ("p_multi", "multiple_aaoca_surgery_events") in queue


def test_management_spans_and_events(managed):
    sections, found, operations, _ = managed
    both = found.join(sections.select("section_id", "text"), "section_id")
    assert both.where("substring(text, char_start + 1, char_end - char_start) <> evidence_text").count() == 0 and found.count() == found.select("evidence_id").distinct().count()
    e = {(r.patient_id, r.surgery_date): r for r in operations.collect()}
    assert set(e) == {("p_surgery", "2024-05-02"), ("p_history", "2020-01-02"), ("p_multi", "2022-03-01"), ("p_multi", "2023-04-02")}
    assert e["p_surgery", "2024-05-02"].relation_confidence == "high" and e["p_history", "2020-01-02"].date_status == "known" and e["p_surgery", "2024-05-02"].n_supporting_evidence >= 2


def test_procedures(spark):
    names = ["1.VSD修补2.经导管肺动脉瓣植入术3.阑尾切除术", "1.经皮冠状动脉造影2.VSD修补", "某手术", "AVSD(肺动脉瓣下型)2.PFO修补"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(management.procedure_profile(management.F.col("n")).alias("p")).collect()
    assert [r.p.modes for r in rows] == [["cardiac_catheter_intervention", "cardiac_surgery", "noncardiac_surgery"], ["cardiac_surgery"], ["unclassified_operation"], ["cardiac_surgery"]]
    types = spark.createDataFrame([("冠 状动脉开又成形术,肺动脉补片扩大",), ("冠状动脉瘤修补术",)], "t string").select(management.procedure_types(management.F.col("t")).alias("t")).collect()
    assert [r.t for r in types] == [["coronary_ostial_reconstruction", "adjunct_pulmonary_artery_plasty"], []]


def test_cohort_resolution(spark):
    manifest = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "patient_id string")
    cases = spark.createDataFrame([("a", "uncertain", "reviewed", "yes"), ("b", "uncertain", "not_reviewed", ""), ("c", "no", "reviewed", "no")], "patient_id string, automatic_aaoca_judgment string, review_status string, final_aaoca_judgment string")
    got = {r.patient_id: (r.aaoca_judgment, r.judgment_source, r.included_for_management) for r in management.cohort(manifest, cases).collect()}
    assert got == {"a": ("yes", "human_final_exception", True), "b": ("uncertain", "automatic_exception", False), "c": ("no", "human_final_exception", False), "d": ("yes", "automatic_nonexception", True)}

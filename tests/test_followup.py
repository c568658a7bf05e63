"""Follow-up paths of subjects whose management stayed open, on synthetic records."""

import pytest

from sparkfolio.operators import followup, validate

SECTION = "patient_id string, document_id string, section_id string, section_type string, section_subtype string, section_title string, section_date string, page_start int, text string"
D = "出院诊断:冠状动脉起源异常\n"

#: subject: ([(type, subtype, day, page, text)], what must hold)
CASES = {
    "hcm": ([("discharge", "", "2025-01-01", 1, "出院记录 出院诊断:1.梗阻性肥厚型心肌病 2.冠状动脉起源异常。")], {"complex_heart_disease_status": "confirmed", "decision_path": "combined_other_complex_heart_disease"}),
    "lqts": ([("admission", "", "2025-01-01", 1, "入院诊断:晕厥待查,窦性静止,长QT综合征待查,冠状动脉起源异常。")], {"complex_heart_disease_status": "suspected", "study_disposition": "needs_review_possible_complex_heart_disease"}),
    "severe_as": ([("discharge", "", "2025-01-01", 1, "出院诊断:1.危重型主动脉瓣狭窄 2.冠状动脉起源异常。")], {"complex_heart_disease_status": "confirmed"}),
    "ruled_out": ([("progress", "initial_progress", "2025-01-01", 1, "鉴别诊断:DORV/PS。根据影像学检查可排除诊断DORV/PS。"), ("administrative", "treatment_procedure_consent", "2025-01-01", 2, "手术同意书 通用风险包括右心室流出道狭窄、残余分流等。")], {"complex_heart_disease_status": "none"}),
    "no_coa": ([("progress", "postop_progress", "2025-01-01", 1, "术后病程记录：升主动脉造影提示左弓，无主动脉缩窄及动脉导管未闭。")], {"complex_heart_disease_status": "none"}),
    "observe": ([("progress", "round", "2025-01-01", 1, "冠状动脉起源异常，拟进一步评估后考虑手术治疗。"), ("discharge", "", "2025-01-05", 8, "科内讨论后认为冠状动脉起源异常目前暂无手术指征，继续随访观察。")], {"surgery_indication": "no", "decision_path": "clinician_no_indication_conservative", "observed_aaoca_treatment_outcome": "conservative_followup"}),
    "cath": ([("procedure", "preoperative_discussion", "2025-01-01", 1, "患儿存在冠状动脉起源异常，具备心导管检查术及冠状动脉造影手术指征。")], {"surgery_indication": "unclear"}),
    "declined": ([("discharge", "", "2025-01-01", 1, "经心外科讨论，冠状动脉起源异常建议手术治疗。家属明确拒绝手术，要求出院。")], {"surgery_indication": "yes", "decision_path": "surgery_indicated_not_done_family_declined", "followup_management": "intended_surgery_not_completed"}),
    "deferred": ([("discharge", "", "2025-01-01", 1, D + "科内专家讨论后建议手术治疗，家长要求寒假手术，告知风险后出院。")], {"surgery_indication": "yes", "decision_path": "surgery_indicated_not_done_family_deferred", "observed_aaoca_treatment_outcome": "no_aaoca_surgery_documented"}),
    "competing": ([("discharge", "", "2025-01-01", 1, "出院诊断:1.房间隔缺损 2.冠状动脉起源异常\n科内讨论建议手术治疗，家长要求寒假手术。")], {"surgery_indication": "unclear"}),
    "pending": ([("progress", "round", "2025-01-01", 1, "冠状动脉起源异常，建议门诊随访。"), ("discharge", "", "2025-01-05", 1, D + "待科内病例讨论后再制定治疗方案。")], {"decision_path": "continued_evaluation_or_pending", "observed_aaoca_treatment_outcome": "unknown"}),
    "same_day": ([("discharge", "", "2025-01-01", 1, D + "待内外科病例讨论后再制定治疗方案。\n3.出院随访心内科，若有不适及时就诊。")], {"decision_path": "continued_evaluation_or_pending"}),
    "ama": ([("discharge", "", "2025-01-01", 1, D + "患儿生命体征平稳，家长要求自动出院，予签字离院。\n3.出院随访心内科。")], {"decision_path": "left_against_medical_advice_outcome_unclear"}),
    "test_planned": ([("discharge", "", "2025-01-01", 1, D + "3.出院随访心内科，出院1周后完善运动平板试验，结果回报后复诊。")], {"decision_path": "continued_evaluation_or_pending"}),
    "endocrine": ([("discharge", "", "2025-01-01", 1, "出院诊断:1.冠状动脉起源异常 2.生长发育迟缓\n3.出院随访内分泌遗传代谢科，出院后1周复诊。")], {"decision_path": "unclear"}),
    "imaging": ([("discharge", "", "2025-01-01", 1, D + "心脏MRI提示左室心肌稍疏松，心内结构结合ECHO，建议随访。")], {"decision_path": "unclear"}),
    "no_ischemia": ([("discharge", "", "2025-01-01", 1, D + "目前评估无明显冠脉缺血证据，患儿一般情况可，予出院，\n嘱后续门诊随访。")], {"decision_path": "clinician_conservative_other", "observed_aaoca_treatment_outcome": "conservative_followup"}),
    "longitudinal": ([("discharge", "", "2022-01-01", 1, D + "家长要求自动出院，予签字离院。"), ("outpatient", "outpatient_record", "2025-01-01", 1, "现病史:[患儿冠脉起源异常，无胸痛，平素活动耐量正常，无晕厥。]")], {"decision_path": "clinician_conservative_other"}),
    "neuro": ([("discharge", "", "2025-01-01", 1, D + "请神经内科会诊，脑电图未见异常，暂无需处理，继续观察。")], {"surgery_indication": "unclear"}),
    "assess": ([("discharge", "", "2025-01-01", 1, D + "科内讨论后建议完善心脏MRI检查后评估手术指征。")], {"surgery_indication": "unclear", "decision_path": "continued_evaluation_or_pending"}),
    "other_op": ([("progress", "first_round", "2025-01-01", 1, "诊断:1.肺动脉瓣狭窄2.右冠状动脉开口于左冠窦。已行肺动脉瓣球囊扩张。患儿右冠状动脉开口于左冠窦，建议随访，注意是否有缺血表现。")], {"decision_path": "clinician_conservative_other"}),
    "referral": ([("discharge", "", "2025-01-01", 1, "出院诊断:1.冠状动脉起源异常2.室间隔缺损修补术后\n出院随访：心胸外科；出院后就诊于心胸外科。")], {"decision_path": "referred_no_outcome"}),
    "surveillance": ([("discharge", "", "2025-01-01", 1, D + "出院后定期复查心电图、心脏彩超、运动平板试验（每6-12月复查）。")], {"decision_path": "clinician_conservative_other"}),
    "diagnostic_plan": ([("procedure", "preoperative_discussion", "2025-01-01", 1, "术前诊断:冠状动脉起源异常。拟定手术方式:多根导管冠状动脉造影。手术适应症:评估冠状动脉起源、结构及血运。")], {"surgery_indication": "unclear", "decision_path": "unclear"}),
    "unhandled": ([("administrative", "treatment_procedure_consent", "2025-01-01", 1, "术前诊断:冠状动脉起源异常。拟定手术方式:冠状动脉开口扩大术或冠状动脉移植术。"), ("admission", "", "2025-06-01", 1, "既往疾病史:冠状动脉起源异常未处理。")], {"surgery_indication": "yes", "decision_path": "surgery_indicated_not_done_other"}),
    "opening": ([("progress", "first_round", "2025-01-01", 1, "患儿右冠状动脉开口于左冠状窦，建议随访，注意是否有缺血表现。")], {"decision_path": "clinician_conservative_other"}),
    "plan": ([("admission", "", "2025-01-01", 1, "冠状动脉起源异常，计划完善检查后拟行手术治疗。")], {"observed_aaoca_treatment_outcome": "unknown"}),
    "spaced": ([("discharge", "", "2025-01-01", 1, "出院诊断:冠状动脉起源异常，经讨论暂无手 术指 征。")], {"surgery_indication": "no"}),
    "other_done": ([], {"decision_path": "other_cardiac_procedure_aaoca_handling_unresolved"}),
    "tests_only": ([], {"decision_path": "diagnostic_workup_terminal_decision_unresolved"}),
    "operated": ([], {"followup_management": "surgery"}),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(p, f"doc_{p}", f"doc_{p}_s{i:04d}", kind, sub, sub or kind, day, page, text) for p, (sections, _) in CASES.items() for i, (kind, sub, day, page, text) in enumerate(sections, 1)]
    sections = spark.createDataFrame(rows, SECTION)
    return sections, validate.cut(followup.evidence(sections))


def test_paths(spark, found):
    procedure = {"other_done": "completed_other_cardiac_procedure", "tests_only": "diagnostic_only_documented"}
    sources = spark.createDataFrame([(p, "yes" if p == "operated" else "unknown", procedure.get(p, ""), "") for p in CASES], "patient_id string, actual_aaoca_surgery string, other_cardiac_procedure_status string, complex_case_review_priority string")
    out = validate.cut(followup.classify(sources, found[1]))
    rows = {r.patient_id: r for r in out.collect()}
    wrong = {(p, k): (rows[p][k], v) for p, (_, wanted) in CASES.items() for k, v in wanted.items() if rows[p][k] != v}
    assert wrong == {}
    assert "earlier_and_later_management_evidence_conflict" in rows["observe"].review_reasons and rows["observe"].latest_decision_date == "2025-01-05" and rows["observe"].conflicting_evidence_ids
    assert rows["hcm"].complex_condition_codes == ["hypertrophic_cardiomyopathy"] and rows["hcm"].primary_evidence_id in rows["hcm"].supporting_evidence_ids
    queue = {(r.patient_id, r.issue_type): r.severity for r in followup.review_queue(out).collect()}
    assert queue["endocrine", "terminal_management_decision_not_found"] == "high" and queue["pending", "terminal_management_decision_not_documented"] == "medium"


def test_spans(found):
    sections, rows = found
    both = rows.join(sections.select("section_id", "text"), "section_id")
    assert both.where("substring(text, char_start + 1, char_end - char_start) <> evidence_text or evidence_text <> trim(evidence_text)").count() == 0
    linked = rows.where("patient_id = 'deferred' and array_contains(flags, 'aaoca_linked_by_structured_section_diagnosis')")
    assert linked.count() > 0


def test_override():
    more = followup.merge_rules(followup.CONDITIONS, {"complex_conditions": [{"code": "long_qt_syndrome", "temporary_exclusion": False}, {"code": "new", "patterns": ["x+"]}]})
    by = {c.code: c for c in more}
    assert not by["long_qt_syndrome"].temporary_exclusion and by["long_qt_syndrome"].patterns and by["new"].patterns == ("x+",) and len(more) == len(followup.CONDITIONS) + 1
    for bad in ([{"code": "a", "patterns": ["x"]}] * 2, [{"code": "b"}]):
        with pytest.raises(ValueError):
            followup.merge_rules(followup.CONDITIONS, {"complex_conditions": bad})

"""Why a subject's management stayed open: other complex conditions, decisions in later records, and a path for each subject.

Patterns run on the text without white space, as scanned lines break anywhere; an array of the kept characters' places leads
back. Vocabulary is data (Conditions and PHRASES) and may be overridden by merge_rules()."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.dates import places
from sparkfolio.functions.ids import stable_id
from sparkfolio.functions.text import let
from sparkfolio.operators.review import reasons
from sparkfolio.operators.rules import window


@dataclass(frozen=True)
class Condition:
    code: str
    label: str
    patterns: tuple[str, ...]
    temporary_exclusion: bool = True


# --- fixed values: conditions, phrases, section priorities and context patterns ---
CONDITIONS = [
    Condition("hypertrophic_cardiomyopathy", "肥厚型心肌病", ("肥厚(?:型|性)心肌病", "梗阻性肥厚型心肌病", "\\bHOCM\\b", "\\bHCM\\b")),
    Condition("long_qt_syndrome", "长 QT 综合征", ("长\\s*Q[-－—]?T\\s*综合征", "长\\s*QT\\s*综合征", "\\bLQTS\\b")),
    Condition("double_outlet_right_ventricle", "右室双出口", ("右(?:心)?室双出[口又囗]", "\\bDORV\\b")),
    Condition("right_ventricular_outflow_obstruction", "右室流出道狭窄或双腔右室", ("右(?:心)?室流出道(?:狭窄|梗阻)", "右室双腔", "双腔右室", "\\bDCRV\\b")),
    Condition("dilated_cardiomyopathy", "扩张型心肌病", ("扩张(?:型|性)心肌病", "\\bDCM\\b")),
    Condition("arrhythmogenic_right_ventricular_cardiomyopathy", "致心律失常性右室心肌病", ("致心律失常性?右(?:心)?室心肌病", "\\bARVC\\b", "\\bARVD\\b")),
    Condition("restrictive_cardiomyopathy", "限制型心肌病", ("限制型心肌病", "\\bRCM\\b")),
    Condition("great_artery_transposition", "大动脉转位或纠正性大动脉转位", ("大动脉(?:转位|错位)", "纠正性大动脉转位", "\\bD-?TGA\\b", "\\bCCTGA\\b")),
    Condition("tetralogy_of_fallot", "法洛四联症", ("法洛四联症", "\\bTOF\\b")),
    Condition("total_anomalous_pulmonary_venous_connection", "完全性肺静脉异位引流", ("完全性肺静脉异位引流", "\\bTAPVC\\b", "\\bTAPVR\\b")),
    Condition("single_ventricle_physiology", "单心室生理或腔肺连接术后", ("单心室", "Fontan", "Glenn", "格林手术", "全腔肺连接")),
    Condition("pulmonary_atresia", "肺动脉闭锁", ("肺动脉闭锁", "\\bPA/IVS\\b")),
    Condition("truncus_arteriosus", "永存动脉干", ("永存动脉干", "共同动脉干", "\\btruncus\\b")),
    Condition("hypoplastic_left_heart_syndrome", "左心发育不良综合征", ("左心发育不良综合征", "\\bHLHS\\b")),
    Condition("severe_pulmonary_hypertension", "重度肺动脉高压或艾森曼格生理", ("重度肺动脉高压", "艾森曼格", "Eisenmenger")),
    Condition("critical_or_severe_aortic_stenosis", "危重或重度主动脉瓣狭窄", ("(?:危重|重度|极重度)(?:型|的)?主动脉瓣狭窄", "主动脉瓣(?:危重|重度|极重度)狭窄", "(?:危重|重度|极重度)\\s*AS\\b", "(?:critical|severe)\\s+(?:valvar\\s+)?aortic\\s+stenosis")),
    Condition("aortic_arch_obstruction", "主动脉缩窄或主动脉弓中断", ("主动脉(?:弓)?缩窄", "主动脉弓中断", "\\bCoA\\b", "\\bIAA\\b")),
]
PHRASES = {
    "no_surgery_indication": ["(?:暂无|无|不具备|未发现|没有)(?:明确)?(?:AAOCA|冠(?:状动)?脉[^，。；;]{0,35})?(?:外科)?手术指[征证]", "(?:暂无需|无需|不需)(?:外科)?(?:手术|干预|处理)"],
    "active_conservative": [
        "(?:建议|予以|予|继续)?保守(?:治疗|处理)", "(?:继续|建议|嘱其?|予以)?(?:定期)?(?:心内科|心外科|胸外科)?(?:门诊)?随访观察", "(?:继续|建议|嘱其?|予以)定期(?:心内科|心外科|胸外科)?(?:门诊)?随访",
        "(?:继续|建议|嘱其?|予以)(?:后续|继续)?(?:心内科|心外科|胸外科)?(?:门诊)?随访", "(?:3[.、．])?出院随访\\s*(?:心内科|心血管内科|心内一|心内二)(?:门诊)?(?:定期)?(?:复诊|随访)?",
        "(?:AAOCA|冠(?:状动)?脉[^。；;]{0,45}(?:异常起源|起源异常|起自|开[口又囗]于))[^。；;]{0,70}(?:未予(?:特殊)?处理|未处理|未干预)[^。；;]{0,70}(?:随访|复查|复诊)",
        "(?:出院后)?定期复查(?:心电图|心脏彩超|运动平板|冠(?:状动)?脉)[^。；;]{0,80}", "出院随访[^。；;]{0,35}(?:定期复查|每\\s*\\d+\\s*[-–—至]\\s*\\d+\\s*月)",
        "(?:主诉|现病史)[:：\\[]?[^。；;]{0,35}(?:AAOCA|冠(?:状动)?脉起源异常|冠脉起源异常)[^。；;]{0,120}(?:无胸痛|无晕厥|活动耐量正常|平素活动耐量正常)",
    ],
    "surgery_indication": ["(?:具备|存在|有|符合)(?:AAOCA|冠(?:状动)?脉[^，。；;]{0,35})?(?:外科)?手术指[征证]", "(?:建议|需|需要|应当|考虑)(?:尽快|择期)?[^。；;]{0,40}(?:冠(?:状动)?脉[^。；;]{0,20})?手术(?:治疗|干预)?"],
    "aaoca_therapeutic_intent": [
        "(?:拟定手术方式|拟行|计划行|建议行)[^。；;]{0,35}冠(?:状动)?脉[^。；;]{0,25}(?:开[口又囗]扩大|去顶|再植|移植|重建|松解|矫治|纠治|成形)",
        "(?:冠(?:状动)?脉[^。；;]{0,18}(?:开[口又囗]扩大|去顶|再植|移植|重建|松解|矫治|纠治|成形)术)[^。；;]{0,25}(?:拟行|计划|建议|同意)",
    ],
    "family_declined": ["(?:患儿)?(?:家属|家长)[^。；;]{0,60}(?:明确)?(?:拒绝|不同意|放弃)[^。；;]{0,25}手术", "(?:拒绝|放弃)[^。；;]{0,25}手术[^。；;]{0,40}(?:要求|办理)?出院"],
    "family_deferred": ["(?:患儿)?(?:家属|家长)[^。；;]{0,70}(?:要求|决定|希望|考虑)?(?:暂缓|暂不|延期|择期|以后|寒假|暑假)[^。；;]{0,35}手术", "手术[^。；;]{0,45}(?:延期|暂缓|暂不|寒假再做|日后再行)"],
    "other_deferred": ["(?:考虑|因)[^。；;]{0,35}(?:年龄|病情|风险|检查结果)[^。；;]{0,40}(?:暂缓|延期|暂不)[^。；;]{0,12}手术", "(?:目前|现阶段|本次)?(?:暂缓|延期|暂不)[^。；;]{0,12}手术"],
    "ama_or_requested_discharge": ["(?:患儿)?家属[^。；;]{0,45}(?:要求|坚持|决定)(?:办理)?(?:自动)?出院", "自动出院"],
    "explicit_not_performed": ["(?:本次|此次|术中)?(?:未行|未予|未能行|未实施|未处理|不予处理)[^。；;]{0,40}(?:冠(?:状动)?脉|AAOCA|手术|成形|纠治|矫治)", "(?:冠(?:状动)?脉|AAOCA)[^。；;]{0,50}(?:未行|未予|未实施|未处理|不予处理)"],
    "continued_evaluation": [
        "(?:待|需|拟)[^。；;]{0,30}(?:进一步)?(?:检查|评估|讨论|会诊|决定|制定)[^。；;]{0,25}(?:方案|计划|手术指征)?", "完善[^。；;]{0,35}(?:检查|评估)[^。；;]{0,45}(?:再|后|进一步)(?:决定|评估|讨论|制定)",
        "(?:建议|拟|需|待)[^。；;]{0,45}(?:心导管|冠(?:状动)?脉造影|心脏MRI|运动心电图|负荷试验)[^。；;]{0,20}(?:检查|评估)?", "(?:MDT|多学科)[^。；;]{0,35}(?:讨论|评估)",
        "出院[^。；;]{0,35}(?:预约|完善|行)[^。；;]{0,25}(?:心脏MRI|运动平板|冠(?:状动)?脉造影|心脏CT)[^。；;]{0,20}(?:检查|试验|评估)?",
    ],
    "conditional_surgery": ["(?:如|若|待)[^。；;]{0,35}(?:缺血|阳性|异常|证实)[^。；;]{0,35}(?:建议|考虑|再行)[^。；;]{0,25}手术"],
    "referred_without_outcome": [
        "(?:建议|转|请)[^。；;]{0,18}(?:心胸外科|胸外科|心外科)(?:门诊)?(?:就诊|随访|会诊)", "(?:心胸外科|胸外科|心外科)(?:门诊)?(?:就诊|随访)[^。；;]{0,35}(?:评估|决定|手术)?",
        "出院随访[^。；;]{0,16}(?:心胸外科|胸外科|心外科)", "出院后(?:就诊|随访)于?(?:心胸外科|胸外科|心外科)",
    ],
}
PRIORITIES = {"procedure:surgery_record": 90, "discharge:": 80, "progress:case_discussion": 75, "consultation:": 70, "progress:round": 65, "progress:first_round": 60, "procedure:preoperative_discussion": 55, "progress:initial_progress": 50,
              "admission:": 45, "administrative:condition_communication": 30, "administrative:treatment_procedure_consent": 20, "nonclinical:web_navigation": 15}
ANCHOR = (
    "(?is)AAOCA|AORCA|ALCA(?:PA)?|冠(?:状动)?脉缺血|冠(?:状动)?脉.{0,35}(?:异常起源|起源异常|异位起源|开[口又囗]异常|壁内走行)|(?:左|右)冠(?:状动脉)?起源异常|"
    "(?:左|右)冠(?:状动脉)?.{0,25}(?:起自|起源(?:于)?|发自|开[口又囗](?:于)?).{0,25}(?:冠(?:状)?窦|主动脉|肺动脉)"
)
DIAGNOSTIC = "(?i)冠(?:状动)?脉造影|升主动脉造影|左右心联合造影|心导管检查|右心导管|左心导管|血管造影|电生理检查"
THERAPEUTIC = "(?i)冠(?:状动)?脉[^。；;]{0,20}(?:去顶|开[口又囗]成形|扩大|再植|移植|重建|松解|修补|搭桥|旁路|纠治|矫治)"
COMPETING = "(?i)房间隔缺损|室间隔缺损|房室间隔缺损|动脉导管未闭|主动脉缩窄|肺动脉瓣狭窄|右室流出道|右室双腔|右室双出口|肥厚(?:型|性)心肌病|大动脉转位|法洛四联症|肺动脉闭锁|单心室|瓣膜(?:狭窄|关闭不全)|心肌病"
POSTOPERATIVE = "(?i)(?:房间隔缺损|室间隔缺损|动脉导管未闭)[^，,。；;\\n]{0,18}(?:修补|封堵|结扎)?术后"
OTHER_TARGET = (
    "(?i)(?:纵[隔膈])?(?:占位|肿物)|支气管源性囊肿|肿瘤|活检|射频消融|起搏器|除颤器|\\bICD\\b|\\bCRT\\b|神经外科|神经内科|动态心电图|心内电生理|室性心动过速|室上性心动过速|"
    "房间隔缺损|室间隔缺损|肺动脉瓣狭窄|肺静脉异位引流|动脉导管未闭|瓣膜(?:狭窄|关闭不全)"
)
OTHER_FOLLOWUP = "(?i)出院随访[^。；;\\n]{0,80}(?:呼吸|神经|内分泌|遗传|代谢|肾脏|心理|精神|血管|风湿|免疫|感染|消化|血液|肿瘤|骨科|泌尿|康复)(?:科|门诊)?"
IMAGING_FOLLOWUP = "(?i)(?:MRI|MR成像|CT|ECHO|彩超|超声|影像)[^。；;\\n]{0,100}(?:建议)?随访"
TEMPLATE = "(?i)需要描述|要写明|最好写清楚|要求填写|请输入|预判检查结果|模板"
STRUCTURED = "(?is)(?:出院|入院|目前|初步|主要|最终|会诊)诊断\\s*[:：]\\s*(.{1,260}?)(?=\\n|【|治疗结果|出院带药|诊疗经过|尊敬|$)"
DIAGNOSIS_MARK = "(?i)出院诊断|入院诊断|门急诊入院(?:诊断|臆断)|初步诊断|目前诊断|术前诊断|术后诊断|(?<!鉴别)(?<!排除)(?:明确|主要|最终)?诊断(?:为|[:：])|既往诊断为|故诊断"
DIFFERENTIAL_MARK = "(?i)鉴别诊断|可排除诊断|排除诊断"
RULED_OUT = "(?i)可排除(?:诊断)?|予以排除|排除(?:诊断)?|不支持|不考虑|未见|否认|排外"
SUSPECTED = "(?i)待查|待排|疑似|可能|考虑|不能排除|不除外|[?？]"
QUESTION = "(?i)评估有无|明确有无|判断有无|是否有|有无外科|进一步评估"
UNDECIDED = "(?i)评估(?:有无|是否|其)?手术指[征证]|明确有无手术指[征证]|有否手术指[征证]|根据[^。；;]{0,20}(?:检查|评估)结果[^。；;]{0,20}(?:再)?(?:评估|决定)手术"
# --- end of fixed values ---
SPACE = "[\\s\\x1c-\\x1f\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
STOPS = "。；;\n"
ASSERTIONS = {"aaoca_therapeutic_intent": "surgery_indication", "conditional_surgery": "continued_evaluation"}
TARGET_REQUIRED = ["no_surgery_indication", "active_conservative", "explicit_not_performed", "other_deferred", "continued_evaluation", "referred_without_outcome", "aaoca_therapeutic_intent"]


def merge_rules(conditions: list[Condition], override: dict | None) -> list[Condition]:
    """The conditions with an override {"complex_conditions": [{code, ...}]}: known codes are changed field by field, new ones
    added; a code given twice, a pattern that is none, or a new condition without patterns is an error."""
    by = {c.code: c for c in conditions}
    given = (override or {}).get("complex_conditions", [])
    codes = [g.get("code", "") for g in given]
    if len(codes) != len(set(codes)) or "" in codes:
        raise ValueError("a condition code occurs twice, or is empty")
    for g in given:
        old = by.get(g["code"])
        if old is None and not g.get("patterns"):
            raise ValueError(f"{g['code']} has no patterns")
        for p in g.get("patterns", ()):
            re.compile(p)
        by[g["code"]] = Condition(g["code"], g.get("label", old.label if old else g["code"]), tuple(g.get("patterns", old.patterns if old else ())), g.get("temporary_exclusion", old.temporary_exclusion if old else True))
    return list(by.values())


def compact_with_map(text: Column) -> Column:
    """(compact, at): the text without white space, and the place of each of its characters in the text."""
    kept = F.filter(F.transform(F.split(text, ""), lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: (x.c != "") & ~x.c.rlike(SPACE))
    return let(kept, lambda k: F.struct(F.array_join(F.transform(k, lambda x: x.c), "").alias("compact"), F.transform(k, lambda x: x.i).alias("at")))


def sentence(text: Column, start: Column, end: Column, radius: int) -> Column:
    """(a, b) of the sentence around [start, end): after the last stop within the radius (or from the text's beginning), to
    the first stop after it."""
    low = F.greatest(start - radius, F.lit(0))
    before, after = F.substring(text, low + 1, start - low), F.substring(text, end + 1, F.lit(radius))
    head, tail = F.regexp_extract(before, f"(?s)^.*[{STOPS}]", 0), F.regexp_extract(after, f"^[^{STOPS}]*[{STOPS}]", 0)
    a = F.when(F.length(head) > 0, low + F.length(head)).otherwise(0)
    b = F.when(F.length(tail) > 0, end + F.length(tail)).otherwise(F.least(F.length(text), end + radius))
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: F.when(s.b <= s.a, F.struct(low.alias("a"), F.least(F.length(text), end + radius).alias("b"))).otherwise(s))


def part(text: Column, s: Column) -> Column:
    return F.substring(text, s.a + 1, s.b - s.a)


def _found(text: Column, space: Column, pattern: str) -> Column:
    """[(a, b)] in the text of a pattern's matches in its compact form."""
    none = F.array().cast("array<struct<mention:string,start:int,end:int>>")
    hits = F.when(space.compact.rlike(pattern), places(space.compact, pattern)).otherwise(none)
    return F.transform(hits, lambda m: F.struct(F.get(space.at, m.start).alias("a"), (F.get(space.at, m.end - 1) + 1).alias("b"), m.mention.alias("mention")))


def _row(domain, assertion, code, label, status, rule, strength, target, flags, a: Column, b: Column) -> Column:
    names = ("domain", "assertion", "condition_code", "condition_label", "condition_status", "rule_id", "strength", "target_relation")
    values = [v if isinstance(v, Column) else F.lit(v) for v in (domain, assertion, code, label, status, rule, strength, target)]
    return F.struct(*(v.alias(n) for v, n in zip(values, names, strict=True)), flags.alias("flags"), a.alias("a"), b.alias("b"))


def _strings(*values: str) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def _condition_status(text: Column, kind: Column, subtype: Column, title: Column, m: Column) -> Column:
    """(status, strength, flags) of a condition named at [a, b), by what stands around it."""

    def judged(s: Column) -> Column:
        prefix = window(text, m.a, m.a, 260, 0)
        near, before, after = part(text, s), window(text, m.a, m.a, 55, 0), window(text, m.b, m.b, 0, 55)

        def last(pattern: str) -> Column:
            return F.coalesce(F.try_element_at(F.transform(places(prefix, pattern), lambda x: x.start), F.lit(-1)), F.lit(-1))

        def tail(n: int) -> Column:
            return F.concat(F.substring(prefix, F.greatest(F.length(prefix) - n, F.lit(0)) + 1, F.lit(n)), near)

        out = F.substring(before, F.greatest(F.length(before) - 18, F.lit(0)) + 1, F.lit(18)).rlike("(?i)(?:未见|未提示|无|排除|否认|不支持)\\s*$") | near.rlike(RULED_OUT)
        admitted = F.locate("【入院情况】", text)
        early = m.a < F.greatest(F.lit(800), F.when(admitted > 0, admitted - 1).otherwise(800))
        marked = F.concat(F.substring(prefix, F.greatest(F.length(prefix) - 180, F.lit(0)) + 1, F.lit(180)), F.substring(near, 1, 180)).rlike(DIAGNOSIS_MARK)
        discharge = tail(180).contains("出院诊断")
        diagnosed = marked | (kind == "discharge") & early | (kind == "nonclinical") & discharge | (kind == "procedure") & tail(140).rlike("术[前后]诊断")
        clinical = kind.isin("admission", "progress", "discharge", "consultation", "procedure", "nonclinical")

        def said(status: str, strength, *flags: str) -> Column:
            return F.struct(F.lit(status).alias("status"), (strength if isinstance(strength, Column) else F.lit(strength)).alias("strength"), _strings(*flags).alias("flags"))

        consent = title.contains("知情同意") | (subtype == "treatment_procedure_consent")
        return (
            F.when(out, said("ruled_out", "low", "negated_or_differential_context")).when(last(DIFFERENTIAL_MARK) > last(DIAGNOSIS_MARK), said("mention", "low", "differential_diagnosis_context"))
            .when(before.rlike(SUSPECTED) | after.rlike(SUSPECTED), said("suspected", "medium", "suspected_or_pending_diagnosis"))
            .when(diagnosed & clinical, said("confirmed", F.when((kind == "discharge") | discharge, "high").otherwise("medium")))
            .when(subtype.isin("initial_progress", "first_round", "case_discussion") & tail(120).rlike("诊断(?:明确|为|[:：])"), said("confirmed", "medium"))
            .when(tail(120).rlike("(?:既往|曾|外院)[^。；;]{0,30}诊断为?"), said("confirmed", "medium", "historical_diagnosis")).when(consent, said("mention", "low", "consent_or_template_context")).otherwise(said("mention", "low"))
        )

    return let(sentence(text, m.a, m.b, 260), judged)


def _sole_diagnosis(text: Column, kind: Column, subtype: Column) -> Column:
    """Whether a deciding section's diagnosis field names the finding and no competing lesion."""
    lists = F.transform(F.regexp_extract_all(text, F.lit(STRUCTURED), F.lit(1)), lambda d: F.regexp_replace(d, POSTOPERATIVE, ""))
    right = kind.isin("discharge", "consultation") | (kind == "progress") & subtype.isin("case_discussion", "round", "first_round")
    return right & F.exists(lists, lambda d: d.rlike(ANCHOR) & ~d.rlike(COMPETING))


def _target(text: Column, subtype: Column, sole: Column, near: Column, m: Column, diagnostic: bool) -> Column:
    """(target, flags): what a decision is about."""

    def said(target: str, *flags: str) -> Column:
        return F.struct(F.lit(target).alias("target"), _strings(*flags).alias("flags"))

    anchored, around = near.rlike(ANCHOR), window(text, m.a, m.b, 360, 360).rlike(ANCHOR)
    out = F.when(near.rlike(THERAPEUTIC), said("aaoca"))
    if diagnostic:
        tested = ~text.rlike(THERAPEUTIC) & (near.rlike(DIAGNOSTIC) | (subtype == "preoperative_discussion") & text.rlike(DIAGNOSTIC))
        out = out.when(tested, said("diagnostic_procedure", "diagnostic_procedure_indication_not_therapeutic_indication"))
    rival = near.rlike(COMPETING) & ~near.rlike("(?i)(?:AAOCA|冠(?:状动)?脉)[^。；;]{0,35}手术")
    return (
        out.when(anchored & rival, said("ambiguous_target", "surgical_target_may_be_competing_lesion")).when(anchored, said("aaoca"))
        .when(near.rlike(OTHER_TARGET), said("other_or_ambiguous", "decision_sentence_names_non_aaoca_target")).when(sole, said("aaoca", "aaoca_linked_by_structured_section_diagnosis"))
        .when(around, said("aaoca_nearby_only", "aaoca_anchor_not_in_same_decision_sentence")).when(near.rlike(COMPETING), said("other_or_ambiguous", "surgical_target_is_other_or_ambiguous")).otherwise(said("unlinked"))
    )


def _decision(group: str, text: Column, kind: Column, subtype: Column, sole: Column, m: Column) -> Column:
    """An array of the one row that a phrase of a group makes, or of none."""

    def judged(s: Column) -> Column:
        near = part(text, s)

        def with_target(t: Column) -> Column:
            target, flags = t.target, t.flags
            if group == "active_conservative":
                adjacent = (t.target == "aaoca_nearby_only") & window(text, m.a, m.b, 180, 180).rlike("(?i)无明显冠(?:状动)?脉缺血证据")
                target = F.when(adjacent, "aaoca").otherwise(t.target)
                flags = F.when(adjacent, F.concat(t.flags, _strings("aaoca_linked_by_adjacent_no_ischemia_assessment"))).otherwise(t.flags)
            ok, assertion, strength = ~near.rlike(TEMPLATE), F.lit(ASSERTIONS.get(group, group)), F.lit("medium")
            if group in TARGET_REQUIRED:
                ok = ok & (target == "aaoca")
            if group == "conditional_surgery":
                ok = ok & target.isin("aaoca", "aaoca_nearby_only")
            if group == "no_surgery_indication":
                linked = F.array_contains(flags, "aaoca_linked_by_structured_section_diagnosis")
                ok = ok & ~window(text, m.a, m.b, 24, 12).rlike(QUESTION) & ~(linked & ~m.mention.rlike("(?i)手术指[征证]|(?:外科)?手术"))
            if group == "surgery_indication":
                bare = (subtype == "preoperative_discussion") & ~text.rlike(THERAPEUTIC)
                ok = ok & ~near.rlike(UNDECIDED) & ~bare & target.isin("aaoca", "diagnostic_procedure", "aaoca_nearby_only", "ambiguous_target")
                assertion = F.when(target == "diagnostic_procedure", "diagnostic_procedure_indication").when(target != "aaoca", "surgery_indication_ambiguous_target").otherwise("surgery_indication")
                strength = F.when(target == "aaoca", "medium").otherwise("low")
            if group == "active_conservative":
                direct = near.rlike(ANCHOR)
                ok = ok & (kind != "admission") & ~near.rlike(OTHER_FOLLOWUP) & ~(near.rlike(IMAGING_FOLLOWUP) & ~direct)
                firm = (
                    near.rlike("(?i)无明显冠(?:状动)?脉缺血证据") | F.array_contains(flags, "aaoca_linked_by_adjacent_no_ischemia_assessment") | (kind == "outpatient") & direct & near.rlike("无胸痛|无晕厥|活动耐量正常")
                    | direct & near.rlike("(?:建议|定期|继续|嘱)[^。；;]{0,30}(?:随访|复查|复诊)") | near.rlike("定期复查(?:心电图|心脏彩超|运动平板|冠(?:状动)?脉)")
                )
                strength = F.when(firm, "high").otherwise("medium")
            if group == "continued_evaluation":
                ok = ok & ~kind.isin("admission", "administrative") & ~subtype.isin("treatment_procedure_consent", "preoperative_discussion")
            if group == "aaoca_therapeutic_intent":
                strength = F.lit("high")
            if group in ("no_surgery_indication", "family_declined", "family_deferred", "other_deferred", "explicit_not_performed"):
                strength = F.when(target.isin("aaoca", "unlinked"), "high").otherwise("medium")
            if group == "ama_or_requested_discharge":
                target = F.lit("encounter_disposition")

            def placed(c: Column) -> Column:
                row = _row("management_decision", assertion, "", "", "", f"followup_{group}", strength, target, flags, c.a, c.b)
                return F.when(ok, F.array(row)).otherwise(F.filter(F.array(row), lambda _: F.lit(False)))

            return let(sentence(text, m.a, m.b, 260), placed)

        return let(_target(text, subtype, sole, near, m, group in ("surgery_indication", "aaoca_therapeutic_intent")), with_target)

    return let(sentence(text, m.a, m.b, 320), judged)


def section_priority(kind: Column, subtype: Column) -> Column:
    exact, general = F.concat_ws(":", kind, subtype), F.concat(kind, F.lit(":"))
    return F.coalesce(*(F.when(exact == k, n) for k, n in PRIORITIES.items()), *(F.when(general == k, n) for k, n in PRIORITIES.items()), F.lit(10))


def evidence(sections: DataFrame, conditions: list[Condition] = CONDITIONS) -> DataFrame:
    """Conditions and decisions of sections (patient_id, document_id, section_id, section_type, section_subtype, section_title,
    section_date, page_start, text); what shares a sentence and a meaning is one row, of the greatest strength."""
    rows = sections.withColumn("text", F.coalesce("text", F.lit(""))).where("text <> ''")
    rows = rows.withColumns({"_s": compact_with_map(F.col("text")), "_kind": F.coalesce("section_type", F.lit("")), "_sub": F.coalesce("section_subtype", F.lit("")), "_title": F.coalesce("section_title", F.lit(""))})
    text, space, kind, sub = F.col("text"), F.col("_s"), F.col("_kind"), F.col("_sub")
    rows = rows.withColumn("_sole", _sole_diagnosis(text, kind, sub))
    parts = []

    def named(c: Condition):
        def one(m: Column) -> Column:
            def placed(x: Column) -> Column:
                st, s = x.status, x.span
                return _row("complex_condition", "complex_condition_mention", c.code, c.label, st.status, f"complex_{c.code}", st.strength, "other_complex_cardiac_disease", st.flags, s.a, s.b)

            return let(F.struct(_condition_status(text, kind, sub, F.col("_title"), m).alias("status"), sentence(text, m.a, m.b, 240).alias("span")), placed)

        return one

    def phrased(group: str):
        return lambda m: _decision(group, text, kind, sub, F.col("_sole"), m)

    for c in conditions:
        hits = F.array_distinct(F.concat(*(F.transform(_found(text, space, f"(?i){p}"), lambda m: F.struct(m.a.alias("a"), m.b.alias("b"))) for p in c.patterns)))
        parts.append(F.transform(hits, named(c)))
    for group, patterns in PHRASES.items():
        hits = F.array_distinct(F.concat(*(_found(text, space, f"(?is){p}") for p in patterns)))
        parts.append(F.flatten(F.transform(hits, phrased(group))))
    rows = rows.select(*sections.columns, "_kind", "_sub", F.explode(F.concat(*parts)).alias("_e")).select("*", "_e.*").drop("_e")
    raw = F.substring(F.col("text"), F.col("a") + 1, F.col("b") - F.col("a"))
    lead = F.length(raw) - F.length(F.regexp_replace(raw, f"^{SPACE}+", ""))
    trail = F.length(raw) - F.length(F.regexp_replace(raw, f"{SPACE}+$", ""))
    rows = rows.withColumns({"char_start": F.col("a") + lead, "char_end": F.greatest(F.col("b") - trail, F.col("a") + lead)})
    day = F.coalesce(*(F.when(F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd").isNotNull(), F.substring(c, 1, 10)) for c in ("section_date", "document_date") if c in sections.columns), F.lit(""))
    rows = rows.withColumns({
        "evidence_text": F.substring(F.col("text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start")), "evidence_date": day, "priority": section_priority(F.col("_kind"), F.col("_sub")),
        "evidence_id": stable_id("amf_", 20, "patient_id", "section_id", "domain", "assertion", "condition_code", F.col("char_start"), F.col("char_end")),
    })
    keep = ["patient_id", "document_id", "section_id", "section_type", "section_subtype", "page_start", "domain", "assertion", "condition_code", "condition_label", "condition_status", "rule_id", "strength", "target_relation",
            "evidence_date", "priority", "char_start", "char_end", "evidence_text"]
    best = F.max_by(F.struct(*keep), F.struct(_rank(F.col("strength")), F.col("rule_id"))).alias("x")
    return rows.groupBy("evidence_id").agg(best, F.array_distinct(F.flatten(F.collect_list("flags"))).alias("flags")).select("evidence_id", "x.*", "flags")


def _rank(strength: Column) -> Column:
    return F.when(strength == "high", 3).when(strength == "medium", 2).when(strength == "low", 1).otherwise(0)


def classify(sources: DataFrame, found: DataFrame) -> DataFrame:
    """The path of each subject (patient_id, actual_aaoca_surgery, other_cardiac_procedure_status, complex_case_review_priority):
    a confirmed complex condition first, then the indication's latest state, its reason, and what the last records leave open."""
    key = F.struct(F.when(F.col("evidence_date") == "", "0000-00-00").otherwise(F.col("evidence_date")).alias("day"), _rank(F.col("strength")).alias("rank"), "priority", "document_id", F.coalesce(F.col("page_start").cast("int"), F.lit(0)).alias("page"), "char_start", "evidence_id")
    fact = F.struct(key.alias("key"), "domain", "assertion", "condition_code", "condition_status", "strength", "evidence_date", "document_id", "section_type", "evidence_id")
    per = found.select("patient_id", fact.alias("e")).groupBy("patient_id").agg(F.array_sort(F.collect_list("e")).alias("e"))
    rows = sources.join(per, "patient_id", "left")
    rows = rows.withColumn("e", F.coalesce("e", F.filter(F.array(F.lit(None).cast(per.schema["e"].dataType.elementType)), lambda x: F.lit(False))))

    def of(name: str) -> Column:
        return F.filter("e", lambda x: (x.domain == "management_decision") & (x.assertion == name))

    sets = {"_no": "no_surgery_indication", "_calm": "active_conservative", "_yes": "surgery_indication", "_maybe": "surgery_indication_ambiguous_target", "_declined": "family_declined", "_deferred": "family_deferred",
            "_other": "other_deferred", "_ama": "ama_or_requested_discharge", "_not_done": "explicit_not_performed", "_pending": "continued_evaluation", "_referred": "referred_without_outcome"}
    rows = rows.withColumns({k: of(v) for k, v in sets.items()} | {
        "_sure": F.filter("e", lambda x: (x.domain == "complex_condition") & (x.condition_status == "confirmed")), "_suspect": F.filter("e", lambda x: (x.domain == "complex_condition") & (x.condition_status == "suspected")),
    })
    rows = rows.withColumn("_left", F.filter("_ama", lambda x: (x.evidence_date != "") & x.section_type.isin("progress", "discharge", "consultation")))

    def after(a: Column, b: Column) -> Column:
        dated = (a.evidence_date != "") & (b.evidence_date != "")
        place = F.struct(a.key.page, a.key.char_start) >= F.struct(b.key.page, b.key.char_start)
        return F.when(dated, a.evidence_date >= b.evidence_date).when(a.document_id == b.document_id, place).otherwise(False)

    def last(c: str) -> Column:
        return F.try_element_at(c, F.lit(-1))

    def after_any(c: str) -> Column:
        return F.filter(c, lambda x: F.exists("_yes", lambda y: after(x, y)))

    some = {k: F.size(k) > 0 for k in (*sets, "_sure", "_suspect", "_left")}
    both = some["_yes"] & some["_no"]
    no_last, yes_last = after(last("_no"), last("_yes")), after(last("_yes"), last("_no"))
    rows = rows.withColumns({
        "complex_heart_disease_status": F.when(some["_sure"], "confirmed").when(some["_suspect"], "suspected").otherwise("none"),
        "surgery_indication": F.when(both, F.when(no_last, "no").when(yes_last, "yes").otherwise("unclear")).when(some["_yes"], "yes").when(some["_no"], "no").otherwise("unclear"),
        **{f"{k}_after": after_any(k) for k in ("_declined", "_deferred", "_ama", "_not_done", "_other", "_pending", "_referred")},
    })
    complex_, indicated = F.col("complex_heart_disease_status"), F.col("surgery_indication")

    def named(name: str, c: str, order: int) -> Column:
        return F.when(F.size(c) > 0, F.struct(last(c).key.alias("key"), F.lit(-order).alias("o"), F.lit(name).alias("name"), last(c).strength.alias("strength")))

    why = F.array_sort(F.array_compact(F.array(named("surgery_indicated_not_done_family_declined", "_declined_after", 0), named("surgery_indicated_not_done_family_deferred", "_deferred_after", 1), named("surgery_indicated_not_done_ama", "_ama_after", 2),
                                               named("surgery_indicated_not_done_other", "_not_done_after", 3), named("surgery_indicated_not_done_other", "_other_after", 4))))

    def terminal(c: str, order: int, kind: str) -> Column:
        return F.transform(c, lambda x: F.struct(x.key.day.alias("day"), F.lit(order).alias("o"), x.key.alias("key"), F.lit(kind).alias("kind")))

    ends = F.array_sort(F.concat(terminal("_calm", 1, "conservative"), terminal("_referred", 2, "referred"), terminal("_pending", 3, "pending"), terminal("_left", 4, "ama")))
    rows = rows.withColumns({"_why": F.try_element_at(F.when(F.size(why) > 0, why), F.lit(-1)), "_end": F.try_element_at(F.when(F.size(ends) > 0, ends), F.lit(-1))})
    other = F.coalesce("other_cardiac_procedure_status", F.lit(""))
    surgery = F.coalesce("actual_aaoca_surgery", F.lit("")) == "yes"
    want = (indicated == "yes") & some["_yes"]
    refuse = (indicated == "no") & some["_no"]

    def state(path, outcome, management, confidence, rule, primary) -> Column:
        parts = [x if isinstance(x, Column) else F.lit(x) for x in (path, outcome, management, confidence, rule, primary)]
        return F.struct(*(p.alias(n) for p, n in zip(parts, ("path", "outcome", "management", "confidence", "rule", "primary"), strict=True)))

    open_, not_completed = "pending_or_unresolved", "intended_surgery_not_completed"
    high = F.exists("_sure", lambda x: x.strength == "high")
    end_path = {
        "conservative": ("clinician_conservative_other", "conservative_followup", "conservative", "affirmative_aaoca_followup_or_medical_management"), "pending": ("continued_evaluation_or_pending", "unknown", open_, "continued_evaluation_without_terminal_decision"),
        "ama": ("left_against_medical_advice_outcome_unclear", "unknown", open_, "actual_ama_without_aaoca_specific_terminal_decision"), "referred": ("referred_no_outcome", "unknown", open_, "referral_without_terminal_outcome"),
    }
    ended = F.coalesce(*(F.when(F.col("_end.kind") == k, state(p, o, g, "medium", r, F.col("_end.key.evidence_id"))) for k, (p, o, g, r) in end_path.items()))
    chosen = (
        F.when(complex_ == "confirmed", state("combined_other_complex_heart_disease", "unknown", "excluded_complex_heart_disease", F.when(high, "high").otherwise("medium"), "confirmed_complex_cardiac_disease_temporary_exclusion", last("_sure").evidence_id))
        .when(surgery, state("unclear", "aaoca_surgery_completed", "surgery", "high", "source_completed_aaoca_surgery", ""))
        .when(refuse, state("clinician_no_indication_conservative", "conservative_followup", "conservative", F.when(last("_no").strength == "high", "high").otherwise("medium"), "later_explicit_no_surgical_indication", last("_no").evidence_id))
        .when(want & F.col("_why").isNotNull(), state(F.col("_why.name"), "no_aaoca_surgery_documented", not_completed, F.when(F.col("_why.strength") == "high", "high").otherwise("medium"), F.col("_why.name"), F.col("_why.key.evidence_id")))
        .when(want & (F.size("_pending_after") > 0), state("continued_evaluation_or_pending", "unknown", not_completed, "medium", "surgical_indication_with_later_pending_evaluation", last("_pending_after").evidence_id))
        .when(want & (F.size("_referred_after") > 0), state("referred_no_outcome", "unknown", not_completed, "medium", "surgical_indication_with_referral_only", last("_referred_after").evidence_id))
        .when(want, state("surgery_indication_documented_outcome_unclear", "unknown", not_completed, "medium", "surgical_indication_without_documented_terminal_outcome", last("_yes").evidence_id))
        .when(some["_not_done"], state("aaoca_not_treated_indication_unclear", "no_aaoca_surgery_documented", open_, "medium", "explicit_nonperformance_without_clear_indication_axis", last("_not_done").evidence_id))
        .when(F.col("_end").isNotNull(), ended)
        .when(other == "completed_other_cardiac_procedure", state("other_cardiac_procedure_aaoca_handling_unresolved", "unknown", open_, "low", "completed_other_cardiac_procedure_without_resolved_aaoca_handling", ""))
        .when(other == "diagnostic_only_documented", state("diagnostic_workup_terminal_decision_unresolved", "unknown", open_, "low", "diagnostic_workup_without_terminal_aaoca_management_decision", ""))
        .otherwise(state("unclear", "unknown", open_, "low", "insufficient_terminal_management_evidence", ""))
    )
    rows = rows.withColumn("_c", chosen)
    rule, path = F.col("_c.rule"), F.col("_c.path")
    clash = both
    asked = reasons([
        ("source_complex_procedure_context_requires_review", F.coalesce("complex_case_review_priority", F.lit("")) == "high"), ("possible_complex_heart_disease_not_confirmed", complex_ == "suspected"),
        ("conflicting_indication_evidence_chronology_unresolved", both & (indicated == "unclear")), ("surgical_indication_target_ambiguous", some["_maybe"]),
        ("surgical_indication_present_but_terminal_outcome_not_documented", rule.isin("surgical_indication_with_later_pending_evaluation", "surgical_indication_with_referral_only", "surgical_indication_without_documented_terminal_outcome")),
        ("nonperformance_documented_but_surgical_indication_unclear", rule == "explicit_nonperformance_without_clear_indication_axis"), ("conservative_path_without_explicit_no_indication_statement", rule == "affirmative_aaoca_followup_or_medical_management"),
        ("terminal_management_decision_not_documented", rule == "continued_evaluation_without_terminal_decision"), ("left_against_medical_advice_without_aaoca_specific_outcome", rule == "actual_ama_without_aaoca_specific_terminal_decision"),
        ("post_referral_outcome_not_documented", rule == "referral_without_terminal_outcome"), ("aaoca_handling_during_other_cardiac_procedure_unresolved", rule == "completed_other_cardiac_procedure_without_resolved_aaoca_handling"),
        ("diagnostic_workup_completed_but_terminal_decision_not_documented", rule == "diagnostic_workup_without_terminal_aaoca_management_decision"), ("terminal_management_decision_not_found", rule == "insufficient_terminal_management_evidence"),
        ("temporary_exclusion_requires_clinician_confirmation", complex_ == "suspected"), ("earlier_and_later_management_evidence_conflict", clash),
        ("followup_or_later_admission_query_recommended", path.isin("unclear", "continued_evaluation_or_pending", "referred_no_outcome", "left_against_medical_advice_outcome_unclear", "other_cardiac_procedure_aaoca_handling_unresolved",
                                                                  "diagnostic_workup_terminal_decision_unresolved", "surgery_indication_documented_outcome_unclear")),
    ])
    codes = F.array_sort(F.array_distinct(F.transform(F.when(some["_sure"], F.col("_sure")).otherwise(F.col("_suspect")), lambda x: x.condition_code)))
    decided = F.array_sort(F.transform(F.filter("e", lambda x: x.domain == "management_decision"), lambda x: x.key))
    conflicting = F.when(both & (indicated == "no"), F.col("_yes")).when(both & (indicated == "yes"), F.col("_no")).when(both, F.concat("_yes", "_no")).otherwise(F.slice("_yes", 1, 0))
    supporting = F.array_distinct(F.array_compact(F.concat(F.array(F.when(F.col("_c.primary") != "", F.col("_c.primary"))), F.transform("_sure", lambda x: x.evidence_id), F.array(F.when(some["_yes"], last("_yes").evidence_id), F.when(some["_no"], last("_no").evidence_id)))))
    disposition = F.when(complex_ == "confirmed", "temporarily_excluded_complex_heart_disease").when(complex_ == "suspected", "needs_review_possible_complex_heart_disease").otherwise("retained_for_management_reclassification")
    return rows.select(
        "patient_id", "complex_heart_disease_status", codes.alias("complex_condition_codes"), disposition.alias("study_disposition"), "surgery_indication", F.col("_c.outcome").alias("observed_aaoca_treatment_outcome"), path.alias("decision_path"),
        F.col("_c.management").alias("followup_management"), F.col("_c.confidence").alias("classification_confidence"), rule.alias("classification_rule"),
        F.when(F.size(decided) > 0, F.regexp_replace(F.try_element_at(decided, F.lit(-1)).day, "^0000-00-00$", "")).otherwise("").alias("latest_decision_date"), F.coalesce("_c.primary", F.lit("")).alias("primary_evidence_id"), supporting.alias("supporting_evidence_ids"),
        F.transform(conflicting, lambda x: x.evidence_id).alias("conflicting_evidence_ids"), F.size("e").alias("n_followup_evidence_rows"), asked.alias("review_reasons"), (F.size(asked) > 0).alias("review_required"),
    )


def review_queue(classified: DataFrame) -> DataFrame:
    """(patient_id, decision_path, issue_type, severity), a row a reason."""
    each = classified.select("patient_id", "decision_path", F.explode("review_reasons").alias("issue_type"))
    pressing = ["terminal_management_decision_not_found", "conflicting_indication_evidence_chronology_unresolved", "surgical_indication_target_ambiguous"]
    return each.withColumn("severity", F.when(F.col("issue_type").isin(pressing), "high").otherwise("medium"))

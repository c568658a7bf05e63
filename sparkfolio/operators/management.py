"""What was done about the finding: assertions from operation fields, free text and decisions; events; a summary with its
chronology; context of other procedures. Decision rules are data (DECISIONS); a section's assertions are expressions on its text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.functions.dates import places
from sparkfolio.functions.ids import stable_id
from sparkfolio.functions.text import let, strip
from sparkfolio.operators.review import reasons
from sparkfolio.operators.rules import Guard, Rule, matches, window

# --- fixed values: vocabulary of operations, decisions and competing lesions ---
DAY = "(?<!\\d)(20\\d{2}|19\\d{2})\\s*[年./-]\\s*(0?[1-9]|1[0-2])\\s*[月./-]\\s*(0?[1-9]|[12]\\d|3[01])\\s*日?(?!\\d)"
MONTH = "(?<!\\d)(20\\d{2}|19\\d{2})\\s*[年./-]\\s*(0?[1-9]|1[0-2])\\s*月?(?!\\s*[./-]\\s*\\d)(?!\\d)"
ANCHOR = "(?is)AAOCA|冠(?:状动)?脉.{0,35}(?:异常起源|起源异常|异位起源|开口异常|壁内走行)|(?:左|右)冠(?:状动脉)?起源异常|(?:左|右)冠(?:状动脉)?.{0,25}(?:起自|起源(?:于)?|发自).{0,25}(?:冠窦|主动脉|肺动脉)"
DIAGNOSIS = "(?is)AAOCA|AORCA|ALCA(?:PA)?|冠状动脉起源异常|冠脉起源异常|冠状动脉异常起源|冠脉异常起源|(?:左|右)冠(?:状动脉)?起源异常|(?:左|右)冠(?:状动脉)?.{0,18}(?:起自|起源(?:于)?|发自).{0,18}(?:冠窦|主动脉)"
OTHER_LESION = (
    "(?is)房间隔缺损|室间隔缺损|房室间隔缺损|动脉导管未闭|肺静脉异位引流|主动脉缩窄|右室流出道狭窄|法洛四联症|肺动脉瓣狭窄|肥厚型心肌病|流出道梗阻|右室双出口|"
    "大动脉转位|单心室|肺动脉闭锁|二尖瓣.{0,5}(?:关闭不全|反流|狭窄)|三尖瓣.{0,5}(?:关闭不全|反流|狭窄)|主动脉瓣.{0,5}(?:关闭不全|反流|狭窄)"
)
OPERATIONS = [
    ("coronary_unroofing", "(?:冠状动脉|冠脉|左冠|右冠|RCA|LCA).{0,20}(?:去顶|unroof)"),
    ("coronary_ostial_reconstruction", "(?:冠状动脉|冠脉|左冠|右冠).{0,14}(?:开口|开又).{0,3}(?:成形|扩大|修补)"),
    ("coronary_reimplantation", "(?:冠状动脉|冠脉|左冠|右冠).{0,6}(?:再植|移植|转位)"),
    ("coronary_origin_correction", "(?:冠状动脉|冠脉).{0,12}(?:异常起源|起源异常).{0,8}(?:纠治|矫治|修复)"),
    ("coronary_origin_correction", "(?:冠状动脉|冠脉).{0,8}畸形.{0,5}(?:纠治|矫正|矫治|修复)"),
    ("coronary_anomaly_repair_unspecified", "(?:左|右)冠(?:状动脉)?开口高位手术"),
    ("coronary_bypass", "(?:冠状动脉|冠脉).{0,10}(?:搭桥|旁路)"),
    ("coronary_reconstruction", "(?:冠状动脉|冠脉|左冠|右冠).{0,10}(?:重建|松解)"),
    ("coronary_repair", "(?:冠状动脉|冠脉).{0,6}修补术"),
]
ANEURYSM = "冠状动脉瘤|冠脉瘤"
ADJUNCTS = [("adjunct_pulmonary_artery_plasty", "(?i)肺动脉.{0,10}(?:补片|扩大|成形|移位|转位)")]
DIAGNOSTIC = "冠(?:状动)?脉造影|升主动脉造影|左右心联合造影|心导管检查|右心导管|左心导管|血管造影"
THERAPEUTIC = "手术|修补|成形|置换|切除|结扎|矫治|纠治|缝合|探查|开胸|搭桥|旁路|移植|再植|转位|封堵|引流|剥脱|清创|消融|扩张|植入|支架"
FIELD = (
    "(?is)(拟施手术名称和方式|拟行手术名称和方式|拟定手术方式|手术方案|手术名称|手术方式|操作名称)\\s*[:：]?\\s*(.{1,260}?)(?=拟施麻醉|手术医生|手术医师|操作目的|家属是否|麻醉方式|"
    "手术简要经过|手术经过|巡回护士|洗手护士|病理检查|术中出血|记录医师|可能出现的意外|是否需要分次|具体讨论意见|主持人小结|$)"
)
FIELD_HEAD = "(?is)^(拟施手术名称和方式|拟行手术名称和方式|拟定手术方式|手术方案|手术名称|手术方式|操作名称)\\s*[:：]?\\s*"
SPECIFIC_OPERATION = "(?is)" + "|".join(f"(?:{p})" for _, p in OPERATIONS)
PLAN = "拟(?:行|施|于)?|计划|建议|考虑|准备|待行|欲行|手术方案|手术指征|具备手术指征"
COMPLETION = "(?is)手术记录|手术时间|手术经过|术后(?:第?\\s*\\d+|恢复|状态|诊断)|(?:已|曾|既往|于.{0,30})行|完成.{0,20}(?:手术|治疗)|接受.{0,20}手术|术顺"
CANCEL = "取消|暂缓|拒绝|放弃|未行|未能行|终止"
NOT_PERFORMED = "(?is)(?:未行|无法行|未予|不予|无需|无须|暂不).{0,16}(?:去顶|修补|纠治|矫治|成形|扩大|移植|再植|转位|处理)"
MEETING_DECLINE = "(?is)(?:患儿)?(?:经|与|由|昨日与)?(?:心脏)?(?:内外科|心外科|胸外科)[^。；;]{0,45}(?:讨论|会诊)(?:后|结束后)?[^。；;]{0,190}(?:家属[^。；;]{0,80})?(?:拒绝|放弃)[^。；;]{0,12}手术"
MEETING_OBSERVE = (
    "(?is)(?:经|与|请|昨日与|后于\\s*\\d{1,2}(?:[./-]\\d{1,2})?\\s*进行)?(?:心脏)?(?:内外科|心外科|胸外科|外科)[^。；;]{0,45}(?:讨论|会诊)(?:后|结束后)?"
    "[^。；;]{0,190}(?:出院观\\s*察|随访观\\s*察|定期(?:门诊)?随\\s*访|门诊随\\s*访|定期复\\s*查)"
)
MEETING_DEFER = "(?is)(?:心脏)?(?:内外科|心外科|胸外科)[^。；;]{0,45}讨论[^。；;]{0,35}建议[^。；;]{0,12}手术[^。；;]{0,110}(?:家属[^。；;]{0,35}(?:考虑|暂缓|不同意)|办理出院|心外科门诊随\\s*访)"
PENDING_DISCHARGE = "(?is)(?:拟|计划|建议|需|需要)[^。；;]{0,38}(?:择日|择期)?[^。；;]{0,10}手术(?:治疗|干预)?[^。；;]{0,130}(?:家属[^。；;]{0,65})?(?:要求|决定|办理)[^。；;]{0,12}出院"
NO_INTERVENTION = "(?is)(?:AAOCA|AORCA|冠(?:状动)?脉起源异常|(?:左|右)冠(?:状动脉)?起源异常)[^。；;]{0,120}(?:暂无需|无需|不需)[^。；;]{0,35}(?:外科)?干预"
UNTREATED = "(?is)(?:冠状动脉|冠脉|左冠|右冠)[^。；;]{0,100}(?:未予处理|未处理|不予处理)"
IMAGING = "(?i)(?:经食管)?超声|多普勒|心脏(?:CT|MRI)|冠脉(?:CT|CTA|造影)|血管造影|DSA"
NO_INDICATION = "(?:暂无|无|不具备)\\s*(?:后续|外科)?\\s*手\\s*术\\s*指[征证]"
DIAGNOSIS_FIELD = "(?s)(?:入院|出院)诊断\\s*[:：]\\s*(.{1,250}?)(?=入院诊断|出院诊断|【|入院情况|出院情况|病程与治疗|辅助检查|体格检查|出院带药|治疗结果|$)"
NAMES = "(?:AAOCA|AORCA|冠状动脉起源异常|冠脉起源异常|冠状动脉异常起源|冠脉异常起源)"
NOT_TREATED = "(?:未予处理|未处理|不予处理|无需(?:特殊)?处理|无须(?:特殊)?处理|暂无需(?:特殊)?处理|(?:手术)?暂不处理|不予(?:手术|干预|治疗)|无需(?:手术|干预)|暂不(?:手术)?干预)"
VESSEL = "(?:冠状动脉|冠脉|左冠|右冠|AAOCA)"
STOPPED = "(?:(?:取消|暂缓|拒绝|放弃|未行|未能行)[^。；;]{0,20}手术|暂不手术)"
SURGERY = "(?:手术治疗|外科手术|外科治疗|手术干预|手术指征)"
WATCHED = "(?:未予特殊(?:处理|治疗)|未进一步治疗|定期随访观察)"
MANIPULATION = "(?i)冠(?:状动)?脉[^。；;]{0,65}(?:Button|纽扣|按钮)[^。；;]{0,65}(?:移植|再植|吻合)|冠(?:状动)?脉[^。；;]{0,25}(?:游离|剪下|切下)[^。；;]{0,65}(?:移植|再植|吻合)"
ANATOMY = "(?i)(?:术中[见⻅]|探查)[^。；;]{0,100}(?:冠状动脉|冠脉|[左右]冠(?:瓣)?窦)[^。；;]{0,65}(?:起源|发自|开口|开又|未予处理|未处理)"
DECISION_PENDING = "(?:待|拟|计划)[^。；;\\n]{0,65}(?:心脏内外科|心内外科|内外科)[^。；;\\n]{0,20}讨论[^。；;\\n]{0,45}"
CATEGORIES = [
    ("septal_defect_repair", "(?i)(?:AVSD|VSD|ASD|PFO|房室间隔缺损|室间隔缺损|房间隔缺损|卵圆孔).{0,12}(?:修补|封堵|关闭)"),
    ("valve_procedure", "(?i)(?:TV|MV|AV|PV|三尖瓣|二尖瓣|主动脉瓣|肺动脉瓣).{0,10}(?:整形|成形|置换|扩张|修补|植入)|Ross手术"),
    ("outflow_or_pulmonary_artery_procedure", "(?:流出道|肺动脉).{0,14}(?:疏通|重建|扩大|成形|移位|转位|环缩|拆除)"),
    ("ductus_or_aortic_arch_procedure", "(?i)(?:PDA|动脉导管未闭|COA|主动脉缩窄|主动脉弓).{0,12}(?:关闭|封堵|结扎|纠治|修补|扩大)"),
    ("pulmonary_venous_repair", "(?i)(?:PAPVC|TAPVC|肺静脉异位引流).{0,10}(?:纠治|矫治|修补)"),
    ("complex_congenital_repair", "(?i)Switch|\\bASO\\b|动脉调转|大动脉转位.{0,8}(?:纠治|矫治)|Ross手术|Rastelli|Fontan|Glenn|TOF.{0,8}(?:纠治|根治)"),
    ("other_vascular_procedure", "(?i)血管环.{0,8}(?:纠治|切断)|(?:锁骨下动脉|LSA|LCC|VA|大动脉瘤).{0,20}(?:移植|吻合|修补)"),
    ("vascular_stent_procedure", "(?:血管|动脉|静脉).{0,12}支架|支架.{0,8}植入"),
    ("other_coronary_procedure", "冠(?:状动)?脉瘤.{0,8}(?:修补|切除)|冠(?:状动)?脉瘘.{0,8}(?:封堵|结扎|修补)"),
    ("electrophysiology_procedure", "射频消融|冷冻消融|起搏器.{0,8}(?:植入|更换)"),
    ("pericardial_procedure", "心包.{0,8}(?:引流|剥脱|切开|开窗|切除)"),
    ("noncardiac_procedure", "鞘状突|鞘膜|阴囊|阑尾|胸壁.{0,8}(?:切除|清创)|皮瓣|皮肤|皮下组织|软组织病损|纵[膈隔]囊肿"),
]
PLANNING_SUBTYPES = ["preoperative_discussion", "treatment_procedure_consent", "condition_communication"]
OPERATED_SUBTYPES = ["surgery_record", "postop_progress"]
DECIDING_TYPES = ["discharge", "progress", "consultation"]
COMPLEX = ["complex_congenital_repair", "other_coronary_procedure"]
SPECIFICITY = {"aaoca_intraoperative_assessment_not_treated": 5, "specific_aaoca_operation_explicitly_not_performed": 4, "aaoca_diagnosis_scoped_no_surgical_indication": 3,
               "aaoca_multidisciplinary_observation": 2, "aaoca_no_near_term_intervention": 2}
# --- end of fixed values ---


@dataclass(frozen=True)
class Decision:
    """A rule on free text and what its matches assert; `when` tests the section's type, `weaker` a part of the text whose
    match lowers the strength and flags the row."""

    rule: Rule
    assertion: str
    kind: str
    relation: str
    dated: str = "section"
    when: str = "all"
    flags: tuple[str, ...] = ()
    weaker: Guard | None = None
    instead: tuple[str, str] | None = None  # (pattern in the match, assertion)


def _around(pattern: str, before: int, after: int, wanted: bool = True) -> Guard:
    return Guard(pattern, wanted, before, after)


def _decision(rule_id: str, pattern: str, assertion: str, kind: str, strength: str, relation: str, *guards: Guard, **more) -> Decision:
    return Decision(Rule(rule_id, assertion, pattern, strength, guards), assertion, kind, relation, **more)


_RELATIVES = Guard("家属[^。；;\\n]{0,30}(?:认为|自行)", False, 140, 140)
_NO_OTHER = _around(OTHER_LESION, 260, 260, False)
DECISIONS = [
    _decision("aaoca_management_decision_pending", DECISION_PENDING, "context_only", "management_context", "medium", "probable", Guard(DIAGNOSIS, where="whole"), when="deciding"),
    _decision("aaoca_multidisciplinary_surgery_declined", MEETING_DECLINE, "cancelled_or_declined", "surgical_intent", "high", "definite", _around(DIAGNOSIS, 1200, 500), _NO_OTHER),
    _decision("aaoca_multidisciplinary_observation", MEETING_OBSERVE, "conservative", "management_decision", "medium", "definite", _around(ANCHOR, 500, 300),
              Guard("(?is)建议\\s*手术|(?:拟|计划|需|需要)[^。；;]{0,12}手术", False, where="inside"), Guard("(?is)(?:拒绝|放弃|取消)[^。；;]{0,16}手术", False, where="inside"),
              Guard("(?is)(?:会诊|胸外科)[^。；;]{0,35}或[^。；;]{0,35}随\\s*访", False, where="inside")),
    _decision("aaoca_surgery_recommended_family_deferred", MEETING_DEFER, "intended", "surgical_intent", "high", "definite", Guard(ANCHOR, where="whole"), _around(OTHER_LESION, 320, 220, False)),
    _decision("aaoca_planned_surgery_discharge_before_completion", PENDING_DISCHARGE, "intended", "surgical_intent", "high", "definite", _around(DIAGNOSIS, 700, 300), _around(OTHER_LESION, 260, 180, False),
              Guard(f"(?i){DIAGNOSTIC}", False, where="inside"), Guard("(?is)手术[^。；;]{0,8}(?:造影|检查)", False, where="inside"), _around(MEETING_DEFER, 260, 180, False),
              instead=("(?:但|暂缓|拒绝|放弃|取消|个人原因)[^。；;]{0,90}(?:出院|手术)", "cancelled_or_declined")),
    _decision("aaoca_diagnosis_scoped_no_surgical_indication", NO_INDICATION, "conservative", "management_decision", "high", "definite", Guard("是否|待明确|待排除|若|如果", False, 30, where="ahead"),
              when="sole_diagnosis", flags=("diagnosis_scoped_management_decision",)),
    _decision("aaoca_no_near_term_intervention", NO_INTERVENTION, "conservative", "management_decision", "medium", "definite"),
    _decision("aaoca_intraoperative_assessment_not_treated", UNTREATED, "conservative", "management_decision", "high", "definite", Guard(DIAGNOSIS + "|冠状动脉畸形", where="whole"), when="operated"),
    _decision("aaoca_explicit_nonoperative_plan", f"(?is){VESSEL}[^。；;\\n]{{0,80}}{NOT_TREATED}|{NOT_TREATED}[^。；;\\n]{{0,80}}{VESSEL}", "conservative", "management_decision", "high", "definite",
              _around(ANCHOR, 140, 140), _RELATIVES, dated="contextual", weaker=Guard(IMAGING, True, 180, where="ahead")),
    _decision("aaoca_historical_observation", f"(?is){VESSEL}[^。；;\\n]{{0,70}}{WATCHED}|{WATCHED}[^。；;\\n]{{0,70}}{VESSEL}", "conservative", "management_decision", "medium", "probable", _around(ANCHOR, 140, 140), _RELATIVES, dated="contextual"),
    _decision("aaoca_no_surgical_indication", "(?is)(?:冠状动脉|冠脉|AAOCA)[^。；;\\n]{0,120}(?:无|暂无|不具备)\\s*手术指征|(?:无|暂无|不具备)\\s*手术指征[^。；;\\n]{0,120}(?:冠状动脉|冠脉|AAOCA)", "conservative",
              "management_decision", "high", "definite", _around(ANCHOR, 140, 140), _RELATIVES, dated="contextual"),
    _decision("aaoca_followup_observation", "(?is)(?:冠状动脉|冠脉|右冠|左冠|AAOCA)[^。；;\\n]{0,140}(?:心内科)?(?:门诊|定期)?随访|会诊意见[^。；;\\n]{0,120}(?:心内科)?门诊随访", "conservative", "management_decision", "medium", "probable",
              Guard(ANCHOR, True, 420, where="upto"), Guard("(?:会诊|胸外科)[^。；;\\n]{0,30}或[^。；;\\n]{0,30}随访", False, 140, 140), Guard("(?i)请结合\\s*(?:CT|CTA|临床)[^。；;\\n]{0,20}建议随\\s*访", False, where="inside"),
              _RELATIVES, dated="contextual"),
    _decision("aaoca_surgery_cancelled_or_declined", f"(?is){NAMES}[^。；;]{{0,90}}{STOPPED}|{STOPPED}[^。；;]{{0,90}}{NAMES}", "cancelled_or_declined", "surgical_intent", "high", "definite", _around(OTHER_LESION, 100, 100, False)),
    _decision("specific_aaoca_surgical_intent",
              "(?is)(?:AAOCA|AORCA|冠状动脉起源异常|冠脉起源异常|冠状动脉异常起源|冠脉异常起源|(?:左|右)冠(?:状动脉)?(?:起源)?异常|(?:左|右)冠(?:状动脉)?.{0,18}(?:起自|起源于|发自).{0,18}(?:冠窦|主动脉))"
              "[^。；;\\n]{0,60}(?:(?:后续|择期|必要时|评估后|检查后)?(?:仍|可能)?(?:拟|计划|建议|考虑|需|需要)[^。；;\\n]{0,20}(?:手术治疗|外科手术|外科治疗|手术干预|外科[^。；;\\n]{0,10}纠治|手术[^。；;\\n]{0,10}纠治)|"
              "(?:评估|检查|讨论)[^。；;\\n]{0,24}是否(?:需要)?[^。；;\\n]{0,10}(?:手术|外科治疗))", "intended", "surgical_intent", "medium", "definite", dated="contextual"),
    _decision("generic_aaoca_surgical_intent", f"(?is){NAMES}[^。；;\\n]{{0,55}}(?:拟|计划|建议|考虑|准备|需|具备)[^。；;\\n]{{0,16}}{SURGERY}|(?:拟|计划|建议|考虑|准备|需|具备)[^。；;\\n]{{0,16}}{SURGERY}[^。；;\\n]{{0,55}}{NAMES}", "intended",
              "surgical_intent", "medium", "probable", _around(OTHER_LESION, 80, 80, False), dated="contextual", when="no_field"),
]


def compact(text: Column) -> Column:
    """Without white space, and with the usual misreading of 'ostium' mended."""
    return F.regexp_replace(F.regexp_replace(text, "[\\s\\u3000\\xA0]+", ""), "开又|开囗", "开口")


def procedure_types(value: Column) -> Column:
    """Kinds of operation on the vessel that a text names, adjuncts after them."""
    c = compact(value)
    types = F.array_distinct(F.array_compact(F.array(*(F.when(c.rlike(f"(?is){p}"), n) for n, p in OPERATIONS))))
    types = F.when(c.rlike(ANEURYSM), F.array_remove(types, "coronary_repair")).otherwise(types)
    adjuncts = F.array_compact(F.array(*(F.when(c.rlike(p), n) for n, p in ADJUNCTS)))
    return let(types, lambda t: F.when(F.size(t) > 0, F.array_distinct(F.concat(t, adjuncts))).otherwise(t))


def procedure_profile(name: Column) -> Column:
    """(modes, categories) of a procedure's name; each numbered part keeps its own mode."""
    parts = F.split(F.regexp_replace(F.regexp_replace(name, "\\s+", ""), "[（(][^()（）]*[)）]", ""), "\\d+[.．、]|[、,，;；+]")

    def of(phrase: Column) -> Column:
        hits = F.array_compact(F.array(*(F.when(phrase.rlike(p), n) for n, p in CATEGORIES)))
        return F.struct(hits.alias("hits"), phrase.rlike("经导管|经皮|封堵|球囊|消融|支架").alias("catheter"))

    def profile(each: Column) -> Column:
        every = F.array_distinct(F.flatten(F.transform(each, lambda x: x.hits)))
        mode = F.transform(each, lambda x: F.concat(
            F.when(F.size(F.array_remove(x.hits, "noncardiac_procedure")) > 0, F.array(F.when(x.catheter, "cardiac_catheter_intervention").otherwise("cardiac_surgery"))).otherwise(F.array().cast("array<string>")),
            F.when(F.array_contains(x.hits, "noncardiac_procedure"), F.array(F.lit("noncardiac_surgery"))).otherwise(F.array().cast("array<string>")),
        ))
        ordered = F.filter(F.array(*(F.lit(n) for n, _ in CATEGORIES)), lambda n: F.array_contains(every, n))
        none = F.array(F.lit("unclassified_operation"))
        return F.struct(F.when(F.size(every) == 0, none).otherwise(F.array_sort(F.array_distinct(F.flatten(mode)))).alias("modes"), F.when(F.size(every) == 0, none).otherwise(ordered).alias("categories"))

    return let(F.transform(parts, of), profile)


def _days(text: Column) -> Column:
    """[(day, end)] of the valid days of a text."""

    def one(m: Column) -> Column:
        part = [F.regexp_extract(m.mention, DAY, i) for i in (1, 2, 3)]
        iso = F.concat_ws("-", part[0], F.lpad(part[1], 2, "0"), F.lpad(part[2], 2, "0"))
        return F.struct(F.when(F.try_to_date(iso, "yyyy-MM-dd").isNotNull(), iso).alias("day"), m.end.alias("end"))

    return F.filter(F.transform(places(text, DAY), one), lambda d: d.day.isNotNull())


def _months(text: Column) -> Column:
    def one(m: Column) -> Column:
        return F.struct(F.concat_ws("-", F.regexp_extract(m.mention, MONTH, 1), F.lpad(F.regexp_extract(m.mention, MONTH, 2), 2, "0")).alias("day"), m.end.alias("end"))

    return F.transform(places(text, MONTH), one)


def evidence_date(text: Column, section_date: Column, subtype: Column, start: Column, end: Column, completed: Column) -> Column:
    """(date, role, flags, candidates) of an assertion at [start, end): a field of the operation's time, else a date bound to
    the deed, else a month, a day after the operation, or what the section's kind allows; plans take the nearest date."""
    near = window(text, start, end, 100, 70)
    day = F.coalesce(section_date, F.lit(""))

    def days(x: Column) -> Column:
        return F.transform(x, lambda d: d.day)

    fields = F.flatten(F.transform(places(text, "(?is)手术时间\\s*[:：]?\\s*.{0,45}"), lambda m: days(_days(m.mention))))

    def tied(found: Column, width: int, gap: int) -> Column:
        deed = f"(?is)^\\s*(?:(?:于|在)\\s*(?:我院|本院|外院)?.{{0,{gap}}})?(?:(?:已|曾|予)\\s*)?(?:行|接受|完成)"
        return F.transform(F.filter(found, lambda d: F.substring(near, d.end + 1, F.lit(width)).rlike(deed)), lambda d: d.day)

    def of(x: Column) -> Column:
        after = F.regexp_extract(near, "术后第?\\s*(\\d{1,3})\\s*天", 1)
        counted = F.date_format(F.date_sub(F.try_to_date(day, "yyyy-MM-dd"), after.try_cast("int")), "yyyy-MM-dd")
        bound, bound_month = F.try_element_at(tied(x.local, 100, 20), F.lit(-1)), F.try_element_at(tied(x.months, 110, 35), F.lit(-1))

        def pick(role: str, value: Column) -> Column:
            return F.struct(value.alias("date"), F.lit(role).alias("role"))

        done = (
            F.when(F.size(x.fields) > 0, pick("performed", F.get(x.fields, F.lit(0)))).when(F.size(tied(x.local, 100, 20)) > 0, pick("historical_performed", bound))
            .when(F.size(tied(x.months, 110, 35)) > 0, pick("historical_performed_month", bound_month))
            .when((after != "") & (day != ""), F.when(counted.isNotNull(), pick("inferred_from_postoperative_day", counted)).otherwise(pick("unknown", F.lit(""))))
            .when((subtype == "postop_progress") & near.rlike("术后首次") & (day != ""), pick("inferred_same_day_postoperative_note", day))
            .when((subtype == "surgery_record") & (day != ""), pick("surgery_record_section_date", day)).otherwise(pick("unknown", F.lit("")))
        )
        planned = (
            F.when(F.size(x.local) > 0, pick("planned_or_section", F.get(x.local, F.lit(0)).day)).when(F.size(x.months) > 0, pick("planned_or_section_month", F.get(x.months, F.lit(0)).day))
            .when(day != "", pick("section_date", day)).otherwise(pick("unknown", F.lit("")))
        )
        chosen = F.when(completed, done).otherwise(planned)
        own = F.when(day != "", F.array(day)).otherwise(F.array().cast("array<string>"))
        every = F.concat(F.when(completed, x.fields).otherwise(F.slice(x.fields, 1, 0)), days(x.local), days(x.months), own)

        def finished(c: Column) -> Column:
            counted_first = F.when(c.role == "inferred_from_postoperative_day", F.concat(F.array(c.date), every)).otherwise(every)
            by_field = completed & (F.size(x.fields) > 0)
            flags = [F.when(by_field & (F.size(F.array_distinct(x.fields)) > 1), "multiple_surgery_time_dates"), F.when(by_field & (day != "") & (c.date != day), "section_and_surgery_date_conflict")]
            return F.struct(c.date.alias("date"), c.role.alias("role"), F.array_compact(F.array(*flags)).alias("flags"), F.array_distinct(counted_first).alias("candidates"))

        return let(chosen, finished)

    return let(F.struct(F.when(completed, fields).otherwise(F.slice(fields, 1, 0)).alias("fields"), _days(near).alias("local"), _months(near).alias("months")), of)


def precision(date: Column) -> Column:
    return F.when(date.rlike("^\\d{4}-\\d{2}-\\d{2}$"), "day").when(date != "", "month").otherwise("unknown")


def _assertion(rule_id, assertion, kind, strength, relation, name: Column, types: Column, start: Column, end: Column, flags: Column, dated: str) -> Column:
    lit = [x if isinstance(x, Column) else F.lit(x) for x in (rule_id, assertion, kind, strength, relation)]
    names = ("rule_id", "assertion", "event_kind", "strength", "aaoca_relation")
    return F.struct(*(c.alias(n) for c, n in zip(lit, names, strict=True)), name.alias("procedure_name_raw"), types.alias("procedure_types"), start.alias("assertion_char_start"), end.alias("assertion_char_end"),
                    flags.alias("extra_flags"), F.lit(dated).alias("date_policy"))




def _strings(*values: str) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def _assertions(text: Column, kind: Column, subtype: Column) -> Column:
    """All assertions of a section, before dates and dedupe."""
    planning = subtype.isin(PLANNING_SUBTYPES) | ((kind == "administrative") & F.substring(text, 1, 240).contains("知情同意"))
    none = F.array().cast("array<struct<mention:string,start:int,end:int>>")
    fields = F.when(text.rlike(FIELD), places(text, FIELD)).otherwise(none)
    no_rows = F.filter(F.array(_assertion("", "", "", "", "", F.lit(""), _strings(), F.lit(0), F.lit(0), _strings(), "")), lambda x: F.lit(False))

    def field_rows(m: Column) -> Column:
        value, planned = strip(F.regexp_replace(m.mention, FIELD_HEAD, "")), m.mention.startswith("拟")

        def judged(x: Column) -> Column:
            near = window(text, m.start, m.end, 100, 100)
            intended = planned | planning
            recorded = subtype.isin(OPERATED_SUBTYPES) | text.rlike(COMPLETION)
            soft_plan = near.rlike(f"(?i){PLAN}") & ~near.rlike(COMPLETION)
            state = F.when(intended, "intended").when(recorded, "completed").when(soft_plan, "intended").when(near.rlike(COMPLETION), "completed")
            strength = F.when(intended | recorded | soft_plan, "high").otherwise("medium")
            rule = F.when(state == "intended", "specific_aaoca_operation_planned").otherwise("specific_aaoca_operation_completed")
            diagnostic, treats = compact(value).rlike(f"(?i){DIAGNOSTIC}"), compact(value).rlike(THERAPEUTIC)
            typed = F.size(x.types) > 0
            one = F.when(typed & state.isNotNull(), F.array(_assertion(rule, state, "aaoca_surgery", strength, "definite", value, x.types, m.start, m.end, _strings(), "contextual")))
            two = F.when(~typed & diagnostic, F.array(_assertion("coronary_diagnostic_procedure_not_surgery", F.when(intended, "intended").otherwise("diagnostic_completed"), "diagnostic_procedure", "high",
                         "related_nontherapeutic", value, _strings("coronary_diagnostic_procedure"), m.start, m.end, _strings("does_not_count_as_aaoca_surgery"), "contextual")))
            other = ~typed & (~diagnostic | ~F.array_contains(x.profile.modes, "unclassified_operation")) & (subtype == "surgery_record") & ~planned & treats
            flags = F.when(text.rlike(ANCHOR), _strings("does_not_count_as_aaoca_surgery", "aaoca_relation_not_established_by_rule")).otherwise(_strings("does_not_count_as_aaoca_surgery"))
            three = F.when(other, F.array(_assertion("completed_operation_not_aaoca_matched", "unrelated_completed", "other_surgery", "high", "unrelated_or_unresolved", value, _strings(), m.start, m.end, flags, "contextual")))
            return F.concat(*(F.coalesce(r, no_rows) for r in (one, two, three)))

        return let(F.struct(procedure_types(value).alias("types"), procedure_profile(value).alias("profile")), judged)

    by_field = F.flatten(F.transform(fields, field_rows))

    def context(rule_id: str, pattern: str, flags: tuple[str, ...], body: bool) -> Column:
        at = F.locate("手术经过", text) - 1
        part = F.when(at >= 0, F.substring(text, at + 1, F.length(text))).otherwise("") if body else text
        shift = at if body else F.lit(0)
        found = F.when((subtype == "surgery_record") & part.rlike(pattern), places(part, pattern)).otherwise(none)
        return F.transform(found, lambda m: _assertion(rule_id, "context_only", "operative_context", "high", "unresolved", F.lit(""), _strings(), m.start + shift, m.end + shift, _strings(*flags), "section"))

    in_other = F.concat(
        context("coronary_manipulation_during_other_operation", MANIPULATION, ("does_not_count_as_aaoca_surgery", "complex_procedure_relation_requires_review"), False),
        context("coronary_anatomy_during_other_operation", ANATOMY, (), True),
    )

    def free(m: Column) -> Column:
        low, high = F.greatest(m.start - 100, F.lit(0)), F.least(m.end + 110, F.length(text))
        near = window(text, m.start, m.end, 100, 110)
        plan, done = near.rlike(f"(?i){PLAN}"), near.rlike(COMPLETION)
        formal = subtype.isin(OPERATED_SUBTYPES)
        state = (
            F.when(near.rlike(NOT_PERFORMED), "conservative").when(near.rlike(f"(?i){CANCEL}") & plan & ~near.rlike("术后|已行|手术记录"), "cancelled_or_declined")
            .when(planning | (plan & ~done), "intended").when(formal | done, "completed")
        )
        rule = (
            F.when(state == "conservative", "specific_aaoca_operation_explicitly_not_performed").when(state == "cancelled_or_declined", "aaoca_operation_cancelled_or_declined")
            .when(state == "intended", "specific_aaoca_operation_planned").otherwise("specific_aaoca_operation_completed")
        )
        strength = F.when((state == "completed") & ~formal, "medium").otherwise("high")
        row = _assertion(rule, state, "aaoca_surgery", strength, "definite", m.mention, procedure_types(m.mention), low, high, _strings(), "contextual")
        ok = state.isNotNull() & window(text, m.start, m.end, 260, 260).rlike(ANCHOR)
        return F.when(ok, F.array(row)).otherwise(no_rows)

    named = F.when(text.rlike(SPECIFIC_OPERATION), places(text, SPECIFIC_OPERATION)).otherwise(none)
    by_name = F.filter(F.flatten(F.transform(named, free)), lambda r: F.size(r.procedure_types) > 0)

    diagnoses = compact(F.array_join(F.regexp_extract_all(text, F.lit(DIAGNOSIS_FIELD), F.lit(1)), " "))
    sole = diagnoses.rlike(DIAGNOSIS) & ~diagnoses.rlike(OTHER_LESION) & ~diagnoses.rlike("阑尾|肿瘤|疝|骨折|鞘膜|胆囊")
    when = {"all": F.lit(True), "deciding": kind.isin(DECIDING_TYPES), "operated": subtype.isin(OPERATED_SUBTYPES), "sole_diagnosis": kind.isin(DECIDING_TYPES) & sole, "no_field": ~text.rlike(FIELD)}

    def decided(d: Decision) -> Column:
        def one(m: Column) -> Column:
            weak = d.weaker.holds(text, m) if d.weaker else F.lit(False)
            state = F.when(m.mention.rlike(d.instead[0]), d.instead[1]).otherwise(d.assertion) if d.instead else F.lit(d.assertion)
            flags = F.when(weak, _strings(*d.flags, "embedded_imaging_nonoperation_label")).otherwise(_strings(*d.flags))
            return _assertion(d.rule.rule_id, state, d.kind, F.when(weak, "medium").otherwise(d.rule.strength), F.when(weak, "probable").otherwise(d.relation), F.lit(""), _strings(), m.start, m.end, flags, d.dated)

        return F.when(when[d.when], F.transform(matches(text, d.rule), one)).otherwise(no_rows)

    def with_context(rows: Column) -> Column:
        return F.concat(rows, F.when(F.exists(rows, lambda r: r.assertion == "unrelated_completed"), in_other).otherwise(no_rows))

    return F.concat(let(by_field, with_context), by_name, *(decided(d) for d in DECISIONS))


def evidence(sections: DataFrame) -> DataFrame:
    """Assertions of sections (patient_id, document_id, section_id, section_type, section_subtype, section_date, text, ...):
    overlapping conservative ones are one decision, of others the strongest of each meaning stays; ids are unique."""
    rows = sections.where(~F.col("section_type").isin("laboratory", "nonclinical") & (F.coalesce("text", F.lit("")) != ""))
    told = _assertions(F.col("text"), F.col("section_type"), F.coalesce("section_subtype", F.lit("")))
    rows = rows.select("*", F.posexplode(told).alias("_ord", "_a")).select("*", "_a.*").drop("_a")
    start, end = F.col("assertion_char_start"), F.col("assertion_char_end")
    rows = rows.withColumns({"char_start": F.greatest(start - 180, F.lit(0)), "char_end": F.least(end + 220, F.length("text"))})
    done = F.col("assertion").isin("completed", "diagnostic_completed", "unrelated_completed")
    rows = rows.withColumn("_d", evidence_date(F.col("text"), F.col("section_date"), F.coalesce("section_subtype", F.lit("")), F.col("char_start"), F.col("char_end"), done))
    own = F.coalesce("section_date", F.lit(""))
    decided = (F.col("date_policy") == "section") & (own != "")
    date = F.when(decided, own).otherwise(F.col("_d.date"))
    flags = F.array_distinct(F.concat("extra_flags", "_d.flags"))
    rows = rows.withColumns({
        "evidence_date": date, "date_role": F.when(decided, "decision_documented").otherwise(F.col("_d.role")), "flags": flags,
        "date_candidates": F.when(decided, F.array_distinct(F.concat(F.array(own), F.col("_d.candidates")))).otherwise(F.col("_d.candidates")),
        "counts_as_aaoca_surgery": (F.col("event_kind") == "aaoca_surgery") & (F.col("assertion") == "completed"), "evidence_text": F.substring(F.col("text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start")),
        "evidence_id": stable_id("mge_", 20, "patient_id", "section_id", "rule_id", "assertion", start, end, "procedure_name_raw"),
    })
    day = F.col("evidence_date")
    rows = rows.withColumns({"date_precision": precision(day), "date_status": F.when(day == "", "unknown").when(~decided & (F.size("_d.flags") > 0), "conflict").when(precision(day) == "month", "partial").otherwise("known")})
    return _deduplicated(rows.drop("text", "_d", "extra_flags", "date_policy"))


def _rank(strength: Column) -> Column:
    return F.when(strength == "high", 2).when(strength == "medium", 1).otherwise(0)


def _deduplicated(rows: DataFrame) -> DataFrame:
    calm = F.col("assertion") == "conservative"
    types = F.concat_ws("|", "procedure_types")
    other = Window.partitionBy("section_id", "assertion", types, "evidence_date", "rule_id").orderBy(F.desc(_rank(F.col("strength"))), "_ord")
    strongest = rows.where(~calm).withColumn("_k", F.row_number().over(other)).where("_k = 1").drop("_k").withColumn("matched_rule_ids", F.array("rule_id"))
    decision = Window.partitionBy("section_id", "event_kind", types, "evidence_date").orderBy("assertion_char_start", "assertion_char_end", "_ord")
    reach = F.max("assertion_char_end").over(decision.rowsBetween(Window.unboundedPreceding, -1))
    groups = rows.where(calm).withColumn("_new", F.when(reach.isNull() | (F.col("assertion_char_start") >= reach), 1).otherwise(0)).withColumn("_island", F.sum("_new").over(decision.rowsBetween(Window.unboundedPreceding, 0)))
    specific = F.coalesce(*(F.when(F.col("rule_id") == r, n) for r, n in SPECIFICITY.items()), F.lit(0))
    island = Window.partitionBy("section_id", "event_kind", types, "evidence_date", "_island")
    best = island.orderBy(F.desc(_rank(F.col("strength"))), F.desc(specific), F.desc("assertion_char_start"), F.desc("evidence_id"))
    merged = groups.withColumns({
        "_k": F.row_number().over(best), "matched_rule_ids": F.array_sort(F.collect_set("rule_id").over(island)),
        "_flags": F.array_distinct(F.flatten(F.collect_list("flags").over(island.orderBy("assertion_char_start", "assertion_char_end", "_ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))),
    }).where("_k = 1").withColumn("flags", F.col("_flags")).drop("_k", "_flags", "_new", "_island")
    return strongest.unionByName(merged).dropDuplicates(["evidence_id"]).drop("_ord")


def priority(row) -> Column:
    """What makes an assertion the primary one: kind of record, strength, text layer before OCR, a date, an early place."""
    record = F.when(row.section_subtype == "surgery_record", 5).when(row.section_subtype == "postop_progress", 4).when(row.section_subtype == "transfer", 3).when(F.coalesce(row.section_subtype, F.lit("")) == "", 2).otherwise(1)
    return F.struct(record.alias("a"), (_rank(row.strength) + 1).alias("b"), (F.coalesce(row.text_source, F.lit("")) != "local_ocr").alias("c"), (row.evidence_date != "").alias("d"), (-row.char_start).alias("e"), row.evidence_id.alias("f"))


class _Columns:
    def __getattr__(self, name: str) -> Column:
        return F.col(name)


def events(found: DataFrame, far: int = 90) -> DataFrame:
    """Operations: formal records make an event a day; other completed evidence joins the only event, the one of its day, the
    nearest of its kind, or makes a historical event where every formal day is more than `far` days off. Without formal
    records dated evidence makes events, undated joins the one of its kind or makes an event of unknown date."""
    rows = found.where((F.col("assertion") == "completed") & F.col("counts_as_aaoca_surgery"))
    day = F.when(F.col("evidence_date").rlike("^\\d{4}-\\d{2}-\\d{2}$"), F.col("evidence_date"))
    formal = F.col("section_subtype") == "surgery_record"
    rows = rows.withColumns({"_formal": formal, "_day": F.to_date(day)})
    own = F.when(F.col("evidence_date") != "", F.col("evidence_date")).otherwise(F.concat(F.lit("document:"), "document_id"))
    per = rows.groupBy("patient_id").agg(F.bool_or("_formal").alias("_any"))
    rows = rows.join(per, "patient_id").withColumn("_anchor", F.when(F.col("_any"), F.col("_formal")).otherwise(F.col("evidence_date") != "")).withColumn("_key", F.when(F.col("_anchor"), F.when(F.col("_any"), own).otherwise(F.col("evidence_date"))))
    groups = rows.where("_anchor").groupBy("patient_id", F.col("_key").alias("key")).agg(F.max("_day").alias("at"), F.array_distinct(F.flatten(F.collect_set("procedure_types"))).alias("types"))
    anchors = groups.groupBy("patient_id").agg(F.array_sort(F.collect_list(F.struct("key", "at", "types"))).alias("_groups"))
    loose = rows.where("not _anchor").join(anchors, "patient_id", "left")
    dated = F.filter("_groups", lambda g: g.at.isNotNull())
    distant = (F.col("date_role") == "historical_performed") & F.col("_day").isNotNull() & (F.size(dated) > 0) & F.forall(dated, lambda g: F.abs(F.datediff(F.col("_day"), g.at)) > far)
    alike = F.filter("_groups", lambda g: F.arrays_overlap(g.types, F.col("procedure_types")))
    near = F.array_sort(F.transform(F.filter(alike, lambda g: g.at.isNotNull()), lambda g: F.struct(F.abs(F.datediff(F.col("_day"), g.at)).alias("gap"), g.key.alias("key"))))
    same = F.exists("_groups", lambda g: g.key == F.col("evidence_date"))
    to_formal = (
        F.when(distant, F.concat(F.lit("historical:"), "evidence_date")).when(F.size("_groups") == 1, F.get("_groups", F.lit(0)).key).when((F.col("evidence_date") != "") & same, F.col("evidence_date"))
        .when((F.col("evidence_date") != "") & (F.size(alike) > 0), F.get(near, F.lit(0)).key).when(F.size(alike) == 1, F.get(alike, F.lit(0)).key)
    )
    kinds = F.concat_ws("|", F.array_sort("procedure_types"))
    to_dated = F.when(F.size(alike) == 1, F.get(alike, F.lit(0)).key).otherwise(F.concat(F.lit("unknown:"), F.when(kinds != "", kinds).otherwise("unspecified_aaoca_surgery")))
    placed = loose.withColumn("_key", F.when(F.col("_any"), to_formal).otherwise(to_dated)).drop("_groups")
    every = rows.where("_anchor").unionByName(placed.where("_key is not null"))
    c = _Columns()
    ranked = F.reverse(F.array_sort(F.collect_list(F.struct(priority(c).alias("p"), "evidence_id", "document_id", "section_id", "procedure_types", "procedure_name_raw", "flags"))))
    out = every.groupBy("patient_id", "_key").agg(
        ranked.alias("r"), F.bool_or("_formal").alias("formal_surgery_record_present"), F.bool_or((F.col("section_subtype") == "postop_progress") | F.col("evidence_text").contains("术后")).alias("postoperative_evidence_present"),
    )

    def listed(part: str) -> Column:
        return F.array_distinct(F.transform("r", lambda x: x[part]))

    date = F.regexp_extract("_key", "^(?:historical:)?(\\d{4}-\\d{2}(?:-\\d{2})?)$", 1)
    only_day = F.when(F.col("formal_surgery_record_present") & ~date.rlike("^\\d{4}-\\d{2}-\\d{2}$"), "").otherwise(date)
    out = out.withColumn("surgery_date", only_day)
    flags = F.array_distinct(F.concat(F.flatten(F.transform("r", lambda x: x.flags)), F.when(F.col("surgery_date") == "", F.array(F.lit("surgery_date_unknown"))).otherwise(F.array().cast("array<string>"))))
    types = F.array_distinct(F.flatten(F.transform("r", lambda x: x.procedure_types)))
    out = out.withColumns({"procedure_types": types, "procedure_names": F.filter(listed("procedure_name_raw"), lambda n: F.trim(n) != ""), "conflict_flags": flags, "supporting_evidence_ids": listed("evidence_id")})
    clash = F.exists("conflict_flags", lambda f: f.contains("date_conflict") | (f == "multiple_surgery_time_dates"))
    when = precision(F.col("surgery_date"))
    status = F.when(F.col("surgery_date") == "", "unknown").when(clash, "conflict").when(when == "month", "partial").otherwise("known")
    named = F.when(F.col("surgery_date") != "", F.col("surgery_date")).otherwise(F.concat(F.lit("unknown:"), F.regexp_replace("_key", "^unknown:", "")))
    return out.select(
        "patient_id", stable_id("surg_", 20, "patient_id", named, F.concat_ws("|", F.array_sort("procedure_types"))).alias("surgery_event_id"), "surgery_date", when.alias("surgery_date_precision"), status.alias("date_status"), "procedure_types", "procedure_names",
        F.size("supporting_evidence_ids").alias("n_supporting_evidence"), F.get("r", F.lit(0)).evidence_id.alias("primary_evidence_id"), "supporting_evidence_ids", "formal_surgery_record_present", "postoperative_evidence_present",
        (~F.col("formal_surgery_record_present") & ~F.col("postoperative_evidence_present")).alias("historical_only"), F.when(F.col("formal_surgery_record_present") & (status == "known"), "high").otherwise("medium").alias("relation_confidence"),
        listed("document_id").alias("source_document_ids"), listed("section_id").alias("source_section_ids"), "conflict_flags",
    )


def at_or_after(a: Column, b: Column) -> Column:
    """Whether assertion a is not before b: by months, then days where both have one; equal or unknown dates leave it to their
    places in one section or document; else no. A partial order: two assertions may come out false either way."""
    x, y = F.split(a.evidence_date, "-"), F.split(b.evidence_date, "-")
    both = (F.size(x) >= 2) & (F.size(y) >= 2)
    month_a, month_b = F.substring(a.evidence_date, 1, 7), F.substring(b.evidence_date, 1, 7)
    days = (F.size(x) == 3) & (F.size(y) == 3)
    number = [F.regexp_extract(r.section_id, "_s(\\d+)$", 1).try_cast("int") for r in (a, b)]
    place = F.when(a.section_id == b.section_id, a.assertion_char_start >= b.assertion_char_start).when((a.document_id == b.document_id) & number[0].isNotNull() & number[1].isNotNull(), number[0] >= number[1]).otherwise(False)
    return F.when(both & (month_a != month_b), month_a > month_b).when(both & days & (a.evidence_date != b.evidence_date), a.evidence_date > b.evidence_date).otherwise(place)


_FACT = ["evidence_id", "rule_id", "matched_rule_ids", "assertion", "event_kind", "strength", "evidence_date", "date_precision", "document_id", "section_id", "section_subtype", "text_source", "char_start", "assertion_char_start",
         "assertion_char_end", "date_requires_review", "counts_as_aaoca_surgery", "procedure_name_raw", "procedure_types", "flags", "evidence_text"]


def summary(selection: DataFrame, found: DataFrame, operations: DataFrame) -> DataFrame:
    """One row a selected subject (patient_id): management by precedence (events, then a decision not to operate that no intent
    follows, then intent, then observation), review reasons, issues and the context of other procedures. A subject's
    assertions are one record of a chart; they meet as one array."""
    facts = found.select("patient_id", F.struct(*_FACT).alias("e")).groupBy("patient_id").agg(F.sort_array(F.collect_list("e")).alias("e"))
    event = operations.groupBy("patient_id").agg(F.sort_array(F.collect_list(F.struct("surgery_date", "surgery_event_id", "date_status", "surgery_date_precision", "historical_only", "relation_confidence", "primary_evidence_id",
                                                  "supporting_evidence_ids", "conflict_flags", "procedure_types", "procedure_names"))).alias("v"))
    rows = selection.join(facts, "patient_id", "left").join(event, "patient_id", "left")
    rows = rows.withColumns({"e": F.coalesce("e", F.filter(F.array(F.lit(None).cast(facts.schema["e"].dataType.elementType)), lambda x: F.lit(False))), "v": F.coalesce("v", F.filter(F.array(F.lit(None).cast(event.schema["v"].dataType.elementType)), lambda x: F.lit(False)))})

    def of(*states: str) -> Column:
        return F.filter("e", lambda x: x.assertion.isin(*states))

    rows = rows.withColumns({
        "_done": F.filter("e", lambda x: (x.assertion == "completed") & x.counts_as_aaoca_surgery), "_intended": F.filter("e", lambda x: (x.assertion == "intended") & (x.event_kind != "diagnostic_procedure")),
        "_stopped": of("cancelled_or_declined"), "_calm": of("conservative"), "_tests": of("diagnostic_completed"), "_others": of("unrelated_completed"),
    })
    earlier = F.concat("_intended", "_stopped")
    firm = F.filter("_calm", lambda x: x.strength == "high")
    seen = F.filter("_calm", lambda x: F.arrays_overlap(x.matched_rule_ids, _strings("aaoca_multidisciplinary_observation", "aaoca_no_near_term_intervention")))
    rows = rows.withColumns({"_earlier": earlier, "_firm": firm, "_seen": seen})
    last = F.exists("_firm", lambda d: F.forall("_earlier", lambda x: at_or_after(d, x)))
    watched = (F.size("_earlier") > 0) & F.exists("_seen", lambda d: ~F.exists("_stopped", lambda x: x.section_id == d.section_id) & F.forall("_earlier", lambda x: at_or_after(d, x)))
    rows = rows.withColumn("_supersedes", last | watched)
    has = {c: F.size(f"_{c}") > 0 for c in ("done", "intended", "stopped", "calm", "tests", "others", "earlier", "firm")}
    operated = F.size("v") > 0
    managed = F.when(operated, "surgery").when(has["earlier"] & ~F.col("_supersedes"), "intended_surgery").when(has["calm"], "conservative").otherwise("unknown")
    rows = rows.withColumn("observed_management", managed)
    m = F.col("observed_management")
    ladder = [("surgery", "completed_aaoca_surgery_evidence"), ("intended_surgery", "surgical_intent_without_completion"), ("conservative", "explicit_nonoperative_management")]
    rule = F.coalesce(*(F.when(m == k, r) for k, r in ladder), F.lit("insufficient_management_evidence"))
    main = F.sort_array(F.transform("v", lambda x: F.struct((x.relation_confidence == "high").alias("a"), (x.surgery_date != "").alias("b"), x.surgery_date.alias("c"), x.primary_evidence_id.alias("id"))), asc=False)

    def top(c: str) -> Column:
        return F.get(F.sort_array(F.transform(c, priority), asc=False), F.lit(0)).f

    primary = F.when(operated, F.get(main, F.lit(0)).id).when(m == "intended_surgery", top("_earlier")).when(m == "conservative", top("_calm")).when(has["tests"], top("_tests")).when(has["others"], top("_others")).otherwise("")
    known = F.forall("v", lambda x: x.date_status == "known")
    old = operated & F.forall("v", lambda x: x.historical_only)
    assigned = F.flatten(F.transform("v", lambda x: x.supporting_evidence_ids))
    adrift = F.filter("_done", lambda x: ~F.array_contains(assigned, x.evidence_id))
    ocr = F.exists("_done", lambda x: F.coalesce(x.date_requires_review, F.lit(False)))
    unknown = m == "unknown"
    rows = rows.withColumns({"_adrift": adrift, "_old": old, "_unsure": operated & ~known, "_ocr": ocr, "_context": _context(m, operated)})
    rows = rows.withColumns({n: F.col(f"_context.{n}") for n in CONTEXT})
    complex_ = F.size("complex_case_review_reasons") > 0
    soft = (m == "conservative") & ~has["firm"]
    why = reasons([
        ("historical_surgery_evidence_only", F.col("_old")), ("surgery_date_unknown_or_conflicting", F.col("_unsure")), ("multiple_aaoca_surgery_events", F.size("v") > 1),
        ("completion_not_proven", m == "intended_surgery"), ("followup_or_observation_only", soft), ("no_completed_intent_or_conservative_evidence", unknown),
        ("unrelated_completed_operation_not_aaoca_management", unknown & has["others"]), ("mixed_intent_and_conservative_evidence", has["intended"] & has["calm"]),
        ("completed_evidence_not_uniquely_assigned_to_event", F.size("_adrift") > 0), ("cancelled_or_declined_surgery_documented", has["stopped"]), ("ocr_derived_completion_or_date_evidence", F.col("_ocr")),
        ("complex_management_context", complex_),
    ])

    def flagged(name: str) -> Column:
        return F.exists("v", lambda x: F.array_contains(x.conflict_flags, name))

    issues = [
        ("mixed_intent_and_conservative_evidence", "medium", has["intended"] & has["calm"]), ("completed_evidence_not_uniquely_assigned_to_event", "medium", F.size("_adrift") > 0), ("management_unknown", "high", unknown),
        ("unrelated_operation_without_aaoca_management", "high", unknown & has["others"]), ("surgery_date_unknown", "medium", flagged("surgery_date_unknown")),
        ("section_and_surgery_date_conflict", "high", flagged("section_and_surgery_date_conflict")), ("multiple_surgery_time_dates", "medium", flagged("multiple_surgery_time_dates")),
        ("completion_not_proven", "high", has["earlier"] & (m == "intended_surgery")), ("followup_or_observation_only", "medium", soft), ("historical_surgery_evidence_only", "medium", F.col("_old")),
        ("surgery_date_partial", "medium", F.exists("v", lambda x: x.date_status == "partial")), ("ocr_derived_completion_or_date_evidence", "medium", F.col("_ocr")), ("multiple_aaoca_surgery_events", "medium", F.size("v") > 1),
    ]
    listed = [F.when(hit, F.struct(F.lit(n).alias("issue_type"), F.lit(s).alias("severity"))) for n, s, hit in issues]
    listed.append(F.when(complex_, F.struct(F.lit("complex_management_context").alias("issue_type"), F.col("complex_case_review_priority").alias("severity"))))
    dates = F.array_sort(F.filter(F.transform("v", lambda x: x.surgery_date), lambda d: d != ""))
    confidence = F.when(operated, F.when(F.exists("v", lambda x: x.relation_confidence == "high"), "high").otherwise("medium")).when(m == "intended_surgery", "medium").when(m == "conservative", F.when(has["firm"], "high").otherwise("medium")).otherwise("low")
    treated = F.when(operated | has["others"], "surgery").otherwise(m)
    return rows.select(
        *selection.columns, "observed_management", treated.alias("overall_treatment_status"), F.when(operated, "completed_aaoca_surgery_evidence").when(has["others"], "completed_non_aaoca_surgery_evidence").otherwise(rule).alias("overall_treatment_rule"),
        F.when(operated, "yes").when((m == "conservative") & has["firm"], "no").otherwise("unknown").alias("actual_aaoca_surgery"), confidence.alias("management_confidence"), rule.alias("management_rule"), F.size("v").alias("n_surgery_events"),
        F.when(~operated, "none").when(known, "exact").otherwise("minimum").alias("surgery_event_count_status"), F.coalesce(F.get(dates, F.lit(0)), F.lit("")).alias("first_surgery_date"), dates.alias("surgery_dates"),
        F.array_distinct(F.flatten(F.transform("v", lambda x: x.procedure_types))).alias("procedure_types"),
        *(has[k].alias(n) for k, n in (("done", "has_completed_surgery_evidence"), ("intended", "has_surgical_intent_evidence"), ("stopped", "has_cancelled_or_declined_evidence"), ("calm", "has_conservative_evidence"),
                                       ("tests", "has_diagnostic_procedure_evidence"), ("others", "has_unrelated_surgery_evidence"))),
        F.coalesce(primary, F.lit("")).alias("primary_evidence_id"), F.size("e").alias("n_management_evidence_rows"), "other_cardiac_procedure_status", "other_procedure_modes", "other_procedure_categories",
        "aaoca_handling_during_other_procedure", "other_procedure_contexts", "management_complexity_flags", "complex_case_review_priority", "complex_case_review_reasons", why.alias("review_reasons"), (F.size(why) > 0).alias("review_required"),
        F.array_compact(F.array(*listed)).alias("issues"),
    )


CONTEXT = ["other_cardiac_procedure_status", "other_procedure_modes", "other_procedure_categories", "aaoca_handling_during_other_procedure", "other_procedure_contexts", "management_complexity_flags", "complex_case_review_priority", "complex_case_review_reasons"]


def _context(m: Column, operated: Column) -> Column:
    """Other procedures of a subject, how the vessel was handled in each, and flags of complex cases."""

    def said(x: Column) -> Column:
        return F.substring(x.evidence_text, x.assertion_char_start - x.char_start + 1, x.assertion_char_end - x.assertion_char_start)

    def relevant(x: Column) -> Column:
        own = F.array_except(procedure_profile(x.procedure_name_raw).categories, _strings("unclassified_operation", "outflow_or_pulmonary_artery_procedure"))
        return (x.assertion == "unrelated_completed") | (x.assertion == "completed") & (x.section_subtype == "surgery_record") & (F.size(own) > 0)

    def one(op: Column) -> Column:
        peers = F.filter("e", lambda x: (x.section_id == op.section_id) | (x.document_id == op.document_id) & (x.date_precision == "day") & (op.date_precision == "day") & (x.evidence_date == op.evidence_date) & x.section_subtype.isin(OPERATED_SUBTYPES))

        def handled(p: Column) -> Column:
            repairs = F.exists(p.peers, lambda x: (x.assertion == "completed") & x.counts_as_aaoca_surgery)
            left = F.filter(p.peers, lambda x: (x.assertion == "conservative") & (x.strength == "high") & said(x).rlike("未(?:予)?处理|不予处理|无需.{0,4}处理"))
            moved = F.exists(p.peers, lambda x: x.rule_id == "coronary_manipulation_during_other_operation")
            viewed = F.exists(p.peers, lambda x: x.rule_id == "coronary_anatomy_during_other_operation")
            cardiac = F.exists(p.profile.modes, lambda n: n.startswith("cardiac_"))
            untreated = F.size(left) > 0
            normal = F.exists(left, lambda x: said(x).rlike("未见.{0,4}异常|无明显异常"))
            how = (
                F.when(~cardiac, "not_applicable").when(repairs & untreated, "conflicting_documentation").when(repairs, "concomitant_aaoca_repair").when(untreated & normal, "assessed_no_intervention")
                .when(untreated, "explicitly_not_treated").when(moved, "coronary_manipulated_target_unclear").when(viewed, "anatomy_documented_intervention_unclear").otherwise("not_documented")
            )
            odd = cardiac & ~repairs & (F.arrays_overlap(p.profile.categories, _strings(*COMPLEX)) | moved | op.procedure_name_raw.rlike("肺动脉干.{0,4}(?:移位|转位)"))
            return F.struct(op.evidence_id.alias("procedure_evidence_id"), op.evidence_date.alias("procedure_date"), F.when(F.size(p.profile.modes) == 1, F.get(p.profile.modes, F.lit(0))).otherwise("mixed").alias("procedure_mode"),
                            p.profile.modes.alias("procedure_modes"), p.profile.categories.alias("procedure_categories"), how.alias("aaoca_handling"), cardiac.alias("cardiac"), odd.alias("complex"))

        return let(F.struct(peers.alias("peers"), procedure_profile(op.procedure_name_raw).alias("profile")), handled)

    contexts = F.transform(F.filter("e", relevant), one)

    def flags(c: Column) -> Column:
        def any_(test) -> Column:
            return F.exists(c, test)

        def handling(*names: str) -> Column:
            return any_(lambda x: x.cardiac & x.aaoca_handling.isin(*names))

        tests, intended, calm, stopped = (F.size(f"_{n}") > 0 for n in ("tests", "intended", "calm", "stopped"))
        heart, unknown = any_(lambda x: x.cardiac), m == "unknown"
        late = stopped | F.exists("_intended", lambda x: x.rule_id == "aaoca_surgery_recommended_family_deferred")
        ladder = [  # (flag, holds, asks for review, presses)
            ("conflicting_coronary_handling", handling("conflicting_documentation"), True, True), ("completed_other_cardiac_procedure", heart, False, False),
            ("aaoca_management_unresolved_after_other_cardiac_procedure", heart & unknown, True, True), ("aaoca_handling_not_documented_during_other_procedure", handling("not_documented"), True, False),
            ("aaoca_not_treated_during_other_procedure", handling("explicitly_not_treated", "assessed_no_intervention"), False, False),
            ("coronary_anatomy_seen_intervention_unresolved", handling("anatomy_documented_intervention_unclear"), True, False), ("complex_procedure_aaoca_relation_uncertain", any_(lambda x: x.complex), True, True),
            ("completed_noncardiac_procedure", any_(lambda x: F.array_contains(x.procedure_modes, "noncardiac_surgery")), False, False),
            ("completed_procedure_type_unclassified", any_(lambda x: x.procedure_mode == "unclassified_operation"), True, True),
            ("diagnostic_procedure_without_therapeutic_operation", tests & ~operated & (F.size(c) == 0), unknown, False), ("mixed_management_stages", (intended | stopped) & calm & ~operated, True, False),
            ("aaoca_surgical_intent_completion_unproven", m == "intended_surgery", True, False), ("surgery_cancelled_declined_or_deferred", late, ~operated, False),
            ("nonoperation_reported_in_imaging_only", F.exists("e", lambda x: F.array_contains(x.flags, "embedded_imaging_nonoperation_label")), True, False),
            ("management_decision_pending_documented", F.exists("e", lambda x: x.rule_id == "aaoca_management_decision_pending"), unknown, False), ("multiple_aaoca_surgery_events", F.size("v") > 1, True, False),
            ("aaoca_surgery_date_uncertain", F.exists("v", lambda x: x.date_status != "known"), True, False),
        ]
        found = F.array_compact(F.array(*(F.when(hit, n) for n, hit, _, _ in ladder)))
        asked = F.array_compact(F.array(*(F.when(hit & F.lit(ask) if isinstance(ask, bool) else hit & ask, n) for n, hit, ask, _ in ladder)))
        pressing = [hit for _, hit, _, press in ladder if press]
        bare = unknown & (F.size(asked) == 0)
        more = F.array(F.lit("insufficient_management_documentation"))
        high = pressing[0] | pressing[1] | pressing[2] | pressing[3]
        why = F.when(bare, more).otherwise(asked)
        modes = F.array_sort(F.array_distinct(F.flatten(F.transform(c, lambda x: x.procedure_modes))))
        how = F.array_sort(F.array_distinct(F.transform(F.filter(c, lambda x: x.cardiac), lambda x: x.aaoca_handling)))
        return F.struct(
            F.when(heart, "completed_other_cardiac_procedure").when(tests, "diagnostic_only_documented").otherwise("none_documented").alias("other_cardiac_procedure_status"), modes.alias("other_procedure_modes"),
            F.array_sort(F.array_distinct(F.flatten(F.transform(c, lambda x: x.procedure_categories)))).alias("other_procedure_categories"),
            F.when(F.size(how) == 1, F.get(how, F.lit(0))).when(F.size(how) > 1, "multiple_contexts").otherwise("not_applicable").alias("aaoca_handling_during_other_procedure"),
            F.transform(c, lambda x: x.dropFields("cardiac", "complex")).alias("other_procedure_contexts"), F.when(bare, F.concat(found, more)).otherwise(found).alias("management_complexity_flags"),
            F.when(high, "high").when(F.size(why) > 0, "medium").otherwise("routine").alias("complex_case_review_priority"), why.alias("complex_case_review_reasons"),
        )

    return let(contexts, flags)


def review_queue(summaries: DataFrame) -> DataFrame:
    """(patient_id, observed_management, issue_type, severity): why a subject needs a review, a row an issue."""
    return summaries.select("patient_id", "observed_management", F.explode("issues").alias("i")).select("patient_id", "observed_management", "i.*")


def cohort(manifest: DataFrame, cases: DataFrame) -> DataFrame:
    """(patient_id, aaoca_judgment, judgment_source, included_for_management, exclusion_reason): a finished human judgment
    before the automatic one; subjects that were no exception are yes."""
    known = cases.select("patient_id", "automatic_aaoca_judgment", "review_status", "final_aaoca_judgment")
    rows = manifest.select("patient_id").join(known, "patient_id", "left")
    human = (F.col("review_status") == "reviewed") & (F.coalesce("final_aaoca_judgment", F.lit("")) != "")
    said = F.when(human, F.col("final_aaoca_judgment")).when(F.col("automatic_aaoca_judgment").isNotNull(), F.col("automatic_aaoca_judgment")).otherwise("yes")
    source = F.when(human, "human_final_exception").when(F.col("automatic_aaoca_judgment").isNotNull(), "automatic_exception").otherwise("automatic_nonexception")
    return rows.select("patient_id", said.alias("aaoca_judgment"), source.alias("judgment_source"), (said == "yes").alias("included_for_management"), F.when(said == "yes", "").otherwise(F.concat(F.lit("aaoca_"), said)).alias("exclusion_reason"))

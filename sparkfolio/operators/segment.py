"""Pages to typed, dated sections.

A document's lines come together once, as an array; from there on every step is an expression on that array, so that the
whole segmentation costs one shuffle by document. Boundaries are accepted by a fold, for a repeated heading is judged by the
last heading that was accepted. Each line belongs to exactly one section. Dates are never inherited from a neighbour.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions import dates
from sparkfolio.functions.text import let, nfkc, strip

# --- fixed values: headings, fields and marks of the export templates ---
ADMINISTRATIVE_TITLES = ["住院患者临时离院风险知情及责任承诺书", "防治新型冠状病毒家属入院承诺书"]
TALK_TITLES = ["入院72小时内谈话记录", "入院24小时内谈话记录", "入院谈话记录"]
ADMISSION_TITLES = ["入院记录", "再次入院记录", "入院病历", "24小时内入出院记录"]
DISCHARGE_TITLES = ["出院记录", "出院小结", "出院总结"]
OUTPATIENT_TITLES = ["门诊记录", "门诊病历", "急诊记录", "门诊就诊记录"]
FOLLOW_UP_TITLES = ["随访记录", "随访病历", "随访报告", "门诊随访记录"]
PROGRESS_TITLES = ["首次病程记录", "日常病程记录", "病程记录", "转入记录", "转出记录", "抢救记录", "死亡记录"]
NO_TITLE = "[\\ue000-\\uf8ff。;；:：]"
NO_TITLE_START = "^(?:请|已|详见|参见|参阅|患者|患儿|本人|完善|※)"
LAB_APPLICATION = "^[\\s•·●▪◦★☆\\ue000-\\uf8ff]{0,6}申请项目\\s*[:：]\\s*(.*)$"
VISIT_DATE = "^就诊日期\\s*[:：]"
HOSPITAL = "^(?:上)?上海儿童[医醫區区]学中心$"
FIELD = "^(记录日期|记录时间|报告日期|报告时间|检验日期|检验时间|检查日期|检查时间|就诊日期|会诊日期|会诊时间|讨论日期|讨论时间|【讨论时间】|完成日期|出院日期)\\s*[:：]?\\s*"
HEADER_LINE = "^(?:上海交通大学医学院附属上海儿童医学中心|Shanghai Children's Medical Cent|姓名[:：]|性别[:：]|自费器械耗材/药品/检验/检查|科别/床号[:：]|日期[:：])"
NAVIGATION = "返回查询|VisitHistory/|BasicInfo/"
LAB_COVER = "动脉血\\s*共\\s*\\d+\\s*项"
GAS_ITEMS = ["pH", "PaCO2", "PaO2", "HCO3-", "Lac", "sO2", "ABE"]
CARDIAC_ITEMS = ["NT-proBNP", "proBNP", "HS-CTNI", "CTNI", "BNP"]
AFTER_ITEM = "(?=$|[\\s\\d.<>↑↓])"
ROLES = [("出生", "birth"), ("打印", "print"), ("送样", "sample_submission"), ("入院", "admission_mentioned"), ("出院", "discharge_mentioned"), ("拟定手术", "planned_surgery"),
         ("拟行手术", "planned_surgery"), ("手术", "surgery_mentioned"), ("记录", "record_field"), ("检验", "test_field"), ("报告", "report_field")]
POSTOPERATIVE = "术后(?:第?\\s*[一二三四五六七八九十\\d]+\\s*天)?|昨日[行已]|已[行完成].{0,20}手术"
FILENAME_DATE = "(?<!\\d)(?:19|20)\\d{2}[-年.]\\d{1,2}[-月.]\\d{1,2}日?(?!\\d)"
UNUSABLE = ["empty", "failed", "text_layer_unusable"]
# --- end of fixed values ---

UNCLEAR = ["unknown", "nonclinical"]
NEAR = 12
LOOK_AHEAD = 35


def title_kind(title: Column, dated: Column) -> Column:
    """The section type that a title-shaped line stands for, or null; dated: a date stands before it."""
    bare = F.regexp_replace(title, "^[()（）]+|[()（）]+$", "")
    rules = [
        ("administrative", bare.isin(ADMINISTRATIVE_TITLES) | title.rlike("(?:知情同意书|告知书|通知书|通知单|须知)$") | title.isin(TALK_TITLES)),
        ("admission", title.isin(ADMISSION_TITLES)),
        ("discharge", title.isin(DISCHARGE_TITLES)),
        ("consultation", title.rlike("^(?:.{0,12})?(?:会诊记录|会诊意见|会诊[单単箪])$")),
        ("progress", (title == "调整抗生素记录") | title.rlike("^术后.{0,16}病程(?:记录|录)$")),
        ("procedure", title.rlike("(?:术前|术后|手术|麻醉|操作).{0,18}(?:记录|讨论|小结|评估)(?:[（(].{0,16}[）)])?$") | (title.contains("术前小结") & dated)),
        ("ultrasound", title.rlike("^(?:.{0,10})?(?:超声报告|超声检查报告|超声检查报告单|心脏彩超报告)$")),
        ("laboratory", title.rlike("^(?:.{0,12})?(?:检验报告|检验报告单|化验报告单)$")),
        ("outpatient", title.isin(OUTPATIENT_TITLES)),
        ("follow_up", title.isin(FOLLOW_UP_TITLES)),
        ("progress", dated & title.rlike("病程|查房|病例讨论|抢救|转入|转出|交班|接班|抗生素使用") & ~title.rlike("[，,。]|患者|患儿|今日|昨日|辅助检查")),
        ("progress", title.isin(PROGRESS_TITLES)),
    ]
    shaped = (title != "") & (F.length(title) <= 60) & ~title.rlike(NO_TITLE) & ~title.rlike(NO_TITLE_START)
    return F.when(shaped, F.coalesce(*(F.when(hit, kind) for kind, hit in rules)))


def _heading(line: Column) -> Column:
    """(type_hint, title, kind, date of a dated title) of a line with value, dates and unusable; null where it heads nothing."""
    first = F.get(line.dates, F.lit(0))
    dated = F.coalesce(first.start == 0, F.lit(False))
    after = F.when(dated, strip(F.substring(line.value, first.end + 1, F.length(line.value)))).otherwise("")
    none = F.lit(None).cast("struct<date:string,timestamp:string,precision:string,start:int,end:int>")

    def heading(kind: Column, title: Column, how: str, date: Column) -> Column:
        return F.struct(kind.alias("type_hint"), title.alias("title"), F.lit(how).alias("kind"), date.alias("date"))

    with_date, plain = title_kind(after, F.lit(True)), title_kind(line.value, F.lit(False))
    return (
        F.when(line.unusable, None)
        .when(line.value.rlike(LAB_APPLICATION), heading(F.lit("laboratory"), line.value, "lab_application", none))
        .when(dated & with_date.isNotNull(), heading(with_date, after, "dated_title", first))
        .when(plain.isNotNull(), heading(plain, line.value, "title", none))
    )


def document_lines(pages: DataFrame) -> DataFrame:
    """(document_id, source_pdf, patient_id, lines) from pages (document_id, page, normalized_text, and where there are any
    patient_id, source_pdf, extraction_status, flags, analysis_text_source, ocr_status, normalized_line_map, removed_lines)."""
    given = set(pages.columns)

    def column(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in given else default

    status, flags = column("extraction_status", F.lit("ok")), column("flags", F.array().cast("array<string>"))
    from_ocr = (column("analysis_text_source", F.lit("")) == "local_ocr") & ~column("ocr_status", F.lit("")).isin("failed", "empty", "unavailable")
    damaged = F.arrays_overlap(flags, F.array(F.lit("vector_outlined_text_suspected"), F.lit("text_layer_missing")))
    chrome = F.lit(False)
    if "removed_lines" in given:
        browser = ["browser_title_at_page_margin", "browser_or_navigation_url"]
        chrome = F.coalesce(F.exists("removed_lines", lambda r: r.reason.isin(browser) & (r.raw_line <= 4)), F.lit(False))
    raw = F.get("normalized_line_map", F.col("at")) if "normalized_line_map" in given else F.lit(None).cast("int")
    rows = pages.select(
        "document_id", column("patient_id", F.lit("")).alias("patient_id"), column("source_pdf", F.lit("")).alias("source_pdf"), "page", from_ocr.alias("from_ocr"),
        (~from_ocr & (status.isin(UNUSABLE) | F.coalesce(damaged, F.lit(False)))).alias("unusable"), chrome.alias("chrome"),
        *([F.col("normalized_line_map")] if "normalized_line_map" in given else []),
        F.posexplode(F.split(F.coalesce("normalized_text", F.lit("")), "\n")).alias("at", "text"),
    )
    rows = rows.withColumn("value", strip(nfkc(F.col("text")))).withColumn("dates", dates.stamps(F.col("value")))
    only = F.get("dates", F.lit(0))
    alone = (F.size("dates") == 1) & (only.start == 0) & (only.end == F.length("value"))
    rows = rows.withColumn("alone", F.coalesce(alone, F.lit(False))).withColumn("margin", F.col("chrome") & (F.coalesce(raw, F.col("at") + 1) <= 2) & F.col("alone"))
    line = F.struct("page", (F.col("at") + 1).alias("line"), "text", "value", "dates", "alone", "margin", "unusable", "from_ocr")
    grouped = rows.groupBy("document_id").agg(F.max("patient_id").alias("patient_id"), F.max("source_pdf").alias("source_pdf"), F.collect_list(line).alias("lines"))
    in_order = F.array_sort("lines", lambda a, b: F.when(a.page != b.page, F.signum(a.page - b.page)).otherwise(F.signum(a.line - b.line)).cast("int"))
    with_heading = F.transform(in_order, lambda x: x.withField("heading", _heading(x)))
    return grouped.withColumn("lines", with_heading)


def _visits(lines: Column) -> Column:
    """For each line, (date, whole, pair) of an outpatient form that begins there without a title, else null."""

    def starts(x: Column, i: Column) -> Column:
        before, after = F.get(lines, i - 1), F.get(lines, i + 1)
        hospital = x.value.rlike(HOSPITAL)
        owned = F.coalesce(before.value.rlike(HOSPITAL), F.lit(False))
        return F.when(x.unusable, None).when(hospital & F.coalesce(after.value.rlike(VISIT_DATE), F.lit(False)), i + 1).when(x.value.rlike(VISIT_DATE) & ~owned, i)

    def form(at: Column) -> Column:
        head = F.get(lines, at)
        ahead = F.transform(F.slice(lines, at + 2, LOOK_AHEAD), lambda y: y.value)
        stop = F.array_position(F.transform(ahead, lambda v: v.rlike(VISIT_DATE)), True)
        own = F.when(stop > 0, F.slice(ahead, 1, F.greatest(stop.cast("int") - 1, F.lit(0)))).otherwise(ahead)

        def has(field: str) -> Column:
            return F.exists(own, lambda v: v.rlike(f"^{field}\\s*[:：]"))

        pair = has("主诉") & has("现病史")
        found = F.struct(F.get(head.dates, F.lit(0)).alias("date"), (pair & has("治疗计划")).alias("whole"), pair.alias("pair"))
        return F.when(head.value.contains("就诊科室") & (F.size(head.dates) > 0) & pair, found)

    return F.transform(lines, lambda x, i: let(starts(x, i), lambda at: F.when(at.isNotNull(), form(at))))


_BOUNDARY = "struct<at:int,type_hint:string,title:string,kind:string,date:struct<date:string,timestamp:string,precision:string,start:int,end:int>>"


def _marker(date: Column) -> Column:
    return F.coalesce(F.when(date.timestamp != "", date.timestamp).otherwise(date.date), F.lit(""))


def _boundaries(lines: Column, visits: Column) -> Column:
    """[(at, type_hint, title, kind, date)]: where sections begin, places from 0."""
    no_date = F.lit(None).cast("struct<date:string,timestamp:string,precision:string,start:int,end:int>")

    def boundary(at: Column, hint, title, kind, date: Column) -> Column:
        hint, title, kind = (F.lit(x) if isinstance(x, str) else x for x in (hint, title, kind))
        return F.struct(at.cast("int").alias("at"), hint.alias("type_hint"), title.alias("title"), kind.alias("kind"), date.alias("date")).cast(_BOUNDARY)

    def candidate(x: Column, i: Column) -> Column:
        damage = F.when((i > 0) & (x.unusable != F.get(lines, i - 1).unusable), F.when(x.unusable, "damaged_page").otherwise("continuation_after_damaged_page"))
        return F.struct(i.alias("at"), damage.alias("damage"), x.heading.alias("heading"), F.get(visits, i).alias("visit"))

    candidates = F.filter(F.transform(lines, candidate), lambda c: c.damage.isNotNull() | c.heading.isNotNull() | c.visit.isNotNull())

    def accept(found: Column, c: Column) -> Column:
        cut = F.when(c.damage.isNotNull(), F.concat(found, F.array(boundary(c.at, "unknown", "", c.damage, no_date)))).otherwise(found)

        def judged(so_far: Column) -> Column:
            last = F.element_at(so_far, -1)
            again = (last.type_hint == "outpatient") & (_marker(last.date) != "") & (_marker(last.date) != _marker(c.visit.date))
            visit = F.coalesce(c.visit.whole | (again & c.visit.pair), F.lit(False))
            new = F.when(c.heading.isNotNull(), boundary(c.at, c.heading.type_hint, c.heading.title, c.heading.kind, c.heading.date)).when(visit, boundary(c.at, "outpatient", "", "structured_outpatient", c.visit.date))

            def placed(n: Column) -> Column:
                agrees = last.date.eqNullSafe(n.date) | (last.kind != "dated_title") | (n.kind != "dated_title")
                same = (last.type_hint == n.type_hint) & (last.title == n.title) & (n.at - last.at <= NEAR)
                repeated = same & ~last.kind.isin("lab_application", "structured_outpatient") & agrees
                kept = F.when(last.at == n.at, F.slice(so_far, 1, F.size(so_far) - 1)).otherwise(so_far)
                return F.when(n.isNull() | repeated, so_far).otherwise(F.concat(kept, F.array(n)))

            return let(new, placed)

        return let(cut, judged)

    first = F.array(boundary(F.lit(0), "unknown", "", "preamble", no_date))
    return F.aggregate(candidates, first, accept)


def _any(block: Column, test) -> Column:
    return F.exists(block, test)


def _section_type(kind: Column, hint: Column, block: Column) -> Column:
    values = F.filter(F.transform(block, lambda x: x.value), lambda v: v != "")
    header = (kind == "continuation_after_damaged_page") & (F.size(values) <= 8) & F.forall(values, lambda v: v.rlike(HEADER_LINE))
    cover = (F.size(values) <= 4) & F.exists(values, lambda v: v.rlike(f"^{LAB_COVER}$"))
    other = header | F.exists(values, lambda v: v.rlike(NAVIGATION)) | cover
    return F.when(hint != "unknown", hint).when(F.size(values) == 0, "nonclinical").when(kind == "damaged_page", "unknown").when(other, "nonclinical").otherwise("unknown")


def _items(block: Column, items: list[str]) -> Column:
    """The analytes whose labels begin lines of the block."""

    def begins(item: str) -> Column:
        pattern = "(?i)^" + item.replace("-", "\\-") + AFTER_ITEM
        return _any(block, lambda x: x.value.rlike(pattern))

    return F.array_compact(F.array(*(F.when(begins(i), i) for i in items)))


def _subtype(kind: Column, title: Column, text: Column, gas: Column, cardiac: Column, heparin: Column) -> Column:
    def has(x: str) -> Column:
        return title.contains(x)

    in_gas, in_cardiac = gas | has("血气"), (F.size(cardiac) > 0) | title.rlike("(?i)CTNI|BNP|肌钙蛋白")
    in_heparin = heparin | has("肝素")
    several = in_gas.cast("int") + in_cardiac.cast("int") + in_heparin.cast("int") > 1
    ladder = {
        "progress": [
            ("antibiotic_adjustment", has("调整抗生素记录")), ("postop_progress", has("术后") & has("病程")), ("procedure_imaging_progress", has("大型检查") & has("病程")),
            ("initial_progress", has("首次病程")), ("case_discussion", has("病例讨论")), ("critical_round", has("查房") & title.rlike("告病[危重]第?[一二三四五六七八九十\\d]+天")),
            ("first_round", has("查房") & has("首次")), ("round", has("查房")), ("transfer", title.rlike("转[入出]记录")), ("daily_progress", has("日常病程")),
            ("initial_progress", title.isin("病程记录", "病程录") & text.contains("病历特点") & text.contains("鉴别诊断") & text.contains("诊疗计划")),
        ],
        "administrative": [
            ("research_consent", has("生物样本") & has("知情同意")), ("leave_commitment", has(ADMINISTRATIVE_TITLES[0])), ("infection_control_commitment", has(ADMINISTRATIVE_TITLES[1])),
            ("admission_notice", has("入院告知书")), ("condition_communication", title.rlike("谈话记录|病危|病重|病情告知")),
            ("treatment_procedure_consent", has("知情同意书") & ~title.isin("知情同意书", "使用知情同意书")),
        ],
        "procedure": [
            ("bedside_ultrasound", has("床旁超声")), ("preoperative_discussion", title.rlike("术前|术箭") & has("讨论")), ("surgery_record", has("手术记录") & ~title.rlike("^[见⻅]")),
            ("invasive_procedure", has("有创操作") | title.rlike("(?i)穿刺|置管|腰穿|骨穿|PICCO|IABP")), ("procedure", has("操作记录")),
        ],
        "laboratory": [("mixed_panel", several), ("blood_gas", in_gas), ("cardiac_biomarker", in_cardiac), ("anticoagulation_monitoring", in_heparin)],
        "outpatient": [("outpatient_record", F.lit(True))],
        "nonclinical": [
            ("empty_content", strip(text) == ""), ("document_header_only", text.rlike("^上海交通大学医学院附属上海儿童医学中心")), ("web_navigation", text.rlike(NAVIGATION)), ("lab_export_cover", text.rlike(LAB_COVER)),
        ],
    }
    return F.coalesce(*(F.when((kind == k) & hit, name) for k, rules in ladder.items() for name, hit in rules), F.lit(""))


def _title(kind: Column, subtype: Column, title: Column, block: Column, gas: Column, cardiac: Column, heparin: Column) -> Column:
    bare = F.regexp_replace(title, "^[()（）]+|[()（）]+$", "")
    project = F.regexp_replace(strip(F.regexp_extract(title, LAB_APPLICATION, 1)), "[,，]\\s*\\d+(?:\\.\\d+)?元$", "")
    applied = title.rlike(LAB_APPLICATION)
    named = applied & (project != "") & ~project.isin("无数据", "-", "—") & (F.length(project) <= 80)
    content = _any(block, lambda x: x.value.rlike(f"^血浆肝素含量{AFTER_ITEM}"))
    from_items = (
        F.when((subtype == "blood_gas") & gas, "血气分析")
        .when((subtype == "cardiac_biomarker") & (F.size(cardiac) == 1), F.get(cardiac, F.lit(0)))
        .when((subtype == "anticoagulation_monitoring") & heparin & content, "血浆肝素含量")
        .when((subtype == "anticoagulation_monitoring") & heparin, "血浆肝素")
        .otherwise("")
    )
    other = F.when(bare.isin(ADMINISTRATIVE_TITLES), bare).when(kind == "consultation", F.regexp_replace(title, "会诊[単箪]$", "会诊单")).otherwise(title)
    return F.when(kind != "laboratory", other).when(named, project).when(~applied & (title != ""), title).otherwise(from_items)


_CANDIDATE = "array<struct<priority:int,source:string,date:struct<date:string,timestamp:string,precision:string,start:int,end:int>,line:struct<page:long,line:int,text:string,from_ocr:boolean>>>"


def _date(kind: Column, block: Column) -> Column:
    """(chosen candidate or null, flags): the best priority among a dated title, an explicit field and a laboratory's time column."""

    def candidate(priority: int, source: Column, date: Column, x: Column) -> Column:
        line = F.struct(x.page.cast("long").alias("page"), x.line.alias("line"), x.text.alias("text"), x.from_ocr.alias("from_ocr"))
        return F.struct(F.lit(priority).alias("priority"), source.alias("source"), date.alias("date"), line.alias("line"))

    headed = F.filter(F.slice(block, 1, 20), lambda x: F.coalesce(x.heading.kind == "dated_title", F.lit(False)))
    titles = F.transform(headed, lambda x: candidate(0, F.lit("title_timestamp"), F.get(x.dates, F.lit(0)), x))

    def explicit(x: Column) -> Column:
        name = F.regexp_extract(x.value, FIELD, 1)
        wrong = (
            ((name == "出院日期") & (kind != "discharge")) | (name.startswith("检查") & ~kind.isin("ultrasound", "laboratory")) | ((name == "就诊日期") & (kind != "outpatient"))
            | (name.startswith("会诊") & (kind != "consultation")) | (name.rlike("^【?讨论") & ~kind.isin("procedure", "progress"))
        )
        return x.value.rlike(FIELD) & (F.length(x.value) <= 90) & (F.size(x.dates) == 1) & ~wrong

    fields = F.transform(F.filter(block, explicit), lambda x: candidate(1, F.concat(F.lit("explicit_field:"), F.regexp_extract(x.value, FIELD, 1)), F.get(x.dates, F.lit(0)), x))
    column = F.array_position(F.transform(block, lambda x: x.value.contains("检验时间")), True).cast("int")
    below = F.when((kind == "laboratory") & (column > 0), F.slice(block, column, F.size(block))).otherwise(F.slice(block, 1, 0))
    alone = F.transform(F.filter(below, lambda x: x.alone & ~x.margin), lambda x: candidate(2, F.lit("test_timestamp_column"), F.get(x.dates, F.lit(0)), x))

    def without_time(c: Column) -> Column:
        return c.withField("date.timestamp", F.lit("")).withField("date.precision", F.lit("day"))

    def tested(rows: Column) -> Column:
        times = F.array_distinct(F.transform(rows, lambda c: c.date.timestamp))
        return F.struct(
            F.size(F.array_distinct(F.transform(rows, lambda c: c.date.date))).alias("days"),
            F.transform(F.slice(rows, 1, 1), lambda c: F.when(F.size(times) > 1, without_time(c)).otherwise(c)).alias("first"),
        )

    empty = F.lit(None).cast(_CANDIDATE).getItem(0)

    def choose(found: Column) -> Column:
        every, test = found.every, found.test
        best = F.filter(every, lambda c: c.priority == F.array_min(F.transform(every, lambda e: e.priority)))

        def judged(b: Column) -> Column:
            first = F.get(b, F.lit(0))
            times = F.size(F.array_distinct(F.filter(F.transform(b, lambda c: c.date.timestamp), lambda t: t != ""))) > 1
            differs = F.exists(every, lambda c: (c.priority > first.priority) & (c.date.date != first.date.date))
            flags = F.array_compact(F.array(F.when(times, "conflicting_document_times"), F.when(differs, "secondary_date_differs"), F.when(first.line.from_ocr, "date_requires_review")))
            chosen = F.when(times, without_time(first)).otherwise(first)
            several = F.size(F.array_distinct(F.transform(b, lambda c: c.date.date))) > 1
            blank = F.struct(empty.alias("chosen"), F.array(F.lit("unknown_date"), F.lit("conflicting_document_dates")).alias("flags"))
            return F.when(several, blank).otherwise(F.struct(chosen.alias("chosen"), flags.alias("flags")))

        none = F.struct(empty.alias("chosen"), F.array(F.lit("unknown_date")).alias("flags"))
        clash = F.struct(empty.alias("chosen"), F.array(F.lit("unknown_date"), F.lit("conflicting_test_dates")).alias("flags"))
        return F.when(found.barred, none).when(test.days > 1, clash).when(F.size(every) == 0, none).otherwise(let(best, judged))

    barred = kind.isin(UNCLEAR) | _any(block, lambda x: x.unusable)

    def gathered(test: Column) -> Column:
        every = F.concat(titles, fields, F.when(test.days == 1, test.first).otherwise(F.slice(test.first, 1, 0)))
        return let(F.struct(barred.alias("barred"), test.alias("test"), every.alias("every")), choose)

    return let(let(alone, tested), gathered)


def role(value: Column, start: Column) -> Column:
    """What a date in a text is the date of, by the 20 characters before it."""
    low = F.greatest(start - 20, F.lit(0))
    before = F.substring(value, low + 1, start - low)
    return F.coalesce(*(F.when(before.contains(needle), name) for needle, name in ROLES), F.lit("content_mention"))


def _mentions(block: Column) -> Column:
    def of(x: Column) -> Column:
        return F.transform(x.dates, lambda d: F.struct(
            d.date.alias("date"), d.timestamp.alias("timestamp"), d.precision.alias("precision"), x.page.cast("long").alias("page"), x.line.alias("line"), x.text.alias("evidence"),
            F.when(x.margin, "print").otherwise(role(x.value, d.start)).alias("role"),
        ))

    return F.flatten(F.transform(block, of))


def _spans(block: Column) -> Column:
    """[(page, start_line, end_line)]: the part of each page that a section covers."""

    def span(p: Column) -> Column:
        own = F.transform(F.filter(block, lambda x: x.page == p), lambda x: x.line)
        return F.struct(p.cast("long").alias("page"), F.array_min(own).alias("start_line"), F.array_max(own).alias("end_line"))

    return F.transform(F.array_distinct(F.transform(block, lambda x: x.page)), span)


def sections(pages: DataFrame) -> DataFrame:
    """Sections of documents from their pages (see document_lines)."""
    docs = document_lines(pages).withColumn("visits", _visits(F.col("lines")))
    docs = docs.withColumn("cuts", _boundaries(F.col("lines"), F.col("visits")))

    def cut(b: Column, i: Column) -> Column:
        end = F.coalesce(F.get("cuts", i + 1).at, F.size("lines"))
        return F.struct((i + 1).alias("ordinal"), b.alias("head"), F.slice("lines", b.at + 1, end - b.at).alias("block"))

    rows = docs.select("document_id", "patient_id", "source_pdf", F.explode(F.transform("cuts", cut)).alias("s"))
    rows = rows.select("document_id", "patient_id", "source_pdf", "s.ordinal", "s.head", "s.block")
    block, head = F.col("block"), F.col("head")
    rows = rows.withColumns({"section_type": _section_type(head.kind, head.type_hint, block), "text": F.array_join(F.transform(block, lambda x: x.text), "\n")})
    kind, text = F.col("section_type"), F.col("text")
    rows = rows.withColumns({"_gas": _items(block, GAS_ITEMS), "_cardiac": _items(block, CARDIAC_ITEMS), "_heparin": _any(block, lambda x: x.value.rlike(f"^血浆肝素(?:含量)?{AFTER_ITEM}")), "_d": _date(kind, block)})
    gas = F.array_contains("_gas", "PaCO2") & F.array_contains("_gas", "PaO2") & (F.size("_gas") >= 4)
    rows = rows.withColumn("section_subtype", _subtype(kind, head.title, text, gas, F.col("_cardiac"), F.col("_heparin")))
    rows = rows.withColumn("section_title", _title(kind, F.col("section_subtype"), head.title, block, gas, F.col("_cardiac"), F.col("_heparin")))
    chosen, ocr = F.col("_d.chosen"), F.col("_d.chosen.line.from_ocr")
    day = F.coalesce(chosen.date.date, F.lit(""))
    more = [
        (~kind.isin(["x"]) & (kind == "unknown"), "unknown_document_type"), (_any(block, lambda x: x.unusable), "unusable_text_layer"), (_any(block, lambda x: x.from_ocr), "ocr_unverified"),
        (head.kind == "continuation_after_damaged_page", "continuation_after_damaged_page"),
    ]
    flags = F.array_sort(F.array_distinct(F.concat(F.col("_d.flags"), F.array_compact(F.array(*(F.when(c, f) for c, f in more))))))
    rows = rows.withColumns({"flags": flags, "mentioned_dates": _mentions(block)})
    leaks = F.array_compact(F.array(F.when(kind.isin("procedure", "discharge"), "outcome_information_possible"), F.when(text.rlike(POSTOPERATIVE), "postoperative_or_treatment_mention")))
    title = F.col("section_title")
    stage = F.when(title.contains("术前"), "preoperative").when(title.contains("术后"), "postoperative").when(kind == "discharge", "discharge").otherwise("unknown")
    out = rows.select(
        F.concat("document_id", F.lit("_s"), F.lpad(F.col("ordinal").cast("string"), 4, "0")).alias("section_id"), "document_id", "patient_id", "source_pdf", "ordinal", "section_type", "section_subtype", "section_title",
        day.alias("section_date"), day.alias("document_date"), F.coalesce(chosen.date.timestamp, F.lit("")).alias("document_timestamp"),
        F.when(chosen.isNull(), "unknown").otherwise(F.concat(F.when(ocr, "local_ocr:").otherwise(""), chosen.source)).alias("date_source"), F.coalesce(chosen.date.precision, F.lit("unknown")).alias("date_precision"),
        F.coalesce(chosen.line.text, F.lit("")).alias("date_evidence"), chosen.line.page.alias("date_page"), chosen.line.line.alias("date_line"), chosen.isNull().alias("date_uncertain"),
        F.get("block", F.lit(0)).page.cast("long").alias("page_start"), F.element_at("block", -1).page.cast("long").alias("page_end"), F.get("block", F.lit(0)).line.alias("line_start"), F.element_at("block", -1).line.alias("line_end"),
        _spans(block).alias("page_spans"), "text", "mentioned_dates", "flags",
        F.when(F.array_contains("flags", "unusable_text_layer"), "unusable_text_layer").when(F.size("flags") > 0, "uncertain").otherwise("ok").alias("parse_status"),
        stage.alias("clinical_stage"), leaks.alias("leakage_flags"), head.kind.alias("segmentation_rule"),
    )
    return _filename_dates(out)


def _filename_dates(found: DataFrame) -> DataFrame:
    """The one date of a file's name dates its only recognised section, if that has no date of its own; it stays uncertain.
    A document's sections are counted by a window over rows that already lie together."""
    from pyspark.sql import Window

    stem = F.regexp_replace(F.regexp_extract("source_pdf", "([^/\\\\]*)$", 1), "\\.[^.]*$", "")
    named = F.flatten(F.transform(F.regexp_extract_all(stem, F.lit(FILENAME_DATE), F.lit(0)), dates.stamps))
    clear = ~F.col("section_type").isin(UNCLEAR)
    n = F.count_if(clear).over(Window.partitionBy("document_id"))
    rows = found.withColumns({"_n": n, "_named": named})
    use = clear & (F.col("_n") == 1) & (F.size("_named") == 1) & (F.col("section_date") == "") & (F.size("mentioned_dates") == 0)
    day = F.get("_named", F.lit(0)).date
    rows = rows.withColumn("_use", use)
    new = {
        "section_date": day, "document_date": day, "date_source": F.lit("filename"), "date_precision": F.lit("day"), "date_evidence": F.regexp_extract("source_pdf", "([^/\\\\]*)$", 1),
        "flags": F.array_sort(F.array_distinct(F.concat("flags", F.array(F.lit("filename_date_unconfirmed"))))), "date_uncertain": F.lit(True),
    }
    return rows.withColumns({c: F.when(F.col("_use"), v).otherwise(F.col(c)) for c, v in new.items()}).drop("_n", "_named", "_use")


def with_page_facts(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Sections with text_source, date_requires_review, date_evidence_confidence and parse_status from the pages they span
    (document_id, page, extraction_status, and where there are any normalized_text_source, normalized_line_map, ocr_lines)."""
    given = set(pages.columns)
    source = F.coalesce("normalized_text_source", F.lit("pdf_text_layer")) if "normalized_text_source" in given else F.lit("pdf_text_layer")
    confidence = F.lit(None).cast("array<double>")
    if {"ocr_lines", "normalized_line_map"} <= given:
        confidence = F.transform("normalized_line_map", lambda n: F.get("ocr_lines", n - 1).confidence)
    facts = pages.select("document_id", "page", F.coalesce("extraction_status", F.lit("ok")).alias("_status"), source.alias("_source"), confidence.alias("_confidence"))
    spans = found.select("document_id", "section_id", "date_page", "date_line", F.explode("page_spans.page").alias("page"))
    at = F.when(F.col("page") == F.col("date_page"), F.get("_confidence", F.col("date_line") - 1))
    bad = F.col("_status").isin(UNUSABLE)
    per = spans.join(facts, ["document_id", "page"]).groupBy("document_id", "section_id").agg(F.collect_set("_source").alias("_sources"), F.bool_or(bad).alias("_bad"), F.max(at).alias("_at"))
    out = found.join(per, ["document_id", "section_id"], "left")
    review = F.col("date_source").startswith("local_ocr:")
    low = review & F.coalesce(F.col("_at") < 0.8, F.lit(False))
    return out.withColumns({
        "text_source": F.when(F.size("_sources") == 1, F.get("_sources", F.lit(0))).otherwise("mixed"), "date_requires_review": review, "date_evidence_confidence": F.when(review, F.col("_at")),
        "date_uncertain": F.col("date_uncertain") | low, "flags": F.when(low, F.concat("flags", F.array(F.lit("low_confidence_ocr_date")))).otherwise(F.col("flags")),
        "parse_status": F.when(F.col("_bad"), "partial").otherwise(F.col("parse_status")), "leakage_risk": F.when(F.size("leakage_flags") > 0, "flagged").otherwise("unreviewed"),
    }).drop("_sources", "_bad", "_at")


def mentions(found: DataFrame) -> DataFrame:
    """One row for each date in a section, with its role and whether it dates the section."""
    each = found.select("patient_id", "document_id", "section_id", "date_page", "date_line", F.explode("mentioned_dates").alias("m")).select("*", "m.*")
    dating = F.coalesce((F.col("page") == F.col("date_page")) & (F.col("line") == F.col("date_line")), F.lit(False))
    return each.withColumn("is_document_date_evidence", dating).drop("m", "date_page", "date_line")


def documents(found: DataFrame) -> DataFrame:
    """(document_id, document_type, document_date, date_status, earliest and latest reliable section date, n_sections)."""
    clear = F.when(~F.col("section_type").isin(UNCLEAR), F.col("section_type"))
    sure = F.when((F.col("section_date") != "") & ~F.col("date_uncertain"), F.col("section_date"))
    per = found.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("n_sections"), F.count_distinct(clear).alias("_n"), F.min(clear).alias("_one"), F.bool_and(F.col("section_type") == "nonclinical").alias("_none"),
        F.min(sure).alias("_first"), F.max(sure).alias("_last"),
    )
    date = F.when(F.col("n_sections") == 1, F.coalesce("_first", F.lit(""))).otherwise("")
    return per.select(
        "document_id", F.when(F.col("_n") == 1, F.col("_one")).when(F.col("_n") > 1, "mixed").when(F.col("_none"), "nonclinical").otherwise("unknown").alias("document_type"), date.alias("document_date"),
        F.when(date != "", "single_section").when(F.col("n_sections") > 1, "multiple_sections").otherwise("unknown").alias("date_status"),
        F.coalesce("_first", F.lit("")).alias("earliest_section_date"), F.coalesce("_last", F.lit("")).alias("latest_section_date"), "n_sections",
    )


def coverage(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(document_id, page, nonempty_lines, uncovered_lines, overlapping_lines): a page's lines against the sections' spans."""
    spans = found.select("document_id", F.explode("page_spans").alias("s")).select("document_id", "s.*").groupBy("document_id", "page").agg(F.collect_list(F.struct("start_line", "end_line")).alias("spans"))
    both = pages.select("document_id", F.col("page").cast("long").alias("page"), "normalized_text").join(spans, ["document_id", "page"], "left")
    split = F.split(F.coalesce("normalized_text", F.lit("")), "\n")
    full = F.filter(F.transform(split, lambda x, i: F.struct((strip(x) != "").alias("full"), (i + 1).alias("line"))), lambda x: x.full)
    hits = F.transform(full, lambda x: F.size(F.filter(F.coalesce("spans", F.array().cast("array<struct<start_line:int,end_line:int>>")), lambda s: (s.start_line <= x.line) & (x.line <= s.end_line))))
    counted = both.select("document_id", "page", hits.alias("hits"))
    return counted.select("document_id", "page", F.size("hits").alias("nonempty_lines"), F.size(F.filter("hits", lambda h: h == 0)).alias("uncovered_lines"), F.size(F.filter("hits", lambda h: h > 1)).alias("overlapping_lines"))


def all_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)

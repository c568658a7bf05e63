"""Whether a subject's records show the finding that the cohort is about: signals, origin facts, judgment and review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.functions.dates import places
from sparkfolio.functions.ids import stable_id
from sparkfolio.operators.review import reasons
from sparkfolio.operators.rules import Rule, matches, window

# --- fixed values: vocabulary of the finding ---
UNCERTAIN = "可能|疑似|待排|待查|不能除外|不除外|考虑|显示不清|[?？]"
NORMAL_ORIGIN = "(?i)(左右冠(?:状动脉|脉)|右冠(?:状动脉|脉)?|左冠(?:状动脉|脉)?|RCA|LCA|LMCA).{0,10}(?:起源|开[口又]).{0,8}(?:正常|未见(?:明显)?异常)"
ORIGIN_FACT = (
    "(?i)(左右冠(?:状动脉|脉)|左、右冠(?:状动脉|脉)|右冠状动脉|右冠脉|右冠|RCA|左冠状动脉|左冠脉|左冠|左主干|LCA|LMCA|LM|回旋支|左回旋支|LCX|前降支|左前降支|LAD)"
    "[^。；;:\\n]{0,18}?(?:异常)?(?:起源于?|起自|发自|源自|开[口又]于?|来自)\\s*"
    "(左冠状动脉窦|右冠状动脉窦|左冠窦|右冠窦|左瓣窦|右瓣窦|无冠窦|肺动脉主干|主肺动脉|肺动脉|升主动脉|左主干|左冠状动脉|左冠脉|左冠|左前降支|前降支|LAD|右冠状动脉|右冠脉|右冠)"
)
ENGLISH_ORIGIN = "(?i)(RCA|LCA|LMCA|LM|LCX|LAD).{0,24}?(?:anom\\.?\\s*)?(?:origin(?:ates|ating)?|from).{0,12}(left|right|noncoronary)\\s*(?:coronary\\s*)?sinus"
RULES = [
    Rule("aaoca_literal", "aaoca_term", "(?i)(?<![A-Z])(?:AAOCA|AOCA|ACAOS)(?![A-Z])", "decisive"),
    Rule("formal_origin_anomaly", "formal_origin_anomaly", "冠(?:状动脉|脉)(?:异常主动脉起源|主动脉异常起源|起源异常|异常起源|异位起源)|冠(?:状动脉|脉)(?:起源|开[口又])\\s*(?:畸形|异常)", "decisive"),
    Rule("generic_coronary_anomaly", "generic_coronary_anomaly", "(?:先天性)?冠(?:状动脉|脉)(?:畸形|异常)(?:-其他)?", "supporting"),
    Rule("pulmonary_origin_acronym", "pulmonary_coronary_origin", "(?i)(?<![A-Z])(?:ALCAPA|ARCAPA|ACAPA)(?![A-Z])", "decisive"),
    Rule("single_coronary", "single_coronary_or_complex_chd", "单(?:一|支)?(?:左|右)?冠(?:状动脉|脉)|冠(?:状动脉|脉)[(（]单支[)）]", "decisive"),
    Rule("high_origin", "high_coronary_origin", "(?:左|右)?冠(?:状动脉|脉).{0,10}高位(?:起源|开[口又])|(?:左|右)?冠(?:状动脉|脉)高位", "supporting"),
    Rule("high_risk_course", "intramural_or_interarterial_course", "(?i)(?:左|右)?冠(?:状动脉|脉|冠).{0,40}(?:壁内走[行形]|壁间走[行形]|主[-—]?肺动脉.{0,8}(?:间|之间))|(?:壁内走[行形]|壁间走[行形]).{0,24}(?:冠状动脉|冠脉|RCA|LCA)", "decisive"),
    Rule("aaoca_repair", "aaoca_specific_procedure", "(?i)冠(?:状动脉|脉)(?:异常起源|起源异常)?(?:纠治|矫正|修补|开[口又]成形|移植|再植|去顶)(?:术)?|(?:左|右)?冠(?:状动脉|冠脉)去顶|(?:AAOCA|AOCA).{0,10}(?:矫治|纠治|修补)", "decisive"),
    Rule("targeted_workup", "targeted_coronary_workup", "(?i)(?:冠脉CTA|冠状动脉CTA|CCTA|冠脉造影|冠状动脉造影|多根导管冠状动脉造影)|(?:心脏|胸主动脉)(?:增强)?CT.{0,50}(?:冠(?:状动脉|脉).{0,12}(?:起源|开[口又]))", "context"),
    Rule("explicit_exclusion", "explicit_exclusion", "(?i)(?:排除|除外|不支持|未提示|未发现|未见)(?:.{0,16})(?:AAOCA|冠(?:状动脉|脉)(?:起源异常|异常起源|异常主动脉起源))", "decisive"),
    Rule("normal_origin", "normal_coronary_origin", NORMAL_ORIGIN, "context"),
]
CLINICAL = ["admission", "progress", "consultation", "discharge", "outpatient", "procedure", "surgery_related", "follow_up", "ultrasound"]
POSITIVE = ["aaoca_term", "formal_origin_anomaly", "specific_abnormal_origin", "pulmonary_coronary_origin", "coronary_branch_origin", "generic_coronary_anomaly", "single_coronary_or_complex_chd",
            "high_coronary_origin", "intramural_or_interarterial_course", "aaoca_specific_procedure", "explicit_exclusion"]
DETAIL = ["aaoca_term", "specific_abnormal_origin", "pulmonary_coronary_origin", "coronary_branch_origin", "single_coronary_or_complex_chd", "intramural_or_interarterial_course", "aaoca_specific_procedure", "explicit_exclusion"]
ORDER = ["specific_abnormal_origin", "pulmonary_coronary_origin", "coronary_branch_origin", "normal_coronary_origin", "expected_coronary_origin", "single_coronary_or_complex_chd", "aaoca_term", "formal_origin_anomaly",
         "aaoca_specific_procedure", "intramural_or_interarterial_course", "high_coronary_origin", "explicit_exclusion", "generic_coronary_anomaly", "targeted_coronary_workup"]
# --- end of fixed values ---
ENOUGH = 1000


def subject(value: Column) -> Column:
    upper = F.upper(value)
    return (
        F.when(value.rlike("左右|左、右"), "both").when(value.contains("回旋") | (upper == "LCX"), "left_circumflex").when(value.contains("前降") | (upper == "LAD"), "left_anterior_descending")
        .when(value.contains("右") | (upper == "RCA"), "right_coronary").when(value.contains("左") | upper.isin("LCA", "LM", "LMCA"), "left_coronary").otherwise("coronary_unspecified")
    )


def origin(value: Column) -> Column:
    low = F.lower(value)
    ladder = [
        (value.contains("肺动脉"), "pulmonary_artery"), (value.contains("无冠") | low.contains("noncoronary"), "noncoronary_sinus"),
        (value.rlike("左冠窦|左瓣窦") | (low == "left") | (low.contains("left") & low.contains("sinus")), "left_sinus"),
        (value.rlike("右冠窦|右瓣窦") | (low == "right") | (low.contains("right") & low.contains("sinus")), "right_sinus"),
        (value.contains("升主动脉"), "ascending_aorta"), (value.contains("前降") | (F.upper(value) == "LAD"), "left_anterior_descending"), (value.contains("左主干"), "left_main"),
        (value.isin("左冠状动脉", "左冠脉"), "left_coronary"), (value == "左冠", "left_sinus"), (value.isin("右冠状动脉", "右冠脉"), "right_coronary"), (value == "右冠", "right_sinus"),
    ]
    return F.coalesce(*(F.when(hit, name) for hit, name in ladder), F.lit("other"))


def expected(who: Column, where: Column) -> Column:
    return ((who == "right_coronary") & (where == "right_sinus")) | (who.isin("left_coronary", "left_circumflex", "left_anterior_descending") & (where == "left_sinus"))


def _signals(text: Column) -> Column:
    """[(ord, rule_id, category, strength, target, origin, start, end)] of a text, fixed rules before origin facts."""

    def signal(n: int, rule_id: str, category: Column, strength: Column, target: Column, where: Column, m: Column) -> Column:
        return F.struct(F.lit(n).alias("ord"), F.lit(rule_id).alias("rule_id"), category.alias("category"), strength.alias("strength"), target.alias("target"), where.alias("origin"), m.start.alias("start"), m.end.alias("end"))

    def of(n: int, r: Rule) -> Column:
        def one(m: Column) -> Column:
            target = subject(F.regexp_extract(m.mention, NORMAL_ORIGIN, 1)) if r.rule_id == "normal_origin" else F.lit("coronary_unspecified")
            return signal(n, r.rule_id, F.lit(r.category), F.lit(r.strength), target, F.lit(""), m)

        return F.transform(matches(text, Rule(r.rule_id, r.category, r.pattern, r.strength, most=2)), one)

    def facts(n: int, rule_id: str, pattern: str) -> Column:
        def one(m: Column) -> Column:
            who, raw = subject(F.regexp_extract(m.mention, pattern, 1)), origin(F.regexp_extract(m.mention, pattern, 2))
            left = F.when(raw == "left_coronary", "left_sinus").otherwise(raw)  # "both" takes the left one first and goes on from what it has made
            pairs = F.when(who == "both", F.array(F.struct(F.lit("left_coronary").alias("who"), left.alias("where")), F.struct(F.lit("right_coronary").alias("who"), F.when(left == "right_coronary", "right_sinus").otherwise(left).alias("where"))))
            own = F.when((who == "right_coronary") & (raw == "right_coronary"), "right_sinus").when(who.isin("left_coronary", "left_circumflex", "left_anterior_descending") & (raw == "left_coronary"), "left_sinus").otherwise(raw)
            pairs = pairs.otherwise(F.array(F.struct(who.alias("who"), own.alias("where"))))

            def typed(p: Column) -> Column:
                branch = p.where.isin("left_main", "left_anterior_descending", "left_coronary", "right_coronary")
                usual = ~branch & expected(p.who, p.where)
                category = F.when(p.where == "pulmonary_artery", "pulmonary_coronary_origin").when(branch, "coronary_branch_origin").when(usual, "expected_coronary_origin").otherwise("specific_abnormal_origin")
                return signal(n, rule_id, category, F.when(usual, "context").otherwise("decisive"), p.who, p.where, m)

            return F.transform(pairs, typed)

        none = F.array().cast("array<struct<mention:string,start:int,end:int>>")
        return F.flatten(F.transform(F.when(text.rlike(pattern), places(text, pattern)).otherwise(none), one))

    fixed = [of(n, r) for n, r in enumerate(RULES)]
    return F.concat(*fixed, facts(len(RULES), "specific_origin", ORIGIN_FACT), facts(len(RULES) + 1, "english_specific_origin", ENGLISH_ORIGIN))


def _squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def signals(sections: DataFrame) -> DataFrame:
    """One row for each (section, rule, category, target, origin), the first of its matches; facts (origin not '') keep all."""
    rows = sections.withColumn("_x", F.explode(_signals(F.col("text")))).select("*", "_x.*").drop("_x")
    near = _squeezed(window(F.col("text"), F.col("start"), F.col("end"), 35, 35))
    sure = F.when(F.col("category").isin("normal_coronary_origin", "explicit_exclusion"), "normal_or_excluded").when(near.rlike(UNCERTAIN), "uncertain").otherwise("affirmed")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("patient_id", "document_id", "section_id", "rule_id")]
    rows = rows.withColumns({
        "assertion": sure, "evidence_id": stable_id("ev_", 16, *parts, F.col("start").cast("string"), F.col("end").cast("string"), separator="|"),
        "evidence_text": _squeezed(window(F.col("text"), F.col("start"), F.col("end"), 110, 110)),
    })
    first = Window.partitionBy("section_id", "rule_id", "category", "target", "origin").orderBy("start")
    return rows.withColumn("is_first", F.row_number().over(first) == 1).drop("text")


def judge(manifest: DataFrame, sections: DataFrame, found: DataFrame) -> DataFrame:
    """(patient_id, judgment, reasons, priority, counts) of every subject of the manifest (patient_id, n_pdf)."""
    positive = F.col("category").isin(POSITIVE)
    clinical = F.col("section_type").isin(CLINICAL)
    first = found.where("is_first")
    fact, affirmed = F.col("origin") != "", F.col("assertion") == "affirmed"
    precise = ~F.col("origin").isin("ascending_aorta", "other")
    normal = F.col("category") == "normal_coronary_origin"
    per = first.groupBy("patient_id").agg(
        F.count_if(positive).alias("n_positive"), F.count_if(positive & clinical).alias("n_clinical"), F.count_if(positive & affirmed).alias("n_affirmed"),
        F.count_if(positive & (F.col("assertion") == "uncertain")).alias("n_uncertain"), F.count_distinct(F.when(positive, F.col("section_id"))).alias("n_sections_positive"),
        F.array_sort(F.collect_set(F.when(positive, F.col("category")))).alias("categories"), F.count_if(normal).alias("n_normal"),
        F.count_if(positive & ~F.coalesce(F.col("text_source"), F.lit("")).startswith("local_ocr")).alias("n_not_ocr"),
        F.flatten(F.collect_set(F.when(normal, F.when(F.col("target") == "both", F.array(F.lit("left_coronary"), F.lit("right_coronary"))).otherwise(F.array("target"))))).alias("normal_targets"),
    )
    facts = found.where(fact)
    origins = facts.where(affirmed & precise).groupBy("patient_id", "target").agg(F.count_distinct("origin").alias("n"), F.bool_or(~expected(F.col("target"), F.col("origin"))).alias("abnormal"))
    origins = origins.groupBy("patient_id").agg(F.count_if(F.col("n") > 1).alias("n_conflicts"), F.collect_set(F.when(F.col("abnormal"), F.col("target"))).alias("abnormal_targets"))
    any_fact = facts.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_facts"))
    text = sections.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_sections"), F.count_if(clinical).alias("n_clinical_sections"), F.sum(F.when(clinical, F.length("text")).otherwise(0)).alias("clinical_chars"))
    rows = manifest.select("patient_id", "n_pdf")
    for part in (per, origins, any_fact, text):
        rows = rows.join(part, "patient_id", "left")
    rows = rows.fillna(0).withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("categories", "normal_targets", "abnormal_targets")})
    pos, clin = F.col("n_positive") > 0, F.col("n_clinical") > 0
    said = F.when(pos & clin, "yes").when(pos, "uncertain").when((F.col("clinical_chars") >= ENOUGH) & (F.col("n_clinical_sections") > 0), "no").otherwise("uncertain")
    rows = rows.withColumn("judgment", said)
    tentative = (F.col("n_uncertain") > 0) & (F.col("n_affirmed") == 0)

    def some(*names: str) -> Column:
        return F.arrays_overlap("categories", F.array(*(F.lit(n) for n in names)))

    detail = some(*DETAIL)
    early = [
        ("missing_source_documentation", (F.col("n_pdf") == 0) | (F.col("n_sections") == 0)), ("evidence_only_in_nonclinical_or_laboratory_content", pos & ~clin),
        ("single_evidence_section", pos & (F.col("n_sections_positive") == 1) & (~clin | tentative | ~detail)), ("tentative_evidence_only", pos & tentative),
    ]
    none_yet = ~(early[0][1] | early[1][1] | early[2][1] | early[3][1])
    specific = some("aaoca_term", "specific_abnormal_origin", "pulmonary_coronary_origin", "coronary_branch_origin", "intramural_or_interarterial_course", "aaoca_specific_procedure")
    why = reasons([
        *early, ("no_meaningful_aaoca_evidence_in_adequate_record", F.col("judgment") == "no"), ("insufficient_evidence_for_reliable_judgment", (F.col("judgment") == "uncertain") & none_yet),
        ("conflicting_coronary_origin_descriptions", F.col("n_conflicts") > 0), ("normal_and_abnormal_origin_same_vessel", F.arrays_overlap("normal_targets", "abnormal_targets")),
        ("pulmonary_origin_scope_boundary", some("pulmonary_coronary_origin")), ("single_coronary_or_complex_chd_scope_boundary", some("single_coronary_or_complex_chd", "coronary_branch_origin")),
        ("high_origin_without_more_specific_anatomy", some("high_coronary_origin") & ~specific), ("normal_origin_and_nonspecific_positive_label", (F.col("n_normal") > 0) & pos & (F.col("n_facts") == 0)),
        ("sparse_nonspecific_label", pos & ~detail & (F.col("n_sections_positive") <= 2)), ("sparse_ocr_only_evidence", pos & (F.col("n_not_ocr") == 0) & (F.col("n_sections_positive") <= 2)),
    ])
    rows = rows.withColumn("reasons", why)
    high = F.exists("reasons", lambda r: r.rlike("conflict|scope_boundary"))
    rows = rows.withColumn("priority", F.when(F.col("judgment") != "yes", "required").when(high, "high").otherwise("medium"))
    return rows.select("patient_id", "judgment", "reasons", "priority", "n_pdf", F.col("n_positive").alias("n_evidence_rows"), F.col("n_sections_positive").alias("n_evidence_sections"), "n_clinical_sections", "categories")


def queue(judged: DataFrame) -> DataFrame:
    """Subjects with a reason for review, the most pressing first."""
    rank = F.when(F.col("priority") == "required", 0).when(F.col("priority") == "high", 1).otherwise(2)
    return judged.where(F.size("reasons") > 0).orderBy(rank, "patient_id")


def review_evidence(found: DataFrame, queued: DataFrame, each: int = 2, most: int = 12) -> DataFrame:
    """At most `most` signals of each queued subject, and `each` of one meaning."""
    rows = found.where("is_first").where(F.col("category").isin([*POSITIVE, "normal_coronary_origin", "targeted_coronary_workup", "expected_coronary_origin"])).join(queued.select("patient_id"), "patient_id", "left_semi")
    rank = F.coalesce(*(F.when(F.col("category") == c, n) for n, c in enumerate(ORDER)), F.lit(99))
    day = F.when(F.coalesce("section_date", F.lit("")) == "", "9999-99-99").otherwise(F.col("section_date"))
    order = [rank, F.when(F.col("assertion") == "affirmed", 0).otherwise(1), day, F.col("section_id"), F.col("ord"), F.col("start")]
    rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy("patient_id", "category", "assertion", "target", "origin").orderBy(*order))).where(F.col("_k") <= each)
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy("patient_id").orderBy(*order))).where(F.col("_k") <= most).drop("_k")


def summaries(found: DataFrame, most: int = 3) -> DataFrame:
    """(patient_id, relevant_evidence_summary): the strongest signals in a line, positive ones or else normal ones."""
    positive = F.col("category").isin(POSITIVE)
    rows = found.where("is_first").where(positive | (F.col("category") == "normal_coronary_origin")).withColumn("_pos", positive)
    rows = rows.withColumn("_any", F.max(F.col("_pos").cast("int")).over(Window.partitionBy("patient_id"))).where((F.col("_any") == 0) | F.col("_pos"))
    strength = F.when(F.col("strength") == "decisive", 0).when(F.col("strength") == "supporting", 1).otherwise(2)
    day = F.when(F.coalesce("section_date", F.lit("")) == "", "9999-99-99").otherwise(F.col("section_date"))
    rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy("patient_id").orderBy(strength, F.when(F.col("assertion") == "affirmed", 0).otherwise(1), day, "section_id", "ord", "start"))).where(F.col("_k") <= most)
    line = F.concat(F.lit("["), "category", F.lit("/"), "assertion", F.lit("] "), "evidence_text")
    return rows.groupBy("patient_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", line.alias("t")))), lambda x: x.t), " || ").alias("relevant_evidence_summary"))

"""Pages to sections: dates, boundaries, types, titles and spans on small synthetic documents."""

import pytest

from sparkfolio.functions import text
from sparkfolio.operators import segment

PAGE = "document_id string, page int, normalized_text string, extraction_status string, flags array<string>, analysis_text_source string, source_pdf string, removed_lines array<struct<raw_line:int,text:string,reason:string>>"


@pytest.fixture(scope="module")
def cut(spark):
    """Sections of many documents at once: {name: [rows]}."""

    def page(doc, n, content, status="ok", source="pdf_text_layer", pdf="x.pdf", removed=()):
        return (doc, n, content, status, [], source, pdf, list(removed))

    lab = "检验报告\n申请项目:血气分析,45元\n检验时间\n"
    rows = [
        page("no_date", 1, "2025/1/1 10:30\n 手术记录\n入院记录\n出生日期:2020-01-01\n入院日期:2024-12-02"),
        page("two_pages", 1, "导航\n2024-01-02 08:30 日常病程\n正文甲"), page("two_pages", 2, "正文乙\n2024-01-03 09:15 手术记录\n正文丙"),
        page("lab_conflict", 1, "申请项目:心肌标志物\n检验时间\n2024-01-02 08:00\n2024-01-03 08:00"),
        page("lab_times", 1, "申请项目:心肌标志物\n检验时间\n2024-01-02 08:00\n2024-01-02 09:00"),
        page("damaged", 1, "2024-01-02 08:30 日常病程\n正文"), page("damaged", 2, "乱码", "text_layer_unusable"), page("damaged", 3, "2024-01-05 10:00 日常病程"),
        page("repeated", 1, "手术记录\n姓名:合成样本\n2024-01-02 08:30 手术记录\n正文"),
        page("two_dates", 1, "手术记录\n记录日期:2024-01-02\n记录时间:2024-01-03"),
        page("two_times", 1, "手术记录\n记录日期:2024-01-02 08:00\n记录时间:2024-01-02 09:00"),
        page("empty", 1, "", "empty"),
        page("ocr", 1, "2024-01-02 08:30 日常病程", "empty", "local_ocr"),
        page("printed", 1, "2024-05-01 10:00\n申请项目:血气\n检验时间\n2024-01-02 08:00", removed=[(1, "u", "browser_or_navigation_url")]),
        page("joined", 1, "2024-01-0213:30 日常病程\n正文"), page("short_day", 1, "2024-01-213:30 日常病程\n正文"),
        page("labs", 1, "● 申请项目:CTNI,20元\nCTNI 0.1\n申请项目:血气分析\npH 7.3\nPaCO2 40\nPaO2 90\nLac 1\n申请项目:-\nNT-proBNP 12"),
        page("visits", 1, "上海儿童医学中心\n就诊日期:2024-01-02 就诊科室:心内科\n主诉:a\n现病史:b\n治疗计划:c\n就诊日期:2024-02-02 就诊科室:心内科\n主诉:a\n现病史:b"),
        page("by_name", 1, "手术记录\n正文", pdf="/a/张三-2024-03-04.pdf"),
        page("wrong_day", 1, "2024-02-31 08:30 日常病程"),
    ]
    out = {}
    for r in segment.sections(spark.createDataFrame(rows, PAGE)).orderBy("document_id", "ordinal").collect():
        out.setdefault(r.document_id, []).append(r)
    return out


def test_dates_inside_a_record_do_not_date_it(cut):
    types = [s.section_type for s in cut["no_date"]]
    assert types == ["unknown", "procedure", "admission"] and all(s.section_date == "" for s in cut["no_date"])
    assert [m.role for m in cut["no_date"][2].mentioned_dates] == ["birth", "admission_mentioned"]


def test_sections_across_pages(cut):
    s = cut["two_pages"]
    assert [(x.section_type, x.section_date, x.document_timestamp, x.page_start, x.page_end) for x in s] == [
        ("unknown", "", "", 1, 1), ("progress", "2024-01-02", "2024-01-02T08:30", 1, 2), ("procedure", "2024-01-03", "2024-01-03T09:15", 2, 2)
    ]
    assert s[1].section_subtype == "daily_progress" and s[2].section_subtype == "surgery_record" and s[0].section_id == "two_pages_s0001"
    assert [tuple(p) for p in s[1].page_spans] == [(1, 2, 3), (2, 1, 1)] and s[1].text == "2024-01-02 08:30 日常病程\n正文甲\n正文乙"


def test_laboratory_dates(cut):
    assert (cut["lab_conflict"][0].section_date, cut["lab_conflict"][0].flags) == ("", ["conflicting_test_dates", "unknown_date"])
    s = cut["lab_times"][0]
    assert (s.section_date, s.date_precision, s.date_source) == ("2024-01-02", "day", "test_timestamp_column")
    assert cut["printed"][-1].section_date == "2024-01-02" and cut["printed"][0].mentioned_dates[0].role == "print"


def test_damaged_pages_stand_alone(cut):
    assert [(s.section_type, s.section_date, s.segmentation_rule) for s in cut["damaged"]] == [
        ("progress", "2024-01-02", "dated_title"), ("unknown", "", "damaged_page"), ("progress", "2024-01-05", "dated_title")
    ]
    assert cut["damaged"][1].parse_status == "unusable_text_layer" and cut["empty"][0].section_subtype == "empty_content"


def test_headings(cut):
    assert len(cut["repeated"]) == 1 and cut["repeated"][0].section_date == "2024-01-02"
    assert "conflicting_document_dates" in cut["two_dates"][0].flags and cut["two_dates"][0].section_date == ""
    assert ("conflicting_document_times" in cut["two_times"][0].flags, cut["two_times"][0].date_precision) == (True, "day")
    assert (cut["ocr"][0].date_source, cut["ocr"][0].flags) == ("local_ocr:title_timestamp", ["date_requires_review", "ocr_unverified"])
    assert cut["joined"][0].document_timestamp == "2024-01-02T13:30" and cut["short_day"][0].section_date == "" and cut["wrong_day"][0].section_date == ""


def test_titles_of_laboratory_reports(cut):
    assert [(s.section_title, s.section_subtype) for s in cut["labs"]] == [("CTNI", "cardiac_biomarker"), ("血气分析", "blood_gas"), ("NT-proBNP", "cardiac_biomarker")]


def test_outpatient_forms_and_file_names(cut):
    assert [(s.section_type, s.section_date) for s in cut["visits"]] == [("outpatient", "2024-01-02"), ("outpatient", "2024-02-02")]
    s = cut["by_name"][0]
    assert (s.section_date, s.date_source, s.date_uncertain) == ("2024-03-04", "filename", True) and "filename_date_unconfirmed" in s.flags


def test_normalized_pages(spark):
    rows = [("d", 1, "360 视图 v2.1 Beta\n１．２ \u200b x\r\n\n\n y\n\ue001\nhttp://a/b\n文\n\n第 1 页")]
    p = text.normalize_pages(spark.createDataFrame(rows, "document_id string, page int, text string")).first()
    assert p.normalized_text == "1.2 x\n\ny\n文" and p.normalized_line_map == [2, 3, 5, 8] and p.text.startswith("360")
    assert [(r.raw_line, r.reason) for r in p.removed_lines] == [
        (1, "browser_title_at_page_margin"), (6, "standalone_private_use_browser_icon"), (7, "browser_or_navigation_url"), (10, "page_number_at_page_margin")
    ]


def test_coverage_mentions_and_documents(spark, cut):
    pages = spark.createDataFrame([("d", 1, "导航\n2024-01-02 08:30 日常病程\n\n甲"), ("d", 2, "乙")], "document_id string, page int, normalized_text string")
    found = segment.sections(pages)
    assert [tuple(r) for r in segment.coverage(pages, found).orderBy("page").collect()] == [("d", 1, 3, 0, 0), ("d", 2, 1, 0, 0)]
    assert [(r.date, r.is_document_date_evidence) for r in segment.mentions(found).collect()] == [("2024-01-02", True)]
    assert tuple(segment.documents(found).first()) == ("d", "progress", "", "multiple_sections", "2024-01-02", "2024-01-02", 2)
    facts = pages.selectExpr("*", "'ok' AS extraction_status")
    assert {(r.text_source, r.parse_status) for r in segment.with_page_facts(found, facts).collect()} == {("pdf_text_layer", "uncertain"), ("pdf_text_layer", "ok")}

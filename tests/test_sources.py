import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions import dates, text
from sparkfolio.operators import identity
from sparkfolio.sources import readers, sinks
from sparkfolio.streaming import incremental

COLUMNS = {"inpatient": "住院号", "outpatient": "门诊号", "name": "姓名"}


@pytest.mark.parametrize("encoding", ["utf-8-sig", "gb18030"])
def test_cohort(spark, tmp_path, encoding):
    p = tmp_path / "cohort.csv"
    p.write_bytes("住院号,门诊号,姓名\n001234,01,甲\n,01,乙\n,,丙\n,,丙\n".encode(encoding))
    rows = readers.with_subject_ids(readers.load_cohort(spark, str(p), COLUMNS), "inpatient", "outpatient", "name").orderBy("csv_row").collect()
    assert [r.csv_row for r in rows] == [2, 3, 4, 5] and rows[0].inpatient == "001234"
    assert rows[3].patient_id == rows[2].patient_id + "_duplicate_2" and len({r.patient_id for r in rows}) == 4
    with pytest.raises(ValueError):
        readers.load_cohort(spark, str(p), {"x": "no such column"})


def test_documents_and_packages(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "1.pdf").write_bytes(b"one")
    (tmp_path / "a" / "b" / "2.PDF").write_bytes(b"one")
    (tmp_path / "a" / "3.txt").write_bytes(b"no")
    docs = readers.scan_documents(spark, [str(tmp_path / "a"), str(tmp_path / "a" / "b")])
    assert docs.count() == 2 and docs.select("sha256").distinct().count() == 1
    with pytest.raises(ValueError):
        sinks.guard(str(tmp_path / "a" / "out"), str(tmp_path / "a"))
    receipt = sinks.write_package(str(tmp_path / "run"), {"documents": docs.select("document_id", "sha256")}, {"rules": 1}, (str(tmp_path / "a"),))
    assert receipt["counts"] == {"documents": 2}
    assert [r["path"] for r in readers.discover_runs(str(tmp_path), ("documents",))] == [str(tmp_path / "run")]


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nnot json\n')
    rows = readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), T.StructType([T.StructField("a", T.IntegerType())])).collect()
    assert sorted((r.a or 0, r._corrupt_record is None) for r in rows) == [(0, False), (1, True)]


def test_text_and_dates(spark):
    df = spark.createDataFrame([(1, "１．２​  x\r\n\n\n\ny "), (2, None)], "id int, text string")
    assert [r[0] for r in df.orderBy("id").select(text.normalize_text(F.col("text"))).collect()] == ["1.2 x\n\ny", None]
    d = spark.createDataFrame([("2024-03", "2024-02-10"), ("2024-02-10", "2024-02"), ("", "2024"), ("2024-02-10", "2024-02-10")], "a string, b string")
    assert [r[0] for r in d.select(dates.at_or_after(F.col("a"), F.col("b"), F.lit(True))).collect()] == [True, False, False, True]
    m = dates.date_mentions(spark.createDataFrame([(1, "2025年1月5日 and 2024-02-30, 2024.2.9")], "id int, text string"), "id")
    assert [r.date for r in m.orderBy("ordinal").collect()] == ["2025-01-05", "2024-02-09"]


def test_matching(spark):
    e = spark.createDataFrame([("f1", "name", "p1"), ("f1", "name", "p2"), ("f1", "header", "p2"), ("f2", "name", "p1"), ("f2", "header", "p2")], "f string, method string, candidate string")
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "f string")
    got = {r.f: (r.match_status, r.matched) for r in identity.resolve_matches(e, files, "f").collect()}
    assert got == {"f1": ("matched", "p2"), "f2": ("ambiguous", None), "f3": ("unmatched", None)}


def test_streaming(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.StringType())])
    for k in range(2):
        spark.createDataFrame([(k, "2024-01-01"), (9, None)], schema).write.mode("append").parquet(str(tmp_path / "in"))
        q = incremental.append_timeline(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "ck"), lambda b: b.where("day is not null"))
        q.awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1]

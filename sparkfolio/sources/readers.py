"""Sources: cohort tables, document trees, page tables, JSON lines, runs."""

from __future__ import annotations

import codecs
import csv
import io
import itertools
import json
import os
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str], encoding: str = "UTF-8") -> DataFrame:
    """A CSV with a header, every cell a string, so that identifiers keep their leading zeros."""
    return spark.read.csv(path, schema=all_strings(columns), header=True, enforceSchema=False, multiLine=True, escape='"', encoding=encoding)


#: Bytes of a cohort table by which its encoding is told.
PROBE = 1 << 20


def load_cohort(spark: SparkSession, path: str, columns: dict[str, str], encodings: tuple[str, ...] = ("UTF-8", "GB18030")) -> DataFrame:
    """A cohort table (a file, or a folder of them) under our names (ours -> theirs), every row kept, csv_row from 2 in each
    file. The encoding is the first that decodes the head of every file, cut in Spark; rows are parsed in Spark, whole texts
    never reach the driver. GB18030 is decoded by Python workers, as Spark has no such charset."""
    heads = spark.read.format("binaryFile").load(path).select("path", F.expr(f"substring(content, 1, {PROBE})").alias("head")).collect()
    if not heads:
        raise FileNotFoundError(path)

    def decodes(head: bytes, encoding: str) -> bool:
        try:
            codecs.getincrementaldecoder(encoding)().decode(bytes(head))
        except UnicodeDecodeError:
            return False
        return True

    encoding = next((e for e in encodings if all(decodes(h.head, e) for h in heads)), None)
    if encoding is None:
        raise ValueError("the cohort table is in none of the encodings")
    for h in heads:
        first = codecs.getincrementaldecoder(encoding)().decode(bytes(h.head)).lstrip("\ufeff").splitlines()[:1]
        header = next(csv.reader(first), [])
        if missing := [t for t in columns.values() if t not in header]:
            raise ValueError(f"columns missing: {', '.join(missing)}")
    names, wanted = list(columns), list(columns.values())

    def parse(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = csv.reader(io.StringIO(bytes(content).decode(encoding).lstrip("\ufeff")))
                header = next(rows)
                at = [header.index(t) for t in wanted]
                for k, some in enumerate(iter(lambda: list(itertools.islice(rows, 10_000)), [])):
                    cells = [[r[i] if i < len(r) else "" for r in some] for i in at]
                    yield pa.record_batch([pa.array(range(2 + 10_000 * k, 2 + 10_000 * k + len(some)), pa.int32()), *(pa.array(c, pa.string()) for c in cells)], names=["csv_row", *names])

    schema = T.StructType([T.StructField("csv_row", T.IntegerType()), *all_strings(names).fields])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, schema)


def with_subject_ids(cohort: DataFrame, inpatient: str, outpatient: str, name: str) -> DataFrame:
    """cohort with patient_id (operators.matching.cohort_ids)."""
    from sparkfolio.operators.matching import cohort_ids

    ids = cohort_ids(cohort.select("csv_row", F.col(inpatient).alias("_i"), F.col(outpatient).alias("_o"), F.col(name).alias("_n")), "_i", "_o", "_n").select("csv_row", "patient_id")
    return cohort.join(ids, "csv_row")


def local_path(uri: Column) -> Column:
    """The path of a file: URI as the file system has it, without the scheme and with its characters unescaped."""
    plain = F.regexp_replace(uri, "^file:/*(?=/)", "")
    return F.when(uri.startswith("file:"), F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))).otherwise(uri)


@F.pandas_udf(T.StringType())
def casefold(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else x.casefold())


def scan_documents(spark: SparkSession, roots: list[str], glob: str = "*.[pP][dD][fF]", ignore_failures: bool = True) -> DataFrame:
    """(document_id, source_pdf, root_order, length, modified, sha256, scan_status) of every file below the roots; a path under
    several roots counts once, for the first. The id is from the case-folded absolute path. Bytes are hashed where they are
    read and go no further; an empty hash and scan_status failed stand for a file that cannot be read."""
    parts = []
    for order, root in enumerate(roots):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        listed = found.load(root).select("path", F.lit(order).alias("root_order"), "length", F.col("modificationTime").alias("modified"))
        hashed = found.option("ignoreCorruptFiles", ignore_failures).option("ignoreMissingFiles", ignore_failures).load(root).select("path", F.sha2("content", 256).alias("sha256"))
        parts.append(listed.join(hashed, "path", "left"))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    first = F.min(F.struct("root_order", "source_pdf", "length", "modified", "sha256")).alias("x")
    rows = both.withColumn("source_pdf", local_path(F.col("path"))).withColumn("_k", casefold("source_pdf"))
    out = rows.groupBy("_k").agg(first).select(F.concat(F.lit("doc_"), F.substring(F.sha2("_k", 256), 1, 20)).alias("document_id"), "x.*")
    return out.withColumns({"scan_status": F.when(F.col("sha256").isNull(), "failed").otherwise("success"), "sha256": F.coalesce("sha256", F.lit(""))})


def read_run(spark: SparkSession, path: str, tables: tuple[str, ...], verified: bool = True) -> dict[str, DataFrame]:
    """The tables of a package whose receipt says that it is complete and, if asked for, that its sources' hashes held."""
    receipt = read_object(f"{path}/run_metadata.json")
    if receipt.get("status") != "complete":
        raise ValueError("the run is not complete")
    if verified and receipt.get("source_hash_verification", "passed") != "passed":
        raise ValueError("the run's sources were not verified")
    return {t: spark.read.parquet(f"{path}/{t}") for t in tables}


def read_object(path: str) -> dict:
    """A JSON object; anything else is an error."""
    value = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise ValueError(f"{path} holds no JSON object")
    return value


def sections_of(sections: DataFrame, subjects: DataFrame, key: str = "patient_id") -> DataFrame:
    """The sections of the given subjects; a section without an id, or an id that occurs twice, is an error."""
    kept = sections.join(subjects.select(key), key, "left_semi")
    bad = kept.groupBy("section_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or coalesce(section_id, '') = ''").limit(1).collect()
    if bad:
        raise ValueError(f"a section id is missing or occurs twice: {bad[0].section_id}")
    return kept


def read_config(path: str, overrides: dict | None = None) -> dict:
    """A JSON object of settings; environment variables and ~ are expanded in texts, relative *_root, *_csv and *_dir paths are
    taken from the file's folder, and overrides that are not None win."""
    base = Path(path).resolve().parent

    def expand(name: str, value):
        if isinstance(value, list):
            return [expand(name, v) for v in value]
        if not isinstance(value, str):
            return value
        text = os.path.expanduser(os.path.expandvars(value))
        return str((base / text).resolve()) if name.endswith(("_root", "_roots", "_csv", "_dir")) else text

    return {k: expand(k, v) for k, v in (read_object(path) | {k: v for k, v in (overrides or {}).items() if v is not None}).items()}


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON objects, one a line; lines that are none stay, as _corrupt_record."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def jsonl_errors(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, error) of the lines of each file that are no JSON object; blank lines are none and no error. A file's lines are
    numbered where it is read, whole."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\n")).alias("at", "text"))
    body = F.trim(F.regexp_replace("text", "[\r\t]", " "))
    parsed = F.try_parse_json(body)
    error = F.when(parsed.isNull(), "invalid JSON").when(~body.startswith("{"), "no object")
    return files.where(body != "").select("path", (F.col("at") + 1).alias("line"), error.alias("error")).where("error is not null")


def discover_runs(root: str, required: tuple[str, ...] = ()) -> list[dict]:
    """Receipts of complete runs below a folder that have the required tables, latest first."""
    out = []
    for p in Path(root).rglob("run_metadata.json"):
        try:
            meta = json.loads(p.read_text(encoding="utf-8"))
        except (OSError, ValueError):
            continue
        if isinstance(meta, dict) and meta.get("status") == "complete" and all((p.parent / t).exists() for t in required):
            out.append({**meta, "path": str(p.parent)})
    return sorted(out, key=lambda m: (m.get("finished_at", ""), m["path"]), reverse=True)

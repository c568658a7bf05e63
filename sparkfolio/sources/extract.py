"""Pages from files by a pluggable extractor, cached by content; candidates from sections by a pluggable adapter."""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

PAGES = "sha256 string, page int, text string, extraction_status string, flags array<string>, error string"


@dataclass(frozen=True)
class Page:
    page: int
    text: str
    extraction_status: str = "ok"
    flags: tuple[str, ...] = ()


#: bytes of a file -> its pages; what it raises makes one failed row
Extractor = Callable[[bytes], Iterable[Page]]


def fingerprint(extractor: Extractor, *versions: str) -> str:
    """Names an extractor by its source and the versions that it depends on, so that a changed one finds no old results."""
    return hashlib.sha256("\x1f".join([inspect.getsource(extractor), *versions]).encode()).hexdigest()[:16]


def extract(files: DataFrame, extractor: Extractor) -> DataFrame:
    """Pages of files (sha256, content), each content once; a file that cannot be read is one row, page 0, failed."""

    def run(batches):
        for batch in batches:
            rows = []
            for sha, content in zip(batch.column("sha256").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    found = [(sha, p.page, p.text, p.extraction_status, list(p.flags), None) for p in extractor(bytes(content))]
                except Exception as e:  # noqa: BLE001 - one bad file is one failed row
                    found = [(sha, 0, "", "failed", ["extraction_failure"], type(e).__name__)]
                rows += found or [(sha, 0, "", "empty", ["no_pages"], None)]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["sha256", "page", "text", "extraction_status", "flags", "error"])

    return files.select("sha256", "content").mapInArrow(run, PAGES)


def cached(spark: SparkSession, files: DataFrame, extractor: Extractor, cache: str, version: str, refresh: bool = False) -> DataFrame:
    """Pages of files, from the cache below `cache`/`version` where it has their contents; the rest is extracted and added. Only
    contents are stored, never whose they are. An anti-join on hashes finds the work, so that known contents are not read."""
    path = f"{cache.rstrip('/')}/{version}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where) and not refresh
    work = files.dropDuplicates(["sha256"])
    if known:
        work = work.join(spark.read.parquet(path).select("sha256"), "sha256", "left_anti")
    extract(work, extractor).write.mode("append" if known else "overwrite").parquet(path)
    return spark.read.schema(PAGES).parquet(path).join(files.select("sha256").distinct(), "sha256", "left_semi")


def recovered(pages: DataFrame, again: DataFrame) -> DataFrame:
    """pages with the text of a second reading (document_id, page, ocr_text, ocr_mean_confidence) in place of a missing or unusable
    one; analysis_text_source says which it is, the first text stays as `text`."""
    rows = pages.join(again, ["document_id", "page"], "left")
    wanted = F.col("extraction_status").isin("empty", "failed", "text_layer_unusable")
    use = wanted & (F.trim(F.coalesce("ocr_text", F.lit(""))) != "")
    status = F.when(~wanted, "not_needed").when(F.col("ocr_text").isNull(), "pending").when(use, "recovered").otherwise("empty")
    return rows.withColumns({
        "analysis_text": F.when(use, F.col("ocr_text")).otherwise(F.col("text")), "analysis_text_source": F.when(use, "local_ocr").otherwise("pdf_text_layer"), "ocr_recommended": wanted, "ocr_status": status,
        "ocr_character_count": F.when(use, F.length("ocr_text")).otherwise(0),
    })


@dataclass(frozen=True)
class Candidate:
    """What an adapter proposes about a section, with the span that it rests on."""

    kind: str
    value: str
    char_start: int
    char_end: int
    confidence: float = 0.0


class Adapter(Protocol):
    """A local extractor of candidates; it never changes a section."""

    def extract(self, section: dict) -> Iterable[Candidate]: ...


def enrich(sections: DataFrame, adapter: Adapter) -> DataFrame:
    """(section_id, kind, value, char_start, char_end, confidence, evidence_text) of an adapter; spans outside the text are refused."""
    schema = sections.schema["section_id"].dataType

    def run(batches):
        for batch in batches:
            rows = []
            for s in batch.to_pylist():
                text = s["text"] or ""
                for c in adapter.extract(s):
                    x = asdict(c)
                    if not 0 <= x["char_start"] < x["char_end"] <= len(text):
                        raise ValueError("a candidate's span lies outside its section")
                    rows.append((s["section_id"], x["kind"], x["value"], x["char_start"], x["char_end"], float(x["confidence"]), text[x["char_start"] : x["char_end"]]))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [to_arrow_type(schema), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["section_id", "kind", "value", "char_start", "char_end", "confidence", "evidence_text"])

    kind = schema.simpleString()
    return sections.mapInArrow(run, f"section_id {kind}, kind string, value string, char_start int, char_end int, confidence double, evidence_text string")

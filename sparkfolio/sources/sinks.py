"""Sinks: guarded, receipted packages of tables."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.ids import canonical_digest


def guard(output: str, *inputs: str) -> None:
    """Refuses an output that holds an input, or that an input holds, links resolved."""
    out = Path(output).resolve()
    for i in inputs:
        other = Path(i).resolve()
        if out == other or out in other.parents or other in out.parents:
            raise ValueError(f"{output} and {i} overlap")


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without nesting."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema))


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_package(path: str, tables: dict[str, DataFrame], versions: dict, inputs: tuple[str, ...] = (), check=None, verify=None) -> dict:
    """Writes the tables to a fresh folder beside `path`, then the receipt (row counts, an order-free hash of each table's rows,
    schema digests, versions), then moves the folder into place: readers see a whole package or none.

    check(tables as read back) returns (code, artifact_id) rows: with any, the package is not published. verify() tells at the end
    whether the sources are unchanged; if not, the receipt says failed_source_integrity. What failed stays beside `path` as
    path.failed, replacing an earlier failure, so that a retry may begin at once. Moving uses Hadoop's file system, so that
    the path may be in any store that Spark reaches."""
    guard(path, *inputs)
    spark = next(iter(tables.values())).sparkSession
    if _exists(spark, path):
        raise FileExistsError(path)
    staging = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    receipt = {"status": "running", "started_at": datetime.now(timezone.utc).isoformat(), "versions": versions}
    try:
        written = {}
        for name, df in tables.items():
            df.write.parquet(f"{staging}/{name}")
            written[name] = spark.read.parquet(f"{staging}/{name}")
        receipt["schemas"] = {n: canonical_digest(json.loads(df.schema.json())) for n, df in written.items()}
        facts = {n: df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string").alias("h")).first() for n, df in written.items()}
        receipt |= {"counts": {n: f.n for n, f in facts.items()}, "hashes": {n: f.h or "0" for n, f in facts.items()}}
        errors = check(written).limit(100).collect() if check else []
        if errors:
            receipt["errors"] = [[r.code, r.artifact_id] for r in errors]
            raise ValueError(f"the package does not pass its own checks: {errors[0].code}")
        unchanged = verify() if verify else True
        receipt["source_hash_verification"] = ("passed" if unchanged else "failed") if verify else "not_requested"
        receipt["status"] = "complete" if unchanged else "failed_source_integrity"
    except Exception as error:
        receipt |= {"status": "failed", "error_type": type(error).__name__}
        raise
    finally:
        receipt["finished_at"] = datetime.now(timezone.utc).isoformat()
        _put(spark, f"{staging}/run_metadata.json", json.dumps(receipt, ensure_ascii=False, indent=1))
        target = path if receipt["status"] == "complete" else f"{path.rstrip('/')}.failed"
        if target != path:
            _drop(spark, target)
        _move(spark, staging, target)
    return receipt


def _fs(spark, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark, path: str) -> bool:
    where, fs = _fs(spark, path)
    return fs.exists(where)


def _drop(spark, path: str) -> None:
    where, fs = _fs(spark, path)
    fs.delete(where, True)


def _move(spark, source: str, target: str) -> None:
    where, fs = _fs(spark, source)
    if not fs.rename(where, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not become {target}")


def _put(spark, path: str, text: str) -> None:
    where, fs = _fs(spark, path)
    out = fs.create(where, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def inventory(paths: DataFrame, now: DataFrame) -> DataFrame:
    """(document_id, source_pdf, sha256, unchanged): sources against a second scan; null where a file cannot be read any more."""
    again = now.select("document_id", F.col("sha256").alias("_now"))
    same = F.when((F.col("sha256") == "") | (F.coalesce("_now", F.lit("")) == ""), None).otherwise(F.col("sha256") == F.col("_now"))
    return paths.select("document_id", "source_pdf", "sha256").join(again, "document_id", "left").withColumn("unchanged", same).drop("_now")

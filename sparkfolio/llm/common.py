"""Scratch tables in the shared folder, and numpy kernels over Arrow text columns."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir; only where that is unset (tests) below a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="sparkfolio-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialize(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: the lineage ends here,
    so a lost executor costs no recomputation of what came before."""
    path = f"{scratch_dir(df.sparkSession)}/t"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of materialize() that no plan reads any more."""
    for df in tables:
        jvm, context = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context).delete(path, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a Spark context."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).parents[1]
    target = f"{tempfile.mkdtemp(prefix='sparkfolio-')}/{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema), with this package at hand on the executors. A worker, which waits for the next task beside
    others, hands back what its kernels took."""
    ship(df.sparkSession)

    def tidy(batches):
        yield from run(batches)
        trim()

    return df.mapInArrow(tidy, schema)


def trim() -> None:
    """Gives free memory back to the system, where the allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    for _ in range(2):  # the first round frees what the second can collect
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
    trim()


# --- Arrow text columns as flat bytes ---------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20):
    """Slices of the batch of at most max_bytes of text, or of one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words [^\\x20\\x09-\\x0D]+, and for each row the index of its first word (n + 1 values)."""
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[1:], before[0] = inside[:-1], False
        after[:-1], after[-1] = inside[1:], False
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(1 << 20, ((n >> 18) + 1) << 18)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(known, out=known)
        if n <= 1 << 24:
            _POWERS[base] = known
    return known[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; run_hash() takes the hash of any run of bytes from them."""
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def run_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (prefix[ends] - prefix[starts]) * powers(_INVERSE, len(prefix))[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _GOLD)


_GRAM = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hash(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive values, at each of the first len - k + 1 places."""
    n = max(0, len(values) - k + 1)
    out = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out += values[i : i + n] * _GRAM[i % 64]
    return mix(out)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))

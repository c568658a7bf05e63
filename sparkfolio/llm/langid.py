"""Language identification by bit-sliced Bloom filters of n-grams.

One table of SLOTS words holds a filter a language as bit slices: bit l of a word belongs to language l. The AND of the
words at an n-gram's HASHES slots is the set of languages that (may) contain it. A text's popcount of language l,
corrected for false positives as (hits - n * fp) / (1 - fp) with fp = fill ** HASHES of its slice, decides.

Learning sees text and lang alone, of rows that the caller marks as training rows, at most about per_language of them a
language (chosen by a hash; the bound is a parameter). A language's filter gets every n-gram of its rows, and the table has
as many slots as keep the fullest filter at about a quarter.

stage() also asks how much of a text the best language knows (corrected hits / n-grams): texts without a known n-gram go, and
so do those of CERTAIN n-grams or more that know less than half of what all but a hundredth of the training rows do.

Nulls: a null text, or one without a letter, is `und` with score 0. A null lang is not learned from. Without training
rows all is `und`. A text with letters but no known n-gram gets the language with most training rows, score 0.
Ties go to the first language in order. Repeated rows are predicted alike. A text is read whole; its kernel holds some 60
bytes for each of its own, so that a batch has SLICE bytes of text, or one text. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ORDERS = (3, 4)
HASHES = 2
SLICE = 1 << 18
CERTAIN = 60
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def _grams(batch: pa.RecordBatch):
    """For each order: (n-grams packed in an integer, row of each). Letters in lower case; the rest of ASCII is a space."""
    texts = [f" {t.lower()} " if t else "" for t in batch.column("text").to_pylist()]
    data, offsets = common.text_bytes(pa.array(texts, pa.large_string()))
    folded = _FOLD[data].astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    packed = folded
    for n in range(2, max(ORDERS) + 1):
        packed = (packed[:-1] << np.uint64(8)) | folded[n - 1 :]
        if n in ORDERS and len(packed):
            whole = row[: len(packed)] == row[n - 1 :]
            spaces = (packed & np.uint64(0xFFFF)) == np.uint64(0x2020)
            keep = whole & ~spaces
            yield packed[keep] | (np.uint64(n) << np.uint64(40)), row[: len(packed)][keep]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    false_positive: np.ndarray
    default: int
    least_share: float = 0.0

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Bit l set: language l contains the n-gram, or its filter says so by mistake."""
        out, shift = None, np.uint64(64 - (len(self.table).bit_length() - 1))
        with np.errstate(over="ignore"):
            for m in _MULTIPLIERS[:HASHES]:
                found = self.table[(grams * m) >> shift]
                out = found if out is None else out & found
        return out

    def hits(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """([rows, languages]: popcounts corrected for false positives, n-grams of each row)."""
        n = batch.num_rows
        found, total = np.zeros((n, len(self.languages))), np.zeros(n)
        for grams, row in _grams(batch):
            masks = self.masks(grams)
            total += np.bincount(row, minlength=n)
            for k in range(len(self.languages)):
                found[:, k] += np.bincount(row, (masks >> masks.dtype.type(k)) & masks.dtype.type(1), minlength=n)
        return np.clip((found - total[:, None] * self.false_positive) / (1 - self.false_positive), 0, None), total

    def predict(self, batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, whether the text is strange to all languages) of each row."""
        n = batch.num_rows
        real, total = self.hits(batch)
        best = real.argmax(1) if self.languages else np.zeros(n, int)
        mass, most = real.sum(1), real.max(1, initial=0)
        score = np.where(mass > 0, most / np.where(mass > 0, mass, 1), 0.0)
        best = np.where(mass > 0, best, self.default)
        texts = batch.column("text").to_pylist()
        known = [bool(self.languages) and t is not None and _LETTER.search(t) is not None for t in texts]
        strange = (most <= 0) | (total >= CERTAIN) & (most < self.least_share * total)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, known, strict=True)], np.where(known, score, 0.0), strange


def fit(rows: DataFrame, per_language: int = 2000) -> Model:
    """rows: (doc_id, text, lang) to learn from."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if len(languages) > 64:
        raise ValueError("a bitmask holds 64 languages")
    if not languages:
        return Model([], np.zeros(1, np.uint8), np.zeros(0), 0)
    chosen = F.lit(False)
    for x in languages:
        chosen = chosen | (F.col("lang") == x) & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * min(1.0, per_language / sizes[x])) + 1)
    rows = rows.where(chosen)
    kind = np.uint8 if len(languages) <= 8 else np.uint64

    def bits(batches):
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                of = np.array([languages.index(x) for x in some.column("lang").to_pylist()])
                for grams, row in _grams(some):
                    keys = np.unique(grams | (of[row].astype(np.uint64) << np.uint64(48)))
                    mask = np.int64(1) << (keys >> np.uint64(48)).astype(np.int64)
                    yield pa.record_batch([pa.array((keys & np.uint64((1 << 48) - 1)).astype(np.int64)), pa.array(mask)], names=["gram", "mask"])

    # one row an n-gram, from a sample of bounded size
    got = common.map_arrow(rows, bits, "gram long, mask long").groupBy("gram").agg(F.bit_or("mask").alias("mask")).toArrow()
    grams, masks = got["gram"].to_numpy().astype(np.uint64), got["mask"].to_numpy().astype(np.uint64)
    fullest = max(int(((masks >> np.uint64(k)) & np.uint64(1)).sum()) for k in range(len(languages)))
    table = np.zeros(1 << max(16, (4 * HASHES * fullest).bit_length()), kind)
    shift = np.uint64(64 - (len(table).bit_length() - 1))
    with np.errstate(over="ignore"):
        for m in _MULTIPLIERS[:HASHES]:
            np.bitwise_or.at(table, (grams * m) >> shift, masks.astype(kind))
    fill = np.array([((table >> kind(k)) & kind(1)).mean() for k in range(len(languages))])
    model = Model(languages, table, fill**HASHES, max(range(len(languages)), key=lambda k: (sizes[languages[k]], -k)))

    def shares(batches):
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                real, total = model.hits(some)
                sure = total >= CERTAIN
                yield pa.record_batch([pa.array(real[sure].max(1, initial=0) / total[sure])], names=["share"])

    low = common.map_arrow(rows.select("text"), shares, "share double").agg(F.percentile_approx("share", 0.01)).first()[0]
    model.least_share = 0.5 * (low or 0.0)
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every document."""

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                langs, score, _ = model.predict(some)
                yield pa.record_batch([some.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(4)) == 2


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is known; `und` and texts strange to all languages go. The model learns from docs."""
    model = fit(docs.where(~held_out()))

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                langs, _, strange = model.predict(some)
                yield some.filter(pa.array([x != "und" and not s for x, s in zip(langs, strange, strict=True)], pa.bool_()))

    return common.map_arrow(docs, run, docs.schema)

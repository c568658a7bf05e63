"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with runs of white space as one space. An item of m characters may differ by
e = m // CHARS_PER_EDIT edits. Cut in e + 1 pieces, one piece of an occurrence must be free of edits (pigeonhole), so that
exact hits of pieces, found by one Aho-Corasick pass, are all places worth a look; Myers' bit-parallel distance then
verifies each. Places of one item that lie within its error budget of each other are verified once.

Items under EXACT_BELOW characters are searched for without edits, those under BORDERS_BELOW as whole words only: a place
counts if no letter or digit stands right before or after it.

A benchmark of at most BROADCAST_BYTES goes to every task; of a larger one, shards of that size do, one after another (by a
hash of the item), so that neither the driver nor a task ever holds more than one.

Nulls: null texts match nothing; null items, and those that are blank, are not searched for. Empty tables give no matches.
Repeated items match under each id. A document with several items has a row each; the row has the least distance, then the
first place. Very long texts are scanned in one pass. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common

CHARS_PER_EDIT = 20
EXACT_BELOW = 40
BORDERS_BELOW = 20
BROADCAST_BYTES = 16 << 20
_BLANK = regex.compile(r"\s+")


def normal(text: str) -> str:
    return _BLANK.sub(" ", text.lower()).strip()


def cut(item: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces of nearly equal length, with their offsets."""
    ends = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False) if b > a]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(least edit distance of pattern to any substring of text, end of the first such substring), if at most `most`."""
    m = len(pattern)
    if not m:
        return (0, 0)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = (m, 0) if m <= most else None
    for j, c in enumerate(text, 1):
        eq = places.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if score <= most and (best is None or score < best[0]):
            best = (score, j)
            if not score:
                break
    return best


@dataclass
class Matcher:
    """items: (item_id, normalised text)."""

    items: list[tuple[int, str]]
    chars_per_edit: int = CHARS_PER_EDIT

    def __post_init__(self):
        import ahocorasick

        found: dict[str, list[tuple[int, int]]] = {}
        self.edits = [len(t) // self.chars_per_edit if len(t) >= EXACT_BELOW else 0 for _, t in self.items]
        for i, (_, t) in enumerate(self.items):
            for at, piece in cut(t, self.edits[i]):
                found.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start estimate, end) of each item that the normalised text contains; offsets in that text."""
        if not self.items:
            return []
        places: dict[int, set[int]] = {}
        for end, (n, owners) in self.automaton.iter(text):
            for i, at in owners:
                places.setdefault(i, set()).add(end + 1 - n - at)
        out = []
        for i, starts in places.items():
            item_id, item = self.items[i]
            e, best, done = self.edits[i], None, None
            if len(item) < EXACT_BELOW:  # its one piece is the item
                free = [s for s in sorted(starts) if len(item) >= BORDERS_BELOW or _bordered(text, s, s + len(item))]
                out += [(item_id, 0, s, s + len(item)) for s in free[:1]]
                continue
            for start in sorted(starts):
                if done is not None and start - done <= e:
                    continue  # the window of `done` reaches that far on either side
                done = start
                low = max(0, start - e)
                got = myers(item, text[low : start + len(item) + 3 * e], e)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], low + got[1])
            if best:
                out.append((item_id, best[0], max(0, best[1] - len(item)), best[1]))
        return out


def _bordered(text: str, a: int, b: int) -> bool:
    return not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())


def shards(benchmark: DataFrame, most_bytes: int = BROADCAST_BYTES) -> Iterator[Matcher]:
    """Matchers of about most_bytes of items each, in turn; the driver holds one at a time."""
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    n = max(1, -(-size // most_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        yield Matcher(sorted((i, t) for r in part.collect() for i, t in [(r.item_id, normal(r.text))] if t))


_MATCHES = "doc_id {}, item_id {}, distance int, n_chars int, match_start int, match_end int"


class _Lazy:
    """Sends the items; the automaton is built where it is used."""

    def __init__(self, matcher: Matcher):
        self.items, self.chars = matcher.items, matcher.chars_per_edit

    def get(self) -> Matcher:
        return Matcher(self.items, self.chars)


def _found(docs: DataFrame, matcher: Matcher, item_kind) -> DataFrame:
    def run(batches, lazy=_Lazy(matcher), item_type=to_arrow_type(item_kind)):
        matcher = lazy.get()
        for batch in batches:
            for some in common.pieces(batch, "text"):
                rows = []
                for d, t in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True):
                    if t:
                        rows += [(d, i, e, b - a, a, b) for i, e, a, b in matcher.matches(normal(t))]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = [some.schema.field("doc_id").type, item_type, *[pa.int32()] * 4]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "distance", "n_chars", "match_start", "match_end"])

    kinds = (docs.schema["doc_id"].dataType.simpleString(), item_kind.simpleString())
    return common.map_arrow(docs.select("doc_id", "text"), run, _MATCHES.format(*kinds))


def find(docs: DataFrame, benchmark: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, ...) of every item in every document."""
    out, kind = None, benchmark.schema["item_id"].dataType
    for m in shards(benchmark, most_bytes):
        if out is None:
            out = _found(docs, m, kind)
        else:  # what the shards before found is written, so that no plan holds two of them
            out = common.materialize(out).unionByName(_found(docs, m, kind))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it contains; clean documents have none."""
    return find(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


def clean(docs: DataFrame, benchmark: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents that contain no benchmark item; all columns stay."""

    def without(docs: DataFrame, matcher: Matcher) -> DataFrame:
        def run(batches, lazy=_Lazy(matcher)):
            matcher = lazy.get()
            for batch in batches:
                for some in common.pieces(batch, "text"):
                    keep = [not (t and matcher.matches(normal(t))) for t in some.column("text").to_pylist()]
                    yield some.filter(pa.array(keep, pa.bool_()))

        return common.map_arrow(docs, run, docs.schema)

    first = True
    for m in shards(benchmark, most_bytes):
        docs = without(docs if first else common.materialize(docs), m)
        first = False
    return docs


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, common.read(spark, sf_dir, "benchmark"))

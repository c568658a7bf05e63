"""Substring dedup by suffix automata: words of long passages that an earlier document has go.

The reference of a document is the corpus itself, which no broadcast can hold. Its shards are therefore not whole
documents but the chunks around shared anchors (see windows.py), co-partitioned with the passages to look up: a shard's
automaton meets all of the corpus that could match it and nothing else. Each shard's generalised suffix automaton takes
its chunks; every state knows the smallest document id among the places of its strings. Streaming a chunk's words through
it gives matching statistics, cut at `window` words, and the smallest id that has each window. A reference of checked
size (`Reference`) can be broadcast and streamed against whole.

Nulls and texts shorter than the window lose nothing; an empty table gives no rows; ties (one passage in several earlier
documents) remove it once; repeated rows of an id do not lose to each other. Extra columns are kept by stage().
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common, windows

WINDOW = 50
GRAM = 8


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of hashables; owner[v] is the least mark of a place of v's strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [1 << 62]

    def _state(self, length: int, link: int, follow: dict) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.owner.append(1 << 62)
        return len(self.next) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state of exactly the strings of q that p reaches by c."""
        nxt, link, length = self.next, self.link, self.length
        if length[q] == length[p] + 1:
            return q
        copy = self._state(length[p] + 1, link[q], dict(nxt[q]))
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def add(self, sequence, mark: int) -> None:
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:
                last = self._split(last, c, q)
            else:
                p, last = last, self._state(length[last] + 1, 0, {})
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = last
                    p = link[p]
                if p >= 0:
                    link[last] = self._split(p, c, nxt[p][c])
            if mark < owner[last]:
                owner[last] = mark

    def finish(self) -> None:
        """Hands marks up the suffix links, longest strings first."""
        link, owner = self.link, self.owner
        for v in np.argsort(-np.array(self.length), kind="stable").tolist():
            u = link[v]
            if u >= 0 and owner[v] < owner[u]:
                owner[u] = owner[v]

    def matches(self, sequence, window: int):
        """For each place, (length of the longest suffix there that the automaton has, at most window; its owner)."""
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        v = n = 0
        for c in sequence:
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v, n = nxt[v][c], n + 1
            if n > window:
                n = window
            while v and length[link[v]] >= n:
                v = link[v]
            yield n, owner[v]


class Reference:
    """A broadcastable reference: sequences of words under a bound of words, for streaming documents against."""

    def __init__(self, texts: list[tuple[int, str]], most_words: int = 2_000_000):
        split = [(i, t.encode().split()) for i, t in texts]
        if sum(len(w) for _, w in split) > most_words:
            raise ValueError("the reference is larger than a broadcast may be; cut it into shards")
        self.automaton = SuffixAutomaton()
        for i, w in split:
            self.automaton.add(w, i)
        self.automaton.finish()

    def spans(self, words: list[bytes], window: int = WINDOW) -> list[tuple[int, int]]:
        """Maximal [a, b) of the words covered by windows that the reference has."""
        ends = [i + 1 for i, (n, _) in enumerate(self.automaton.matches(words, window)) if n == window]
        a, b = windows.merged([{"a": e - window, "b": e} for e in ends])
        return list(zip(a.tolist(), b.tolist(), strict=True))


def kernel(contents: list[bytes], owners: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    automaton, split = SuffixAutomaton(), [c.split(b" ") for c in contents]
    for words, mark in zip(split, owners.tolist(), strict=True):
        automaton.add(words, mark)
    automaton.finish()
    out = []
    for words, n in zip(split, counts.tolist(), strict=True):
        window = len(words) - n + 1
        out.append(np.array([o for m, o in automaton.matches(words, window) if m == window], np.int64))
    return out


def word_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    return windows.spans(docs, "words", window, min(GRAM, window), kernel)


def _kept(units: windows.Units, i: int, cover) -> tuple[np.ndarray, int, int]:
    first, last = int(units.first[i]), int(units.first[i + 1])
    keep = np.ones(last - first, bool)
    for a, b in zip(*windows.merged(cover), strict=True):
        keep[a:b] = False
    return keep, first, last


def digests(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text"):
                units = windows.Units("words", some.column("text"))
                data, rows = units.data.tobytes(), []
                starts, ends = units.starts.tolist(), units.ends.tolist()
                for i, cover in enumerate(some.column("_sparkfolio_cover").to_pylist()):
                    keep, first, last = _kept(units, i, cover)
                    words = [data[starts[j] : ends[j]] for j in (np.flatnonzero(keep) + first).tolist()]
                    rows.append((len(keep), len(keep) - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
                n, gone, digest = zip(*rows, strict=True)
                yield pa.record_batch([some.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(windows.joined(docs, found, "text"), run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return digests(docs, word_spans(docs))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; removed passages are cut from the text (with the space after them); a numeric n_chars follows, of any type."""
    schema = docs.schema
    counted = "n_chars" in schema.names and isinstance(schema["n_chars"].dataType, T.NumericType)

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text"):
                units = windows.Units("words", some.column("text"))
                texts = some.column("text").to_pylist()
                sizes = some.column("n_chars").to_pylist() if counted else [None] * len(texts)
                edges = units.starts.tolist()
                for i, cover in enumerate(some.column("_sparkfolio_cover").to_pylist()):
                    if not cover:
                        continue
                    keep, first, last = _kept(units, i, cover)
                    begin, end = int(units.offsets[i]), int(units.offsets[i + 1])
                    out, at = [], begin
                    for a, b in zip(*windows.merged(cover), strict=True):
                        out.append(units.data[at : edges[first + a]].tobytes())
                        at = edges[first + b] if first + b < last else end
                    out.append(units.data[at:end].tobytes())
                    texts[i] = b"".join(out).decode()
                    sizes[i] = len(texts[i])
                new = {"text": pa.array(texts, pa.string())}
                if counted:
                    new["n_chars"] = pa.array(sizes).cast(some.schema.field("n_chars").type)
                yield pa.record_batch([new.get(f.name, some.column(f.name)) for f in schema], names=schema.names)

    others = [c for c in docs.columns if c != "doc_id"]
    return common.map_arrow(windows.joined(docs, word_spans(docs), *others).select(*docs.columns, "_sparkfolio_cover"), run, schema)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM d, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS i)),
own AS (SELECT k, min(doc_id) AS o FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN own USING (k) WHERE o < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

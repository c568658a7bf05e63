"""Passages of `window` units (bytes or words) that also start in a document with a smaller id.

1. Every window elects one of its k-grams, the leftmost of least hash: equal windows elect the same (winnowing). Consecutive
   windows with the same elected place form a chunk, known by the k-gram's hash, the anchor. Chunks of anchors that occur
   in one document only are dropped. An anchor seen in several documents of a slice of input is known to be shared there
   and then; of it one row a slice goes on to the others' detection, so a passage that a third of all documents hold is
   no hot key.
2. The chunks left are hashed in the texts; equal chunks of an anchor are one, with the smallest id that has it.
3. An anchor whose chunks are all equal is the smallest id's that has it. Chunks of an anchor that differ, each read once from that id's text and cut to the windows that they may have in common (their windows' hashes are compared),
   go to a kernel, in shards of many anchors: for each window it returns the smallest id of any chunk that contains it. Equal windows share an anchor, so shards need nothing of each other.
4. The answers join the chunks' occurrences; windows whose owner is smaller than the document cover what goes.

Rows without an id neither lose nor own anything. Repeated rows of one id do not lose to each other, and texts that share an id
lose what each shares with smaller ids alone. A text is cut and hashed in one piece: its kernels hold some 60 bytes for each of
its own, so that a very long text needs a task of that memory.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bits of a place within a slice, beside which the upper bits of a k-gram's hash are compared.
_PLACE_BITS = np.uint64(30)
_PLACE = np.uint64((1 << 30) - 1)
#: Bytes of chunks that a kernel call takes; one anchor's chunks may be more.
SHARD = 4 << 20

#: (contents, owners, windows of each) -> for each content the owner of each of its windows
Kernel = Callable[[list[bytes], np.ndarray, np.ndarray], list[np.ndarray]]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


class Units:
    """Bytes or words of a slice of texts."""

    def __init__(self, kind: str, texts: pa.Array):
        self.data, self.offsets = common.text_bytes(texts)
        self.prefix = None
        if kind == "words":
            self.starts, self.ends, self.first = common.word_spans(self.data, self.offsets)
        else:
            self.first = self.offsets
        self.kind = kind

    def grams(self, k: int) -> np.ndarray:
        n = int(self.first[-1])
        if n < k:
            return np.empty(0, np.uint64)
        prefix = common.prefix_hash(self.data)
        if self.kind == "words":
            return common.gram_hash(common.run_hash(prefix, self.starts, self.ends), k)
        places = np.arange(n - k + 1)
        return common.run_hash(prefix, places, places + k)

    def chunks(self, window: int, k: int):
        """(row, first unit in the row, number of windows, anchor hash) of each chunk."""
        n, width = int(self.first[-1]), window - k + 1
        none = np.empty(0, np.int64)
        if n < window:
            return none, none, none, np.empty(0, np.uint64)
        grams = self.grams(k)
        row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (_sliding_min(key, width) & _PLACE).astype(np.int64)
        whole = row[: n - window + 1] == row[window - 1 :]
        lead = whole.copy()
        lead[1:] &= ~whole[:-1] | (place[1:] != place[:-1]) | (row[1 : n - window + 1] != row[: n - window])
        at = np.flatnonzero(lead)
        count = np.add.reduceat(whole.astype(np.int64), at) if len(at) else none
        return row[at], at - self.first[row[at]], count, grams[place[at]]

    def content(self, row: int, start: int, units: int) -> bytes:
        a = int(self.first[row]) + start
        if self.kind == "words":
            return b" ".join([self.data[s:e].tobytes() for s, e in zip(self.starts[a : a + units], self.ends[a : a + units], strict=True)])
        return self.data[a : a + units].tobytes()


def _anchors(docs: DataFrame, kind: str, window: int, k: int) -> DataFrame:
    """(anchor, doc, start, n, state): state 0 to be detected, 1 known as shared, 2 for the detection alone."""

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text"):
                row, start, n, anchor = Units(kind, some.column("text")).chunks(window, k)
                ids = some.column("doc_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)[row]
                row, start, n, anchor = row[known], start[known], n[known], anchor[known]
                doc = ids.fill_null(0).to_numpy()[row]
                order = np.lexsort((doc, anchor))
                anchor, doc, start, n = anchor[order], doc[order], start[order], n[order]
                new = np.ones(len(anchor), bool)
                new[1:] = anchor[1:] != anchor[:-1]
                lead = np.flatnonzero(new)
                last = np.append(lead[1:], len(anchor)) - 1 if len(lead) else lead
                shared = doc[lead] != doc[last]
                state = np.repeat(shared, np.diff(np.append(lead, len(anchor)))).astype(np.int32)
                more = lead[shared]
                columns = [np.concatenate([anchor, anchor[more]]).view(np.int64), np.concatenate([doc, doc[more]]), np.concatenate([start, start[more]]), np.concatenate([n, n[more]]), np.concatenate([state, np.full(len(more), 2, np.int32)])]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], names=["anchor", "doc", "start", "n", "state"])

    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "anchor long, doc long, start int, n int, state int")


def _shared(found: DataFrame, partitions: int) -> DataFrame:
    """The chunks (anchor, doc, start, n) whose anchor occurs in two documents or more."""

    def run(batches):
        held: list[np.ndarray] = []

        def settle(x: np.ndarray):
            new = np.ones(x.shape[1], bool)
            new[1:] = x[0, 1:] != x[0, :-1]
            lead = np.flatnonzero(new)
            if not len(lead):
                return x[:4]
            low, high = np.minimum.reduceat(x[1], lead), np.maximum.reduceat(x[1], lead)
            shared = np.repeat(low != high, np.diff(np.append(lead, x.shape[1])))
            return x[:4, (x[4] == 1) | (x[4] == 0) & shared]

        def out(x: np.ndarray):
            return pa.record_batch([pa.array(x[0]), pa.array(x[1]), pa.array(x[2].astype(np.int32)), pa.array(x[3].astype(np.int32))], names=["anchor", "doc", "start", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("anchor", "doc", "start", "n", "state")]))
            x = np.concatenate(held, axis=1) if len(held) > 1 else held[0]
            cut = int(np.searchsorted(x[0], x[0, -1], side="left"))
            held = [x[:, cut:]]
            if cut:
                yield out(settle(x[:, :cut]))
        if held:
            yield out(settle(held[0]))

    key = F.when(F.col("state") == 1, F.xxhash64("doc", "start")).otherwise(F.col("anchor"))
    dealt = found.repartition(partitions, key).sortWithinPartitions("anchor")
    return common.map_arrow(dealt, run, "anchor long, doc long, start int, n int")


def _cut(docs: DataFrame, shared: DataFrame, kind: str, window: int) -> DataFrame:
    """(anchor, hash, doc, own, start, n) of the shared chunks, hash their contents'."""
    wanted = shared.groupBy("doc").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("chunks"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("own"), "text").join(wanted, "doc")

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text"):
                units = Units(kind, some.column("text"))
                prefix = common.prefix_hash(units.data)
                chunks = some.column("chunks")
                counts = pc.list_value_length(chunks).to_numpy()
                flat = chunks.flatten()
                start, n, anchor = (flat.field(i).to_numpy() for i in range(3))
                row = np.repeat(np.arange(some.num_rows), counts)
                a = units.first[row] + start
                b = a + n + window - 1
                inside = b <= units.first[row + 1]
                row, start, n, anchor, a, b = (x[inside] for x in (row, start, n, anchor, a, b))
                if kind == "words":
                    h = common.run_hash(prefix, units.starts, units.ends)
                    sums = np.zeros(len(h) + 1, np.uint64)
                    with np.errstate(over="ignore"):
                        np.cumsum(h * common.powers(common._BASE, len(h)), out=sums[1:])
                    content_hash = common.run_hash(sums, a, b)
                else:
                    content_hash = common.run_hash(prefix, a, b)
                doc, own = some.column("doc").to_numpy()[row], some.column("own").to_numpy()[row]
                columns = [pa.array(anchor), pa.array(content_hash.view(np.int64)), pa.array(doc), pa.array(own), pa.array(start, pa.int32()), pa.array(n, pa.int32())]
                yield pa.record_batch(columns, names=["anchor", "hash", "doc", "own", "start", "n"])

    return common.map_arrow(texts, run, "anchor long, hash long, doc long, own long, start int, n int")


def _contents(docs: DataFrame, chunks: DataFrame, kind: str, window: int) -> DataFrame:
    """(anchor, hash, owner, content, n) of chunks (anchor, hash, first (doc, own, start), n), content from the text of first."""
    wanted = chunks.groupBy(F.col("first.doc").alias("doc"), F.col("first.own").alias("own")).agg(F.collect_list(F.struct("anchor", "hash", "first.start", "n")).alias("chunks"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("own"), "text").join(wanted, ["doc", "own"])

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text"):
                units = Units(kind, some.column("text"))
                chunks = some.column("chunks")
                row = np.repeat(np.arange(some.num_rows), pc.list_value_length(chunks).to_numpy())
                anchor, digest, start, n = (chunks.flatten().field(i) for i in range(4))
                content = [units.content(r, a, m + window - 1) for r, a, m in zip(row.tolist(), start.to_pylist(), n.to_pylist(), strict=True)]
                yield pa.record_batch([anchor, digest, some.column("doc").take(pa.array(row)), pa.array(content, pa.binary()), n], names=["anchor", "hash", "owner", "content", "n"])

    return common.map_arrow(texts, run, "anchor long, hash long, owner long, content binary, n int")


_RUNS = "array<struct<a:int,b:int,owner:long>>"


def _mixed(kind: str, contents: list[bytes], counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each content, the first and last (exclusive) of its windows that another content may have too, by the windows'
    hashes; 0 and 0 for none. The kernel decides on those."""
    units = Units(kind, pa.array(contents, pa.binary()))
    sums = common.prefix_hash(units.data)
    if kind == "words":
        h = common.run_hash(sums, units.starts, units.ends)
        sums = np.zeros(len(h) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(h * common.powers(common._BASE, len(h)), out=sums[1:])
    row = np.repeat(np.arange(len(contents)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = units.first[row] + place
    hashes = common.run_hash(sums, at, at + window)
    order = np.argsort(hashes, kind="stable")
    lead = np.flatnonzero(np.append(True, hashes[order][1:] != hashes[order][:-1]))
    last = np.append(lead[1:], len(row)) - 1
    several = np.zeros(len(row), bool)
    several[order] = np.repeat(row[order[lead]] != row[order[last]], last - lead + 1)
    low, high = np.zeros(len(contents), np.int64), np.zeros(len(contents), np.int64)
    hit = np.flatnonzero(several)
    if len(hit):
        begin = np.flatnonzero(np.append(True, row[hit][1:] != row[hit][:-1]))
        end = np.append(begin[1:], len(hit)) - 1
        low[row[hit[begin]]] = place[hit[begin]]
        high[row[hit[end]]] = place[hit[end]] + 1
    return low, high


def _part(kind: str, content: bytes, a: int, b: int) -> bytes:
    return content[a:b] if kind == "bytes" else b" ".join(content.split(b" ")[a:b])


def _owners(docs: DataFrame, chunks: DataFrame, kind: str, window: int, kernel: Kernel, partitions: int) -> DataFrame:
    """(anchor, hash, runs): the owner of each run of windows of each distinct chunk. Contents are only read where an anchor has
    several."""
    known = common.materialize(chunks.groupBy("anchor", "hash").agg(F.min(F.struct("doc", "own", "start")).alias("first"), F.max("n").alias("n")))
    several = known.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("anchor", F.lit(True).alias("several"))
    split = common.materialize(known.join(several, "anchor", "left"))
    common.discard(known)
    common.release(docs.sparkSession)
    distinct = _contents(docs, split.where("several"), kind, window)
    runs = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"), F.col("first.doc").alias("owner")))
    whole = split.where("several is null").select("anchor", "hash", runs.alias("runs"))

    def answer(x: list[tuple]) -> pa.RecordBatch:
        """x: (anchor, hash, owner, content, n), anchors together. Contents are cut to the windows that others may have; cut
        ones that are equal count as one, with the smallest owner. Other windows belong to their content's owner."""
        counts = np.array([r[4] for r in x], np.int64)
        low, high = _mixed(kind, [r[3] for r in x], counts, window)
        parts: list[bytes | None] = [_part(kind, r[3], a, b - 1 + window) if b else None for r, a, b in zip(x, low.tolist(), high.tolist(), strict=True)]
        owner_of: dict[bytes, int] = {}
        for r, p in zip(x, parts, strict=True):
            if p is not None:
                owner_of[p] = min(owner_of.get(p, r[2]), r[2])
        windows_of = {p: b - a for p, a, b in zip(parts, low.tolist(), high.tolist(), strict=True) if p is not None}
        distinct_parts = list(owner_of)
        answers = kernel(distinct_parts, np.array(list(owner_of.values()), np.int64), np.array([windows_of[p] for p in distinct_parts], np.int64)) if distinct_parts else []
        found = {}
        for p, owner in zip(distinct_parts, answers, strict=True):
            lead = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            found[p] = list(zip(lead.tolist(), [*lead[1:].tolist(), len(owner)], owner[lead].tolist(), strict=True))
        runs = []
        for r, p, a, b in zip(x, parts, low.tolist(), high.tolist(), strict=True):
            if p is None:
                runs.append([(0, r[4], r[2])])
                continue
            some = [(a + s, a + e, o) for s, e, o in found[p]]
            runs.append([*([(0, a, r[2])] if a else []), *some, *([(b, r[4], r[2])] if b < r[4] else [])])
        runs_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("owner", pa.int64())]))
        return pa.record_batch([pa.array([r[0] for r in x], pa.int64()), pa.array([r[1] for r in x], pa.int64()), pa.array([[{"a": a, "b": b, "owner": o} for a, b, o in y] for y in runs], runs_type)], names=["anchor", "hash", "runs"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("anchor", "hash", "owner", "content", "n")), strict=True):
                if held and held[-1][:2] == r[:2]:  # of a repeated row
                    continue
                if size >= SHARD and held[-1][0] != r[0]:
                    yield answer(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[3])
        if held:
            yield answer(held)

    owned = common.map_arrow(distinct.repartition(partitions, "anchor").sortWithinPartitions("anchor", "hash"), run, f"anchor long, hash long, runs {_RUNS}")
    owners = common.materialize(owned.union(whole))
    common.discard(split)
    return owners


def spans(docs: DataFrame, kind: str, window: int, k: int, kernel: Kernel) -> DataFrame:
    """(doc, own, cover): for each document that loses anything, the [a, b) of its units that go; own is its text's hash, which
    tells apart the texts that share an id."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = common.materialize(_shared(_anchors(docs, kind, window, k), partitions))
    common.release(spark)
    chunks = common.materialize(_cut(docs, shared, kind, window))
    common.discard(shared)
    common.release(spark)
    owners = _owners(docs, chunks, kind, window, kernel, partitions)
    common.release(spark)
    lost = F.filter("runs", lambda r: r.owner < F.col("doc"))
    cover = F.transform(lost, lambda r: F.struct((F.col("start") + r.a).alias("a"), (F.col("start") + r.b - 1 + window).alias("b")))
    hit = chunks.select("anchor", "hash", "doc", "own", "start").join(owners, ["anchor", "hash"]).select("doc", "own", cover.alias("cover")).where(F.size("cover") > 0)
    found = common.materialize(hit.groupBy("doc", "own").agg(F.flatten(F.collect_list("cover")).alias("cover")))
    common.discard(chunks, owners)
    common.release(spark)
    return found


def merged(cover) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of [(a, b)], where touching spans are one."""
    if not cover:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = (np.array([c[x] for c in cover], np.int64) for x in "ab")
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.append(True, a[1:] > b[:-1])
    return a[new], b[np.append(np.flatnonzero(new)[1:], len(a)) - 1]


def joined(docs: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """docs with their spans (null: none) as _sparkfolio_cover."""
    lost = found.select(F.col("doc").alias("_sparkfolio_doc"), F.col("own").alias("_sparkfolio_own"), F.col("cover").alias("_sparkfolio_cover"))
    same = (F.col("doc_id").cast("long") == F.col("_sparkfolio_doc")) & (F.xxhash64("text") == F.col("_sparkfolio_own"))
    return docs.select("doc_id", *columns).join(lost, same, "left").drop("_sparkfolio_doc", "_sparkfolio_own")

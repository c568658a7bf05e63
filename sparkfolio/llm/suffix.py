"""Suffix-array dedup of bytes by external induced sorting.

A shard is the concatenation of the chunks around some shared anchors (windows.py). Its suffixes are sorted by induction:
the leftmost S-type (LMS) substrings are sorted and named, the string of names is sorted by recursion, and two passes over
character buckets induce the rest. The buckets are a monotone priority queue of (suffix, common prefix) tuples: tuples
leave it in suffix order and put in those of the suffix one byte longer, always at or beyond the place reached. The queue
keeps `memory` bytes and spills whole buckets to local temporary files, which go when the shard is done. The tuples carry
common-prefix lengths, capped at the window: an induced pair has one more than the least length between its sources.

Once the names are more than NAMES, where a bucket would hold hardly a suffix, the recursion ends in prefix doubling.

Runs of suffixes whose common prefixes reach the window start with one window; the smallest id in a run owns it.

Nulls are empty, texts shorter than the window lose nothing, an empty table gives no rows, repeated rows of an id do not
lose to each other; a passage in several earlier documents goes once. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common, windows

WINDOW = 50
GRAM = 20
NAMES = 1024
_BLOCK = 1 << 16
_FAR = np.int64(1 << 40)


class BucketQueue:
    """Tuples by bucket, first in first out; buckets beyond `memory` bytes in all go to files, the largest first."""

    def __init__(self, memory: int):
        self.memory, self.held, self.folder, self.files = memory, 0, None, 0
        self.blocks: dict[int, list] = {}
        self.sizes: dict[int, int] = {}

    def push(self, bucket: int, tuples: np.ndarray) -> None:
        self.blocks.setdefault(bucket, []).append(tuples)
        self.sizes[bucket] = self.sizes.get(bucket, 0) + tuples.nbytes
        self.held += tuples.nbytes
        while self.held > self.memory and self.sizes:
            most = max(self.sizes, key=self.sizes.get)
            self.folder = self.folder or tempfile.mkdtemp(prefix="suffixes-")
            path = os.path.join(self.folder, f"{self.files}.npy")
            self.files += 1
            kept = [b for b in self.blocks[most] if isinstance(b, str)]
            np.save(path, np.concatenate([b for b in self.blocks[most] if not isinstance(b, str)], axis=1))
            self.blocks[most] = [*kept, path]
            self.held -= self.sizes.pop(most)

    def pop(self, bucket: int):
        """The bucket's blocks in order, also those pushed meanwhile; they leave the queue."""
        while self.blocks.get(bucket):
            block = self.blocks[bucket].pop(0)
            if isinstance(block, str):
                path, block = block, np.load(block)
                os.remove(path)
            else:
                self.sizes[bucket] -= block.nbytes
                self.held -= block.nbytes
                if not self.sizes[bucket]:
                    del self.sizes[bucket]
            for at in range(0, block.shape[1], _BLOCK):
                yield block[:, at : at + _BLOCK]

    def close(self) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


def _range_min(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a..b], both ends in, for pairs of places."""
    table, width = [values], 1
    while 2 * width <= len(values):
        last = table[-1]
        table.append(np.minimum(last[: len(last) - width], last[width:]))
        width *= 2
    level = np.frexp(b - a + 1)[1] - 1
    out = np.empty(len(a), np.int64)
    for k in range(len(table)):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[k][a[at]], table[k][b[at] - (1 << k) + 1])
    return out


class _Inducer:
    """One pass: scanned tuples (suffix, common prefix with the one scanned before) go in, those of longer suffixes come out."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, buckets: int, cap: int, queue: BucketQueue):
        self.text, self.wanted, self.cap, self.queue = text, wanted, cap, queue  # cap 0: the order alone is asked for
        self.since = np.full(buckets, -1, np.int64)  # least common prefix since the bucket's last tuple; -1: none yet

    def scan(self, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        longer = suffixes - 1
        at = np.flatnonzero((suffixes > 0) & self.wanted[longer])
        least = prefixes.min() if len(prefixes) else _FAR
        if not (len(at) or self.cap):
            return
        if len(at):
            bucket = self.text[longer[at]]
            order = np.argsort(bucket, kind="stable")
            at, bucket = at[order], bucket[order]
            lead = np.append(True, bucket[1:] != bucket[:-1])
            if not self.cap:
                tuples = np.stack([longer[at], np.zeros(len(at), np.int64)])
                ends = np.append(np.flatnonzero(lead)[1:], len(at))
                for b, i, j in zip(bucket[lead].tolist(), np.flatnonzero(lead).tolist(), ends.tolist(), strict=True):
                    self.queue.push(b, tuples[:, i:j])
                return
            begin = np.where(lead, 0, np.append(0, at[:-1] + 1))
            common_prefix = _range_min(prefixes, begin, at)
            first = np.flatnonzero(lead)
            before = self.since[bucket[first]]
            common_prefix[first] = np.where(before < 0, -1, np.minimum(common_prefix[first], before))
            common_prefix = np.minimum(common_prefix + 1, self.cap)
            tuples = np.stack([longer[at], common_prefix])
            ends = np.append(first[1:], len(at))
            tail = np.full(len(first), _FAR)
            inner = at[ends - 1] + 1 < len(prefixes)
            if inner.any():
                a = at[ends - 1][inner] + 1
                tail[inner] = _range_min(prefixes, a, np.full(len(a), len(prefixes) - 1))
            self.since = np.where(self.since < 0, -1, np.minimum(self.since, least))
            self.since[bucket[first]] = tail
            for b, i, j in zip(bucket[first].tolist(), first.tolist(), ends.tolist(), strict=True):
                self.queue.push(b, tuples[:, i:j])
        else:
            self.since = np.where(self.since < 0, -1, np.minimum(self.since, least))


def _induce(text, is_s, run, seeds: np.ndarray, prefixes: np.ndarray, cap: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, common prefix of each with the one before) from the LMS suffixes in order."""
    buckets = int(text.max()) + 1
    queue, rising = BucketQueue(memory), None
    rising = _Inducer(text, ~is_s, buckets, cap, queue)
    edges = np.searchsorted(text[seeds], np.arange(buckets + 1))
    larger: list[np.ndarray] = []
    try:
        for c in range(buckets):
            seen = []
            for block in queue.pop(c):
                rising.scan(block[0], block[1])
                seen.append(block)
            larger.append(np.concatenate(seen, axis=1) if seen else np.empty((2, 0), np.int64))
            for at in range(edges[c], edges[c + 1], _BLOCK):
                some = slice(at, min(at + _BLOCK, edges[c + 1]))
                p = prefixes[some].copy()
                if at == edges[c]:
                    p[0] = min(run[larger[c][0, -1]], run[seeds[at]], cap) if larger[c].shape[1] else 0
                rising.scan(seeds[some], p)
    finally:
        queue.close()
    queue = BucketQueue(memory)
    falling = _Inducer(text, is_s, buckets, cap, queue)
    out: list[np.ndarray] = []
    try:
        queue.push(0, np.array([[len(text) - 1], [0]], np.int64))
        falling.since[0] = 0
        for c in range(buckets - 1, -1, -1):
            seen = []
            for block in queue.pop(c):
                falling.scan(block[0], block[1])
                seen.append(block)
            big = larger[c]
            if big.shape[1]:
                down = np.append(big[1, 1:], min(run[big[0, -1]], run[seen[-1][0, -1]], cap) if seen else 0)[::-1]
                back = big[0, ::-1]
                for at in range(0, len(back), _BLOCK):
                    falling.scan(back[at : at + _BLOCK], down[at : at + _BLOCK])
            small = np.concatenate(seen, axis=1)[:, ::-1] if seen else np.empty((2, 0), np.int64)
            if small.shape[1]:
                edge = min(run[big[0, -1]], run[small[0, 0]], cap) if big.shape[1] else 0
                small = np.stack([small[0], np.append(edge, small[1, :-1])])
            out.append(np.concatenate([big, small], axis=1))
            larger[c] = None
    finally:
        queue.close()
    both = np.concatenate(out[::-1], axis=1)
    return both[0], both[1]


def _double(names: np.ndarray, cap: int) -> np.ndarray:
    """Order of the suffixes of names, compared by their first `cap` names at least."""
    rank, n, width = names.astype(np.int64), len(names), 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, key[1:] != key[:-1]))
        if rank[order[-1]] == n - 1 or width >= min(cap, n):
            return order
        width *= 2


def _prefix_lengths(sums: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, cap: int) -> np.ndarray:
    """Common prefix, at most cap, of the suffixes at a and b."""
    low, high = np.zeros(len(a), np.int64), np.minimum(cap, n - np.maximum(a, b))
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = common.run_hash(sums, a, a + mid) == common.run_hash(sums, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def sort_suffixes(text: np.ndarray, cap: int = 1 << 30, memory: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each suffix with the one before) of small integers >= 1. Suffixes that agree in
    their first `cap` values may stand in either order; common prefixes are cut there."""
    text = np.append(text.astype(np.int64), 0)
    n = len(text)
    if n == 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    step = np.sign(np.diff(text))
    turns = np.flatnonzero(step)
    following = turns[np.searchsorted(turns, np.arange(n - 1))]
    is_s = np.append(step[following] > 0, True)
    run = np.append(following - np.arange(n - 1) + 1, 1)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    sums = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(common.mix(text.astype(np.uint64)) * common.powers(common._BASE, n), out=sums[1:])
    roughly, _ = _induce(text, is_s, run, lms[np.argsort(text[lms], kind="stable")], np.zeros(len(lms), np.int64), 0, memory)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = roughly[is_lms[roughly]]
    ends = np.empty(n, np.int64)
    ends[lms] = np.append(lms[1:], n - 1) + 1
    digest = common.run_hash(sums, ordered, ends[ordered])
    name = np.empty(n, np.int64)
    name[ordered] = np.cumsum(np.append(0, digest[1:] != digest[:-1]))
    names = name[lms]
    if names.max() + 1 < len(lms):
        if names.max() < NAMES and len(lms) > 2:
            deeper, _ = sort_suffixes(names + 1, cap, memory)
        else:
            deeper = _double(names, cap)
        ordered = lms[deeper]
    prefixes = np.append(0, _prefix_lengths(sums, ordered[:-1], ordered[1:], n, cap))
    suffixes, prefixes = _induce(text, is_s, run, ordered, prefixes, cap, memory)
    return suffixes[1:], np.append(0, prefixes[2:])


def kernel(contents: list[bytes], owners: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    lengths = np.array([len(c) for c in contents])
    window = int(lengths[0] - counts[0] + 1)
    text = np.frombuffer(b"".join(contents), np.uint8).astype(np.int32) + 2
    starts = np.cumsum(lengths) - lengths
    text = np.insert(text, starts + lengths, 1)  # a separator after each
    starts = starts + np.arange(len(contents))
    suffixes, prefixes = sort_suffixes(text, window)
    owner = np.repeat(owners, lengths + 1)[suffixes]
    lead = np.flatnonzero(np.append(True, prefixes[1:] < window))
    least = np.minimum.reduceat(owner, lead)
    found = np.empty(len(text), np.int64)
    found[suffixes] = np.repeat(least, np.diff(np.append(lead, len(suffixes))))
    return [found[s : s + n] for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]


def byte_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    return windows.spans(docs, "bytes", window, min(GRAM, window), kernel)


def digests(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text"):
                data, offsets = common.text_bytes(some.column("text"))
                rows = []
                for i, cover in enumerate(some.column("_sparkfolio_cover").to_pylist()):
                    a, b = windows.merged(cover)
                    text = data[offsets[i] : offsets[i + 1]]
                    digest, at = hashlib.sha256(), 0
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        digest.update(text[at:x].tobytes())
                        at = y
                    digest.update(text[at:].tobytes())
                    rows.append((len(text), int((b - a).sum()), len(a), digest.hexdigest()))
                n, gone, spans, digest = zip(*rows, strict=True)
                yield pa.record_batch([some.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(windows.joined(docs, found, "text"), run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return digests(docs, byte_spans(docs))


"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets, star-shaped edges.

A document's set is its distinct word shingles (64-bit hashes). One hash function deals the set into BINS bins and keeps
the least value of each; an empty bin borrows from a bin that a fixed random order, its own, names first among the full
ones (optimal densification). Signatures make buckets of 4 bins, and of 2 bins for small sets, whose signatures vary more.

Documents of equal sets are one class, a vertex known by the digest of its set. In each bucket, edges go from CENTRES centres
(those of least hash, and the smallest class) to the others: a bounded number an entry, never a pair of each. An edge needs
fitting sizes and sketches (4 bits a bin) that agree in at least the share that a pair at the threshold falls short of by
chance once in 10^7. Each vertex's most promising edge is confirmed first, on the full sets
(100 * intersection >= threshold * union); then those that join different components. What then shares a mixed bucket of
three or more is joined exactly, on the rarest shingles of each set (prefix filter): every pair that shares a bucket is
tested, is in one component, or is under the threshold by its sizes, its sketches or its rarest shingles.

Components: partitions of edges are contracted to stars where they lie (union-find), then large and small stars alternate.

Nulls: a null text, or one without words, has an empty set and is linked with nothing; a text shorter than a shingle is
one shingle. Empty tables give no rows. Repeated rows and exact copies share a class; an id that stands for several texts
has a row, and a component, for each. Rows without an id link nobody; they take the component of rows with their set. Texts are hashed in slices of
SLICE bytes; a longer one is a slice of its own, of some 100 bytes for each of its own. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BINS = 128
SMALL = 100
CENTRES = 2
SLICE = 1 << 20
#: Sets of fewer shingles than so many are judged by their sketches as by fewer bins.
SKETCHED = 200
#: Up to so many ids whose sets are wanted are broadcast to the texts; more are joined by a shuffle.
BROADCAST_IDS = 100_000
#: Counts by slot put shingles in their order of rarity; where slots are shared the order is another, and no less exact.
SLOTS = 1 << 20
_ORDER = np.argsort(np.random.default_rng(4242).random((BINS, BINS)), axis=1)
_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes in order of row and value, offsets by row)."""
    data, offsets = common.text_bytes(texts)
    data = common.lower_ascii(data)
    starts, ends, first = common.word_spans(data, offsets)
    n = np.diff(first)
    h = common.run_hash(common.prefix_hash(data), starts, ends)
    row = np.repeat(np.arange(len(n)), n)
    grams = common.gram_hash(h, words)
    gram_row = row[: len(grams)]
    whole = gram_row == row[len(row) - len(grams) :]
    values, rows = [grams[whole]], [gram_row[whole]]
    for k in range(1, words):  # the whole sequence of short texts
        short = np.flatnonzero(n == k)
        if len(short):
            at = first[short]
            values.append(common.mix(common.gram_hash(h, k)[at] + np.uint64(k)))
            rows.append(short)
    value, of = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    value, of = value[new], of[new]
    return value, np.searchsorted(of, np.arange(len(n) + 1))


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[rows with a set, BINS]: the least value of each bin, densified."""
    filled = np.flatnonzero(np.diff(offsets))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    dense = np.full(len(offsets) - 1, -1)
    dense[filled] = np.arange(len(filled))
    bins = (values >> _BIN_SHIFT).astype(np.int64)
    key = dense[row] * BINS + bins
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]
    out = np.zeros(len(filled) * BINS, np.uint64)
    full = np.zeros(len(filled) * BINS, bool)
    out[key[lead]], full[key[lead]] = values[lead], True
    out, full = out.reshape(-1, BINS), full.reshape(-1, BINS)
    r, b = np.nonzero(~full)
    for t in range(BINS):
        if not len(r):
            break
        donor = _ORDER[b, t]
        ok = full[r, donor]
        out[r[ok], b[ok]] = common.mix(out[r[ok], donor[ok]] + np.uint64(1))
        r, b = r[~ok], b[~ok]
    return out


def _bands(signature: np.ndarray, width: int) -> np.ndarray:
    n = BINS // width
    parts = signature.reshape(len(signature), n, width)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(np.arange(n, dtype=np.uint64) + np.uint64(1000 * width), (len(signature), n)).copy()
        for i in range(width):
            h = common.mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return h


def _keys(values: np.ndarray, offsets: np.ndarray) -> list[int | None]:
    """64-bit digests of the sets, null for empty ones."""
    edges, raw = offsets.tolist(), values.tobytes()
    return [int.from_bytes(hashlib.blake2b(raw[8 * a : 8 * b], digest_size=8).digest(), "little", signed=True) if b > a else None for a, b in zip(edges, edges[1:], strict=False)]


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, own, n_shingles, v, buckets, sketch) of every document, own its text's hash; for an empty set null v and sketch,
    and no buckets."""

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                values, offsets = shingle_sets(some.column("text"), words)
                sizes = np.diff(offsets)
                sig = signatures(values, offsets)
                both = np.concatenate([_bands(sig, 4), _bands(sig, 2)], axis=1)
                nibbles = (sig & np.uint64(15)).astype(np.uint8)
                packed = (nibbles[:, ::2] << 4 | nibbles[:, 1::2]).tobytes()
                n_bands = np.where(sizes == 0, 0, np.where(sizes < SMALL, both.shape[1], BINS // 4))
                full = sizes[sizes > 0]
                taken = np.arange(both.shape[1]) < n_bands[sizes > 0][:, None]
                at = np.where(sizes > 0, np.cumsum(sizes > 0) - 1, -1).tolist()
                sketch = [None if k < 0 else packed[k * (BINS // 2) : (k + 1) * (BINS // 2)] for k in at]
                columns = [some.column("doc_id"), some.column("own"), pa.array(sizes.astype(np.int64)), pa.array(_keys(values, offsets), pa.int64()), common.list_array(both[taken].view(np.int64) if len(full) else np.empty(0, np.int64), np.append(0, np.cumsum(n_bands)), pa.int64()), pa.array(sketch, pa.binary())]
                yield pa.record_batch(columns, names=["doc_id", "own", "n_shingles", "v", "buckets", "sketch"])

    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("own"), "text"), run, "doc_id long, own long, n_shingles long, v long, buckets array<long>, sketch binary")


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """(v, shingles) of (v, text); a text of another set than v's, whose id v's text shares, gives none."""

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                values, offsets = shingle_sets(some.column("text"), words)
                own = np.array([k == v for k, v in zip(_keys(values, offsets), some.column("v").to_pylist(), strict=True)], bool)
                sets = common.list_array(values.view(np.int64), offsets, pa.int64())
                yield pa.record_batch([some.column("v"), sets], names=["v", "shingles"]).filter(pa.array(own))

    return common.map_arrow(texts, run, "v long, shingles array<long>")


def contract(edges: DataFrame) -> DataFrame:
    """Each partition's edges (a, b) as stars: (vertex, least vertex that it reaches there)."""

    def run(batches):
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while (up := parent.get(x, x)) != root:
                parent[x], x = root, up
            return root

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = top(a), top(b)
                if x < y:
                    parent[y] = x
                elif y < x:
                    parent[x] = y
        stars = [(x, top(x)) for x in list(parent)]
        yield pa.record_batch([pa.array([x for x, _ in stars], pa.int64()), pa.array([y for _, y in stars], pa.int64())], names=["a", "b"])

    return common.map_arrow(edges, run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, component): the smallest vertex that each vertex of edges (a, b) reaches, by contraction and alternating stars."""
    now, mark = common.materialize(contract(edges.select("a", "b")).where("a <> b")), None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = common.materialize(small.where("a <> b").distinct())
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark or now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() and now.join(now.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return now.select(F.col("a").alias("v"), F.col("b").alias("component"))
        mark = new


def _least_agreement(threshold: int) -> np.ndarray:
    """[SKETCHED + 1]: by the smaller set's size, the bins of two sketches that agree with a probability of 1 - 1e-7 at least where
    the sets are similar. Densified bins repeat what others hold: a small set's count as two fifths of its size."""
    p = threshold / 100 + (1 - threshold / 100) / 16
    out = np.zeros(SKETCHED + 1, np.int64)
    for n in range(SKETCHED + 1):
        bins, chance = BINS if n == SKETCHED else max(1, 2 * n // 5), 0.0
        for k in range(bins + 1):
            chance += math.comb(bins, k) * p**k * (1 - p) ** (bins - k)
            if chance > 1e-7:
                out[n] = k * BINS // bins
                break
    return out


def _star_edges(every: DataFrame, centres: DataFrame, threshold: int) -> DataFrame:
    """(a, b, a < b) from the centres of each bucket to its others, where the sizes fit."""
    pairs = every.join(centres, "bucket").select("v", "n", F.explode("centres").alias("c")).where("v <> c.v")
    fits = 100 * F.least("n", "c.n") >= threshold * F.greatest("n", "c.n")
    return pairs.where(fits).select(F.least("v", "c.v").alias("a"), F.greatest("v", "c.v").alias("b")).distinct()


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the 4-bit bins agree, over the last axis."""
    differ = x ^ y
    return ((differ & 15) == 0).sum(-1) + ((differ >> 4) == 0).sum(-1)


def _pairs(entries: DataFrame, reps: DataFrame, sets: DataFrame, threshold: int, partitions: int) -> DataFrame:
    """(a, b) of each bucket's entries (bucket, v, n, most, component) that are in different components, fit in size and whose
    sketches agree. They are compared in blocks where they lie; what does not agree is never a row. Small sets, whose
    sketches say little, are given as sets (v, shingles) and compared in full; of their links, a task gives a spanning forest."""
    least, size, block = _least_agreement(threshold), BINS // 2, 128

    def bucket(v, n, most, component, sketch):
        for i in range(0, len(v), block):
            for j in range(i, len(v), 4 * block):
                x, y = slice(i, i + block), slice(j, j + 4 * block)
                fit = (component[x, None] != component[None, y]) & (n[x, None] <= most[None, y]) & (n[None, y] <= most[x, None])
                r, c = np.nonzero(fit)
                r, c = r + i, c + j
                r, c = r[r < c], c[r < c]
                ok = _agreement(sketch[r], sketch[c]) >= least[np.minimum(np.minimum(n[r], n[c]), SKETCHED)]
                yield v[r[ok]], v[c[ok]]

    def linked(ends: np.ndarray, known: dict[int, np.ndarray], parent: dict[int, int]) -> np.ndarray:
        """Which pairs are to be rows: those not compared in full, and links between what no link of this task joins yet."""

        def top(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        keep = np.ones(ends.shape[1], bool)
        for i, (a, b) in enumerate(ends.T.tolist()):
            x, y = known.get(a), known.get(b)
            if x is None or y is None:
                continue
            if (ra := top(a)) == (rb := top(b)):
                keep[i] = False
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= threshold * (len(x) + len(y) - both)
            if keep[i]:
                parent[ra] = rb
        return keep

    def settle(rows: list[np.ndarray], sketch: np.ndarray, known: dict[int, np.ndarray], parent: dict[int, int]):
        edges = np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1], [True]]))
        found = [x for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) for x in bucket(*(r[lo:hi] for r in rows[1:]), sketch[lo:hi])]
        if found:
            ends = np.stack([np.concatenate([f[k] for f in found]) for k in (0, 1)])
            ends = np.unique(np.sort(ends, axis=0), axis=1)  # what several buckets share is one row
            ends = ends[:, linked(ends, known, parent)]
            yield pa.record_batch([pa.array(ends[0]), pa.array(ends[1])], names=["a", "b"])

    def run(batches):
        held, known, parent = None, {}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in ("bucket", "v", "n", "most", "component")]
            for v, x in zip(rows[1].tolist(), batch.column("shingles"), strict=True):
                if v not in known and x.is_valid:
                    known[v] = x.values.to_numpy()
            sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, size)
            if held is not None:
                rows, sketch = [np.concatenate(x) for x in zip(held[0], rows, strict=True)], np.concatenate([held[1], sketch])
            cut = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
            yield from settle([r[:cut] for r in rows], sketch[:cut], known, parent)
            held = [r[cut:] for r in rows], sketch[cut:]
        if held is not None:
            yield from settle(*held, known, parent)

    dealt = entries.select("bucket", "v", "n", "most", "component").join(reps.select("v", "sketch"), "v").join(sets, "v", "left").repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return common.map_arrow(dealt, run, "a long, b long").distinct()


def _agreeing(edges: DataFrame, reps: DataFrame, threshold: int) -> DataFrame:
    """(a, b, agreement): edges whose sketches do not rule them out."""
    least, size = _least_agreement(threshold), BINS // 2

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, size) for c in "xy")
            agree = _agreement(x, y)
            keep = agree >= least[np.minimum(batch.column("n").to_numpy(), SKETCHED)]
            out = pa.record_batch([batch.column("a"), batch.column("b"), pa.array(agree.astype(np.int32))], names=["a", "b", "agreement"])
            yield out.filter(pa.array(keep))

    known = reps.select("v", "n", "sketch")
    both = edges.join(known.select(F.col("v").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("x")), "a")
    both = both.join(known.select(F.col("v").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("y")), "b")
    return common.map_arrow(both.select("a", "b", F.least("n_a", "n_b").alias("n"), "x", "y"), run, "a long, b long, agreement int")


def shingle_counts(texts: DataFrame, words: int) -> np.ndarray:
    """[SLOTS]: how many shingles of how many documents the low bits of their hashes send to a slot, 0 for a lonely one."""

    def run(batches):
        n = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                values, _ = shingle_sets(some.column("text"), words)
                n += np.bincount((values & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array(at), pa.array(n[at])], names=["slot", "m"])

    found = common.map_arrow(texts, run, "slot long, m long").groupBy("slot").agg(F.sum("m").alias("m")).where("m > 1").toArrow()
    out = np.zeros(SLOTS, np.uint32)
    out[found.column("slot").to_numpy()] = np.minimum(found.column("m").to_numpy(), (1 << 32) - 1)
    return out


def prefixes(texts: DataFrame, words: int, threshold: int, counts: np.ndarray) -> DataFrame:
    """(v, n, most, bucket): the rarest shingles of every set, as buckets. If a bucket is the first shingle that two
    similar sets share, in the order of rarity, then each one's size is at most the other's `most`."""

    def run(batches):
        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                values, offsets = shingle_sets(some.column("text"), words)
                own = np.array([k == v for k, v in zip(_keys(values, offsets), some.column("v").to_pylist(), strict=True)], bool)
                sizes = np.diff(offsets)
                of = np.repeat(np.arange(len(sizes)), sizes)
                rarity = counts[(values & np.uint64(SLOTS - 1)).astype(np.int64)]
                order = np.lexsort((values, rarity, of))
                n = sizes[of]
                left = n - (np.arange(len(of)) - offsets[of])
                most = left * (100 + threshold) // threshold - n
                keep = (100 * most >= threshold * n) & (rarity[order] > 1) & own[of]
                ids = some.column("v").take(pa.array(of[keep]))
                yield pa.record_batch([ids, pa.array(n[keep].astype(np.int64)), pa.array(most[keep].astype(np.int64)), pa.array(values[order][keep].view(np.int64))], names=["v", "n", "most", "bucket"])

    return common.map_arrow(texts, run, "v long, n long, most long, bucket long")


class _Links:
    """Confirmed links and their components so far. No edge is tested twice."""

    def __init__(self, docs: DataFrame, reps: DataFrame, words: int, threshold: int):
        self.docs, self.reps, self.words, self.threshold = docs, reps, words, threshold
        self.good = self.tested = self.sets = self.labels = None

    def texts(self, wanted: DataFrame) -> DataFrame:
        """(v, text) of the wanted vertices, and of other texts under their ids."""
        wanted = common.materialize(self.reps.select("v", "least").join(wanted, "v", "left_semi"))
        if wanted.count() <= BROADCAST_IDS:
            wanted = F.broadcast(wanted)
        return self.docs.select(F.col("doc_id").cast("long").alias("least"), "text").join(wanted, "least").select("v", "text")

    def fetch(self, edges: DataFrame) -> None:
        """Reads the sets of the edges' vertices that are not at hand yet."""
        wanted = edges.select(F.col("a").alias("v")).union(edges.select(F.col("b").alias("v"))).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("v"), "v", "left_anti")
        more = common.materialize(full_sets(self.texts(wanted), self.words))
        self.sets = more if self.sets is None else self.sets.union(more)

    def apart(self, edges: DataFrame) -> DataFrame:
        """Edges between different components that were not tested."""
        if self.tested is not None:
            edges = edges.join(self.tested, ["a", "b"], "left_anti")
        if self.labels is None:
            return edges
        for c in "ab":
            edges = edges.join(self.labels.select(F.col("v").alias(c), F.col("component").alias(f"of_{c}")), c, "left")
        return edges.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).drop("of_a", "of_b")

    def confirm(self, edges: DataFrame) -> bool:
        """Tests the edges (a, b); whether one was confirmed."""
        edges = common.materialize(edges.select("a", "b"))
        self.tested = edges if self.tested is None else self.tested.union(edges)
        if edges.isEmpty():
            return False
        self.fetch(edges)
        size = F.size(F.array_intersect("x", "y"))
        pairs = edges.join(self.sets.select(F.col("v").alias("b"), F.col("shingles").alias("y")), "b").join(self.sets.select(F.col("v").alias("a"), F.col("shingles").alias("x")), "a")
        good = common.materialize(pairs.where(100 * size >= self.threshold * (F.size("x") + F.size("y") - size)).select("a", "b"))
        common.release(self.docs.sparkSession)
        if good.isEmpty():
            return False
        stars = good if self.labels is None else good.union(self.labels.select(F.col("v").alias("a"), F.col("component").alias("b")))
        self.labels = components(stars)
        return True

    def labelled(self, rows: DataFrame) -> DataFrame:
        """rows with the component of their v, itself where it has no link."""
        if self.labels is None:
            return rows.withColumn("component", F.col("v"))
        return rows.join(self.labels, "v", "left").withColumn("component", F.coalesce("component", "v"))


def _finish(live: DataFrame, links: _Links) -> None:
    """Tests what stars left untested: every pair of different components in the buckets of three and more, but those that
    their rarest shingles or their sketches prove to be under the threshold. Stars from the smallest set go first, to spare pairs."""
    entries = links.labelled(live)
    mixed = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high"))
    ids = common.materialize(entries.join(mixed.where("m > 2 and low <> high").select("bucket"), "bucket", "left_semi").select("v").distinct())
    if ids.isEmpty():
        return
    texts = links.texts(ids)
    live = common.materialize(prefixes(texts, links.words, links.threshold, shingle_counts(texts, links.words)))
    for stars in (True, False):
        entries = links.labelled(live)
        mixed = entries.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("most").alias("greatest"))
        mixed = mixed.where("low <> high").select("bucket", "least", "greatest")
        entries = common.materialize(entries.join(mixed, "bucket").where("most >= least and n <= greatest").drop("least", "greatest"))
        if entries.isEmpty():
            return
        live = entries.drop("component")
        if stars:
            centres = entries.groupBy("bucket").agg(F.min(F.struct("n", "v", "most", "component")).alias("c"))
            pairs = entries.join(centres, "bucket").where("component <> c.component and n <= c.most and c.n <= most")
            found = _agreeing(pairs.select(F.least("v", "c.v").alias("a"), F.greatest("v", "c.v").alias("b")).distinct(), links.reps, links.threshold)
        else:
            small = links.texts(entries.where(F.col("n") < SKETCHED).select("v").distinct())
            sets = common.materialize(full_sets(small, links.words).dropDuplicates(["v"]))
            found = _pairs(entries, links.reps, sets, links.threshold, int(live.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        links.confirm(links.apart(found))


def near_duplicates(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return labelled_documents(docs, words, threshold).drop("own")


def labelled_documents(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """near_duplicates() with own, the hash of each row's text."""
    spark = docs.sparkSession
    marked = common.materialize(signed(docs, words))
    common.release(spark)
    # what a class has in common is the same in each of its rows
    alike = [F.first(c).alias(c) for c in ("n", "buckets", "sketch")]
    rows = marked.where("v is not null and doc_id is not null").withColumnRenamed("n_shingles", "n")
    reps = common.materialize(rows.groupBy("v").agg(F.min("doc_id").alias("least"), *alike))
    every = reps.select("v", "n", F.explode("buckets").alias("bucket"))
    orders = [F.col("v"), *(F.xxhash64("v", F.lit(k)) for k in range(1, CENTRES))]
    least = [F.min(F.struct(o.alias("o"), "v", "n")).alias(f"c{k}") for k, o in enumerate(orders)]
    centres = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), *least).where("m > 1")
    distinct = F.array_distinct(F.array(*(F.struct(f"c{k}.v", f"c{k}.n") for k in range(CENTRES))))
    centres = common.materialize(centres.select("bucket", distinct.alias("centres")))
    live = common.materialize(every.join(centres.select("bucket"), "bucket", "left_semi"))
    edges = common.materialize(_agreeing(_star_edges(live, centres, threshold), reps, threshold))
    common.release(spark)
    links = _Links(docs, reps, words, threshold)
    best = [edges.groupBy(x).agg(F.max_by(y, F.struct("agreement", F.xxhash64("a", "b"))).alias(y)).select("a", "b") for x, y in ("ab", "ba")]
    links.confirm(best[0].union(best[1]).distinct())
    links.confirm(links.apart(edges))
    _finish(live, links)
    least_id = links.labelled(reps.select("v", "least"))
    named = least_id.groupBy("component").agg(F.min("least").alias("component_id"))
    named = common.materialize(least_id.join(named, "component").select("v", "component_id"))
    out = marked.select("doc_id", "own", "n_shingles", "v").join(named, "v", "left")
    return out.select("doc_id", "own", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.read(spark, sf_dir, "documents"), words=4)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (its smallest id); documents without words stay. Rows that repeat an id
    stay as they are unless they are equal in every column, which are one row: an id may stand for several texts."""
    found = labelled_documents(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_sparkfolio_doc"), F.col("own").alias("_sparkfolio_own"))
    found = common.materialize(found.distinct())
    same = (F.col("doc_id").cast("long") == F.col("_sparkfolio_doc")) & (F.xxhash64("text") == F.col("_sparkfolio_own"))
    kept = docs.join(found, same, "left_anti").select(*docs.columns)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates().unionByName(kept.where("doc_id is null"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 80 * (nx.n + ny.n - i)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id, r.doc_id = min(c) AS kept FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

"""Byte-level BPE encoding and decoding in Spark's higher-order functions.

A text is cut by the tokenizer's pattern. A word is an array of the ids of its bytes; a fold merges, one after another, the
leftmost pair of least rank until no pair has a rank. The rank map is a literal of the plan (the value of a session
variable): ranks by the ids of a pair's two pieces, in a perfect hash table, so that the fold handles numbers alone.

Distinct words are counted over all texts, and the HOT most frequent ones (a bound on size: by a count from which on they
are at most so many) are folded once and bound likewise; the words of a text are looked up there and folded on the spot
where they are not. Ids are decoded by the pieces of the vocabulary, joined and turned to bytes again.

Nulls and empty texts have no ids. Empty tables give no rows. A word in many texts is counted by partial sums, so no row
gathers. The fold's cost grows with the square of a word's length (not of a text's). Repeated rows are encoded alike, ties of
rank go to the leftmost pair. Extra columns are not read.
"""

from __future__ import annotations

import base64
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_SPACE = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
#: The pattern of the rank files with white space spelt out, as Java's \s is ASCII; alternatives that begin with
#: different characters stand in order of frequency.
PATTERN = rf" ?\p{{L}}++| ?\p{{N}}++|'(?:s|t|re|ve|m|ll|d)| ?[^{_SPACE}\p{{L}}\p{{N}}]++|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
#: Places of the table of frequent words.
HOT_BUCKETS = 1 << 18
#: The same of the table of pieces that no merges lead to.
ODD_BUCKETS = 1 << 12
#: Frequent words that are folded once and bound as a literal: at most so many, of so many bytes in all.
HOT = 3 << 17
HOT_BYTES = 16 << 20
#: The same for the pipeline's stage, whose driver holds more already.
STAGE_HOT = 1 << 17
#: Crc32 of the strings of one and of two bytes differ in these bits.
_CRC_SHIFT, _CRC_BITS = 1, 17


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def literal(one: DataFrame, names: list[str]) -> Column:
    """The value of a table of one row and one column, as a literal of the plans that use it. The variable that holds it is
    added to names; forget() drops it once those plans are made."""
    spark, name = one.sparkSession, f"v_{uuid.uuid4().hex}"
    names.append(name)
    one.createOrReplaceTempView(name)
    spark.sql(f"DECLARE VARIABLE {name} {one.schema[0].dataType.simpleString()}")
    spark.sql(f"SET VAR {name} = (SELECT * FROM {name})")
    spark.catalog.dropTempView(name)
    return F.expr(f"session.{name}")


def forget(spark: SparkSession, names: list[str]) -> None:
    """Drops variables. Plans that were made with them keep their values for as long as they last themselves."""
    while names:
        spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {names.pop()}")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _place(key: Column, buckets: int) -> Column:
    """buckets: a power of two."""
    return F.hash(key).bitwiseAND(F.lit(buckets - 1))


def table(entries: DataFrame, key: str, value: str, buckets: int) -> DataFrame:
    """One row: an array of small maps from key to value, found by a hash of the key."""
    spark = entries.sparkSession
    filled = entries.groupBy(_place(F.col(key), buckets).cast("long").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))
    every = spark.range(buckets).join(filled, "id", "left")
    gathered = every.agg(F.array_sort(F.collect_list(F.struct("id", "m")), lambda a, b: (a.id - b.id).cast("int")).alias("rows"))
    return common.materialize(gathered.select(F.transform("rows", lambda x: x.m).alias("t")))


def _find(found: Column, key: Column, buckets: int) -> Column:
    return F.try_element_at(F.get(found, _place(key, buckets)), key)


_XX = [0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5]


def _xxhash64(x: np.ndarray, seed: np.ndarray | int = 42) -> np.ndarray:
    """Spark's xxhash64 of longs; of several columns, each one's hash is the seed of the next."""

    def turned(v: np.ndarray, n: int) -> np.ndarray:
        return v << np.uint64(n) | v >> np.uint64(64 - n)

    one, two, three, four, five = map(np.uint64, _XX)
    with np.errstate(over="ignore"):
        h = np.asarray(seed, np.uint64) + five + np.uint64(8)
        h = h ^ turned(x.astype(np.uint64) * two, 31) * one
        h = turned(h, 27) * one + four
        h = (h ^ h >> np.uint64(33)) * two
        h = (h ^ h >> np.uint64(29)) * three
        return h ^ h >> np.uint64(32)


def perfect(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A perfect hash of distinct longs: a displacement for each bucket (xxhash64 of the key), and the key's index, or -1, at each
    place (xxhash64 of key and displacement). Both sizes are powers of two."""
    most = 1 << max(4, 2 * len(keys) - 1).bit_length()
    moves, places = np.zeros(most >> 3, np.int64), np.full(most, -1, np.int64)
    first = _xxhash64(keys)
    bucket = (first & np.uint64(len(moves) - 1)).astype(np.int64)
    left = np.arange(len(keys))
    for move in range(1 << 20):
        if not len(left):
            return moves, places
        at = (_xxhash64(np.full(len(left), move), first[left]) & np.uint64(most - 1)).astype(np.int64)
        bad = np.zeros(len(moves), bool)
        bad[bucket[left[places[at] >= 0]]] = True
        # of two buckets that want one place, the one of more keys goes first
        size = np.bincount(bucket[left], minlength=len(moves))
        order = np.lexsort((bucket[left], -size[bucket[left]]))
        order = order[~bad[bucket[left[order]]]]
        _, taken = np.unique(at[order], return_index=True)
        lost = np.ones(len(order), bool)
        lost[taken] = False
        bad[bucket[left[order[lost]]]] = True
        good = ~bad[bucket[left]]
        places[at[good]], moves[bucket[left[good]]] = left[good], move
        left = left[~good]
    raise ValueError("no perfect hash was found")


class Vocabulary:
    """Literals: pairs and moves (ranks by two ids in a perfect hash table), starts (by the crc32 of two bytes, or of a word's last
    one, the pair's rank and the first byte's id), and for each id its little-endian bytes and, if asked for, its piece, as
    strings of bytes. odd: pieces that no merges lead to, which only whole words are."""

    def __init__(self, spark: SparkSession, path: str, decodes: bool = True):
        ranks = load_ranks(path)
        n = len(ranks)
        if sorted(ranks.values()) != list(range(n)):
            raise ValueError("ids are not gapless")
        self.id_bits = n.bit_length()
        self.none = 1 << self.id_bits  # no rank: above all ranks
        self.high = 62 - self.id_bits  # a number of the fold: rank from here on, place, id
        pairs: dict[int, int] = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    pairs[a << self.id_bits | b] = rank
        single = [ranks[bytes([i])] for i in range(256)]
        odd = [(p, r) for p, r in ranks.items() if self._merged(p, pairs, single) != [r]]
        keys = np.array(list(pairs), np.int64)
        moves, places = perfect(keys)
        entries = np.where(places < 0, (1 << 63) - 1, np.append(keys << self.id_bits | np.array(list(pairs.values()), np.int64), 0)[places])
        starts = np.zeros(1 << _CRC_BITS, np.int64)
        for i, a in enumerate(single):
            starts[self._crc_place(bytes([i]))] = self.none << self.high | a
            for j, b in enumerate(single):
                starts[self._crc_place(bytes([i, j]))] = pairs.get(a << self.id_bits | b, self.none) << self.high | a
        self.moves_mask, self.places_mask = len(moves) - 1, len(places) - 1
        by_id = sorted(ranks, key=ranks.get)
        self.names: list[str] = []

        def held(values, kind: pa.DataType) -> Column:
            return literal(spark.createDataFrame(pa.table({"x": pa.array([values], pa.list_(kind))})), self.names)

        def strings(values: list[bytes]) -> Column:
            one = spark.createDataFrame(pa.table({"x": pa.array([values], pa.list_(pa.binary()))}))
            return literal(common.materialize(one.select(F.transform("x", lambda v: v.cast("string")).alias("x"))), self.names)

        self.moves, self.pairs, self.starts = (held(x, pa.int64()) for x in (moves, entries, starts))
        self.little = strings([r.to_bytes(4, "little") for r in range(n)])
        self.pieces = strings(by_id) if decodes else None
        self.odd = literal(table(spark.createDataFrame(odd, "piece binary, rank int"), "piece", "rank", ODD_BUCKETS), self.names) if odd else None

    @staticmethod
    def _crc_place(some: bytes) -> int:
        return zlib.crc32(some) >> _CRC_SHIFT & (1 << _CRC_BITS) - 1

    def _merged(self, piece: bytes, pairs: dict[int, int], single: list[int]) -> list[int]:
        ids, bits = [single[x] for x in piece], self.id_bits
        while len(ids) > 1:
            rank, i = min((pairs.get(a << bits | b, self.none), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
            if rank == self.none:
                break
            ids[i : i + 2] = [rank]
        return ids


def fold(vocabulary: Vocabulary, word: Column) -> Column:
    """Ids of a word. The state is an array of its pieces, each a number: the rank of the pair that it makes with the next
    piece, above the place of its first byte and its own id, so that the least number is the leftmost pair of least rank. The
    first and the last number are no pieces."""
    bits, high = vocabulary.id_bits, vocabulary.high
    none, no_piece = vocabulary.none << high, vocabulary.none << high | vocabulary.none - 1

    def id_of(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << bits) - 1))

    def paired(a: Column, b: Column) -> Column:
        """The rank of the pair of two ids, in its place of a number. Another pair's entry differs above the rank's bits."""

        def looked_up(key: Column) -> Column:
            move = F.get(vocabulary.moves, F.xxhash64(key).bitwiseAND(F.lit(vocabulary.moves_mask)).cast("int"))
            entry = F.get(vocabulary.pairs, F.xxhash64(key, move).bitwiseAND(F.lit(vocabulary.places_mask)).cast("int"))
            return F.shiftleft(F.least(entry.bitwiseXOR(F.shiftleft(key, bits)), F.lit(vocabulary.none)), high)

        return let(F.shiftleft(a, bits).bitwiseOR(b), looked_up)

    def merge(state: Column, low: Column) -> Column:
        def at(k: Column) -> Column:  # k: where the pair stands, from 1; never the first, as that one has no rank
            own, before = F.shiftright(low, high), F.get(state, k - 2)
            left = paired(id_of(before), own).bitwiseOR(before.bitwiseAND(F.lit((1 << high) - 1)))
            right = paired(own, id_of(F.get(state, k + 1))).bitwiseOR(low.bitwiseAND(F.lit((1 << high) - (1 << bits)))).bitwiseOR(own)
            return F.concat(F.slice(state, 1, k - 2), F.array(left, right), F.slice(state, k + 2, F.size(state)))

        return let(F.array_position(state, low).cast("int"), at)

    def step(state: Column, _: Column) -> Column:
        return let(F.array_min(state), lambda low: F.when(low < none, merge(state, low)).otherwise(state))

    def folded(key: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(key))

        def begun(i: Column) -> Column:
            place = F.shiftright(F.crc32(F.substring(key, i, F.lit(2))), _CRC_SHIFT).bitwiseAND(F.lit((1 << _CRC_BITS) - 1))
            return F.get(vocabulary.starts, place.cast("int")).bitwiseOR(F.shiftleft(i.cast("long"), bits))

        end = F.array(F.lit(no_piece))
        start = F.concat(end, F.transform(places, begun), end)
        return F.aggregate(F.slice(places, 2, F.length(key)), start, step, lambda s: F.transform(F.slice(s, 2, F.size(s) - 2), lambda x: id_of(x).cast("int")))

    def coded(key: Column) -> Column:
        if vocabulary.odd is None:
            return folded(key)
        return let(_find(vocabulary.odd, key, ODD_BUCKETS), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(folded(key)))

    return let(F.encode(word, "UTF-8"), coded)


def words(text: Column, pattern: str = PATTERN) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def _joined(strings: Column, ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: F.get(strings, i)), "")


def hot_words(docs: DataFrame, vocabulary: Vocabulary, pattern: str = PATTERN, most: int = HOT, most_bytes: int = HOT_BYTES) -> DataFrame:
    """One row: a table from a frequent word to (ids, bytes of its ids' pieces if the vocabulary decodes)."""
    counts = docs.select(F.explode(words(F.col("text"), pattern)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = common.materialize(counts.where("n > 1"))
    common.release(docs.sparkSession)
    least, held, size = 1 << 62, 0, 0
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word")).alias("bytes"))
    for r in by_count.orderBy(F.desc("n")).limit(most).toLocalIterator():
        if held + r.words > most or size + r.bytes > most_bytes:
            break
        least, held, size = r.n, held + r.words, size + r.bytes
    chosen = counts.where(F.col("n") >= least).repartition("word").select("word", _coded(vocabulary, F.col("word")).alias("coded"))
    return table(chosen, "word", "coded", HOT_BUCKETS)


def _coded(vocabulary: Vocabulary, word: Column) -> Column:
    """(little-endian ids, bytes of their pieces if the vocabulary decodes) of a word, both as strings of bytes."""
    strings = {"little": vocabulary.little} | ({} if vocabulary.pieces is None else {"decoded": vocabulary.pieces})
    return let(fold(vocabulary, word), lambda ids: F.struct(*(_joined(x, ids).alias(k) for k, x in strings.items())))


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str = PATTERN, ids: str = "ids", decoded: str | None = None, most: int = HOT) -> DataFrame:
    """docs with the ids of their texts, as little-endian unsigned 32-bit integers in a binary column, and if asked for with
    the bytes that the ids stand for. The session forgets the vocabulary then."""
    names: list[str] = []
    hot = literal(hot_words(docs.select("text"), vocabulary, pattern, most), names)
    found = F.transform(words(F.col("text"), pattern), lambda w: F.coalesce(_find(hot, w, HOT_BUCKETS), _coded(vocabulary, w)))

    def both(x: Column) -> Column:
        little = F.array_join(x["little"], "").cast("binary").alias("little")
        return F.struct(little, *([F.array_join(x["decoded"], "").cast("binary").alias("decoded")] if decoded else []))

    out = docs.withColumn("_sparkfolio_coded", let(found, both))
    forget(docs.sparkSession, names + vocabulary.names)
    columns = {ids: "little"} | ({decoded: "decoded"} if decoded else {})
    return out.select(*docs.columns, *(F.col(f"_sparkfolio_coded.{c}").alias(n) for n, c in columns.items()))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of an array of ids."""
    return _joined(vocabulary.pieces, ids).cast("binary")


def _path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return path


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    done = encode(common.read(spark, sf_dir, "documents").select("doc_id", "text"), Vocabulary(spark, _path(path)), decoded="decoded")
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def stage(spark, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """The documents with their ids (packed, little-endian, 32 bits) as `ids`, or ids_1 and so on where docs has that name already."""
    name, k = "ids", 0
    while name in {c.lower() for c in docs.columns}:
        k += 1
        name = f"ids_{k}"
    return encode(docs, Vocabulary(spark, _path(path), decodes=False), ids=name, most=STAGE_HOT)

"""Token ids in files of range asymmetric numeral systems (rANS) with static, shared frequency tables.

A file set has a table (id, freq; frequencies sum to 2**PRECISION, taken from counts over all ids) and block rows.
A block holds whole documents, about BLOCK ids of them, and decodes without any other block. Inside it, every
SEGMENT ids begin at a checkpoint (lane states and the place of their words), so that segments decode in parallel;
here they are the rows of one matrix, LANES interleaved states wide. A crc32 covers the payload, and each lane must
end in the state that the encoder began with.

Nulls: a null text is empty and gets the end id alone; a null id sorts first. Empty tables give empty file sets.
Repeated rows are all written. A very long document makes a block of its own, of many segments. Extra columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

PRECISION = 20
LANES = 64
STEPS = 256
SEGMENT = LANES * STEPS
BLOCK = 32 * SEGMENT
#: Bytes of text whose distinct words are looked up together.
SLICE = 24 << 20
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIQIII")  # magic, precision, ids, segments, steps, crc32 of the rest


def normalise(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Frequencies that sum to 2**precision, at least 1 where a count is; ties go to the smaller id."""
    counts = counts.astype(np.int64)
    used = np.flatnonzero(counts)
    total = 1 << precision
    if len(used) > total:
        raise ValueError("more symbols than the precision can hold")
    freq = np.zeros(len(counts), np.int64)
    if not len(used):
        return freq
    exact = counts[used] / counts[used].sum() * (total - len(used))
    share = np.floor(exact).astype(np.int64)
    short = total - len(used) - int(share.sum())
    share[np.argsort(-(exact - share), kind="stable")[:short]] += 1
    freq[used] = share + 1
    return freq


def encode(ids: np.ndarray, freq: np.ndarray, precision: int = PRECISION) -> bytes:
    n = len(ids)
    segments = max(1, -(-n // SEGMENT))
    steps = STEPS if segments > 1 else -(-n // LANES)
    padded = np.full(segments * steps * LANES, int(np.argmax(freq)) if len(freq) else 0, np.int64)
    padded[:n] = ids
    symbols = padded.reshape(segments, steps, LANES)
    if n and (freq[symbols] == 0).any():
        raise ValueError("an id is not in the frequency table")
    freq64 = freq.astype(np.uint64)
    cum64 = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else np.zeros(0, np.uint64)
    room = steps * LANES
    words = np.zeros((segments, room), np.uint32)
    flat = words.reshape(-1)
    left = np.arange(1, segments + 1, dtype=np.int64) * room  # streams grow downwards
    state = np.full((segments, LANES), _LOW, np.uint64)
    shift, thirty_two, limit = np.uint64(precision), np.uint64(32), np.uint64(63 - precision)
    rows, count = np.arange(segments + 1) * LANES, np.arange(segments * LANES)
    for s in range(steps - 1, -1, -1):
        symbol = symbols[:, s, :]
        f = freq64.take(symbol)
        out = np.flatnonzero(state >= (f << limit))
        edges = np.searchsorted(out, rows)
        n_out = np.diff(edges)
        left -= n_out
        full = state.reshape(-1)
        high = full.take(out)
        flat[np.repeat(left - edges[:-1], n_out) + count[: len(out)]] = high
        full[out] = high >> thirty_two
        q = state // f
        state = (q << shift) + (state - q * f) + cum64.take(symbol)
    used = np.arange(1, segments + 1, dtype=np.int64) * room - left
    body = b"".join([used.astype("<u4").tobytes(), state.astype("<u8").tobytes(), *(flat[left[j] : (j + 1) * room].astype("<u4").tobytes() for j in range(segments))])
    return _HEAD.pack(b"rans", precision, n, segments, steps, zlib.crc32(body)) + body


def decode(payload: bytes, freq: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of segments first to last (exclusive; all by default), decoded from their checkpoints."""
    magic, precision, n, segments, steps, crc = _HEAD.unpack_from(payload)
    body = memoryview(payload)[_HEAD.size :]
    if magic != b"rans" or zlib.crc32(body) != crc:
        raise ValueError("the block is damaged")
    last = segments if last is None else last
    lengths = np.frombuffer(body, "<u4", segments).astype(np.int64)
    states = np.frombuffer(body, "<u8", segments * LANES, segments * 4).reshape(segments, LANES)
    words = np.frombuffer(body, "<u4", -1, segments * (4 + 8 * LANES))
    at = (np.cumsum(lengths) - lengths)[first:last]
    state = states[first:last].astype(np.uint64)
    out = np.empty((last - first, steps, LANES), np.uint32)
    if steps:
        freq64 = freq.astype(np.uint64)
        cum64 = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        symbol_of = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        mask, shift, thirty_two = np.uint64((1 << precision) - 1), np.uint64(precision), np.uint64(32)
        rows, count = np.arange(last - first + 1) * LANES, np.arange((last - first) * LANES)
        for s in range(steps):
            slot = state & mask
            symbol = symbol_of.take(slot.view(np.int64)).astype(np.int64)
            out[:, s, :] = symbol
            state = freq64.take(symbol) * (state >> shift) + slot - cum64.take(symbol)
            full = state.reshape(-1)
            low = np.flatnonzero(full < _LOW)
            edges = np.searchsorted(low, rows)
            n_low = np.diff(edges)
            full[low] = (full.take(low) << thirty_two) | words.take(np.repeat(at - edges[:-1], n_low) + count[: len(low)])
            at = at + n_low
    if (state != _LOW).any():
        raise ValueError("a lane ends in a wrong state")
    return out.reshape(-1)[: max(0, min(n, last * steps * LANES) - first * steps * LANES)]


# --- tokens -----------------------------------------------------------------------------------


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones for themselves, the rest from U+0100 on."""
    out, spare = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


def _kinds() -> np.ndarray:
    """Of a UTF-8 byte: 1 in a letter of ASCII or U+00C0 to U+017F, 2 an ASCII sign but the apostrophe, 3 an ASCII digit, 0 any other."""
    out = np.zeros(256, np.uint8)
    out[33:127] = 2
    out[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = 1
    out[48:58] = 3
    out[39] = 0
    return out


_KIND = _kinds()
#: Second byte by first: no letters (multiplication and division signs), and a capital whose small form is two characters.
_ODD = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


class Known:
    """An Arrow table of strings and their ids (little-endian unsigned 32-bit integers), which learns the strings that it lacks.
    When it holds more than `most` strings, or 64 bytes for each of these, it begins anew."""

    def __init__(self, learn, most: int):
        self.learn, self.most = learn, most
        self.clear()

    def clear(self) -> None:
        self.strings, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def look_up(self, strings: pa.Array) -> pa.Array:
        """The ids of each string; every distinct one is looked up once."""
        coded = strings.dictionary_encode()
        if len(self.strings) > self.most or self.strings.nbytes + self.ids.nbytes > 64 * self.most:
            self.clear()
        place = pc.index_in(coded.dictionary, value_set=self.strings)
        new = pc.is_null(place)
        unknown = coded.dictionary.filter(new)
        at = np.array(pc.fill_null(place, 0).to_numpy(), np.int64)
        if len(unknown):
            at[new.to_numpy(zero_copy_only=False)] = len(self.strings) + np.arange(len(unknown))
            self.strings, self.ids = pa.concat_arrays([self.strings, unknown]), pa.concat_arrays([self.ids, self.learn(unknown)])
        return self.ids.take(pa.array(at[coded.indices.to_numpy()]))


class WordTable:
    """Ids of words, the pieces of text between ASCII white space. The tokenizer drops white space, and neither a rule of its nor
    an added token reaches across it, so that words are encoded alone; known ones are kept.

    It takes a word of ASCII signs, digits and letters up to U+017F for runs of small letters, runs of signs and single digits,
    each alone: these go straight to its model, many in one call. All else, added tokens and apostrophes among it, goes
    through the whole tokenizer."""

    def __init__(self, path: str, most: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = _byte_letters()
        self.letters = np.array([ord(letters[b]) if b != 32 else 32 for b in range(256)], "<u2")
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words, self.runs = Known(self._words, most // 2), Known(self._runs, most)

    def _runs(self, runs: pa.Array) -> pa.Array:
        every = np.append(np.arange(0, len(runs), 4096), len(runs))
        data, offsets = common.text_bytes(pc.binary_join(pa.ListArray.from_arrays(pa.array(every, pa.int32()), runs), pa.scalar(" ", runs.type)))
        texts = [self.letters[data[a:b]].tobytes().decode("utf-16-le") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.model.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(runs) or ends[-1] != len(ids):
            raise ValueError("the tokenizer's model does not mark the ends of runs")
        return _binaries(ids, 4 * np.append(0, ends))

    def _whole(self, words: pa.Array) -> pa.Array:
        ids = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return _binaries(np.concatenate([np.empty(0, "<u4"), *ids]), 4 * np.append(0, np.cumsum([len(i) for i in ids], dtype=np.int64)))

    def _words(self, words: pa.Array) -> pa.Array:
        data, offsets = common.text_bytes(words)
        other = _KIND[data] == 0
        for first, second in _ODD:
            other[1:] |= (data[:-1] == first) & (data[1:] == second)
        before = np.append(0, np.cumsum(other))
        plain = before[offsets[1:]] == before[offsets[:-1]]
        for t in self.added:
            plain &= ~pc.match_substring(words, t).to_numpy(zero_copy_only=False)
        data, offsets = common.text_bytes(pc.utf8_lower(words.filter(pa.array(plain))))
        kind = _KIND[data]
        begins = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == 3))[: len(kind)]
        begins[offsets[:-1]] = True
        starts = np.append(np.flatnonzero(begins), len(data))
        ids, ends = common.text_bytes(self.runs.look_up(_strings(data, starts)))
        found = _binaries(ids, ends[np.searchsorted(starts, offsets)])
        order = np.empty(len(words), np.int64)
        order[np.append(np.flatnonzero(plain), np.flatnonzero(~plain))] = np.arange(len(words))
        return pa.concat_arrays([found, self._whole(words.filter(pa.array(~plain)))]).take(pa.array(order))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets by text)."""
        data, offsets = common.text_bytes(texts)
        starts, ends, first = common.word_spans(data, offsets)
        inside = ~common.is_space(data)
        ids, at = common.text_bytes(self.words.look_up(_strings(data[inside], np.append(0, np.cumsum(ends - starts)))))
        return ids.view("<u4"), at[first] // 4


_CACHES: dict[str, WordTable] = {}
_BLOCKS = "part int, block int, doc_ids array<long>, lengths array<int>, ids binary, used array<int>, counts array<long>"


def token_blocks(docs: DataFrame, tokenizer_path: str, end_id: int, partitions: int) -> DataFrame:
    """Documents in ascending id order as blocks of whole documents: (part, block, doc_ids, lengths, ids), and each block's
    distinct ids (used) with their counts."""

    def run(batches):
        cache = _CACHES.get(tokenizer_path) or _CACHES.setdefault(tokenizer_path, WordTable(tokenizer_path))
        part, block, held, size = TaskContext.get().partitionId(), 0, [], 0
        end = np.array([end_id], "<u4").tobytes()

        def row():
            ids = b"".join([x for _, x in held])
            n = np.bincount(np.frombuffer(ids, "<u4"))
            used = np.flatnonzero(n)
            return pa.record_batch(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                    pa.array([[len(x) // 4 for _, x in held]], pa.list_(pa.int32())), pa.array([ids], pa.binary()),
                    pa.array([used], pa.list_(pa.int32())), pa.array([n[used]], pa.list_(pa.int64())),
                ],
                names=["part", "block", "doc_ids", "lengths", "ids", "used", "counts"],
            )

        for batch in batches:
            for some in common.pieces(batch, "text", SLICE):
                ids, offsets = cache.encode(some.column("text"))
                for d, a, b in zip(some.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    held.append((d, ids[a:b].tobytes() + end))
                    size += b - a + 1
                    if size >= BLOCK:
                        yield row()
                        block, held, size = block + 1, [], 0
        if held:
            yield row()

    ordered = docs.select("doc_id", "text").repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    return common.map_arrow(ordered, run, _BLOCKS)


def frequencies(blocks: DataFrame, vocabulary: int) -> np.ndarray:
    """Counts of every id over all blocks, normalised; the driver gets a row an id of the vocabulary at most."""

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("used").flatten().to_numpy(), batch.column("counts").flatten().to_numpy())
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    for r in common.map_arrow(blocks.select("used", "counts"), count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r.id] = r.n
    return normalise(counts)


def write(blocks: DataFrame, vocabulary: int, path: str) -> None:
    freq = frequencies(blocks, vocabulary)
    used = np.flatnonzero(freq)
    spark = blocks.sparkSession
    table = pa.table({"id": pa.array(used.astype(np.int32)), "freq": pa.array(freq[used])})
    spark.createDataFrame(table, "id int, freq long").coalesce(1).write.parquet(f"{path}/table")
    counts = blocks.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()
    starts, at = {}, 0
    for r in sorted(counts, key=lambda r: r.part):
        starts[r.part], at = at, at + r.n

    def run(batches):
        for batch in batches:
            data, offsets = common.text_bytes(batch.column("ids"))
            payload = [encode(data[a:b].view("<u4"), freq) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            first = [starts[p] for p in batch.column("part").to_pylist()]
            yield pa.record_batch([*(batch.column(c) for c in ("part", "block", "doc_ids", "lengths")), pa.array(first, pa.int64()), pa.array(payload, pa.binary())], names=["part", "block", "doc_ids", "lengths", "part_start", "payload"])

    common.map_arrow(blocks.select("part", "block", "doc_ids", "lengths", "ids"), run, _FILES).write.option("compression", "none").parquet(f"{path}/blocks")


_FILES = "part int, block int, doc_ids array<long>, lengths array<int>, part_start long, payload binary"


def read_documents(spark, path: str) -> DataFrame:
    """(doc_id, start, ids as little-endian unsigned 32-bit integers) of every document, from the files."""
    table = spark.read.schema("id int, freq long").parquet(f"{path}/table").collect()
    freq = np.zeros(max((r.id for r in table), default=-1) + 1, np.int64)
    for r in table:
        freq[r.id] = r.freq
    blocks = spark.read.schema(_FILES).parquet(f"{path}/blocks")
    sizes = blocks.select("part", "block", "part_start", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    order = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "block", (F.col("part_start") + F.coalesce(F.sum("n").over(order), F.lit(0))).alias("start"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = decode(batch.column("payload")[i].as_py(), freq)
                lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
                ends = np.cumsum(lengths)
                start = batch.column("start")[i].as_py() + ends - lengths
                raw = ids.astype("<u4").tobytes()
                each = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.record_batch([pa.array(batch.column("doc_ids")[i].as_py(), pa.int64()), pa.array(start, pa.int64()), pa.array(each, pa.binary())], names=["doc_id", "start", "ids"])

    placed = blocks.join(starts, ["part", "block"]).select("doc_ids", "lengths", "start", "payload")
    return common.map_arrow(placed, run, "doc_id long, start long, ids binary")


def query(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = f"{common.scratch_dir(spark)}/rans"
    docs = common.read(spark, sf_dir, "documents")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = common.materialize(token_blocks(docs, tokenizer_path or public_tokenizers.path("word_bpe_49k.json"), 1, partitions))
    write(blocks, 49408, path)
    common.release(spark)
    return read_documents(spark, path).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))

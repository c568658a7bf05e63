"""Each query over small tables with nulls, empty and odd texts, ties, repeated rows and clashing columns, against brute force."""

import base64
import collections
import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException

from sparkfolio.llm import automata, bpe, common, decontam, host_rules, langid, minhash, quotes, rans, reshard, suffix

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, ids string, doc string, component string"


def _texts():
    r = random.Random(7)
    syllables = ["the", "ing", "er", "an", "tion", "ß", "é", "of", "Re", "a", "x9"]

    def prose(n):
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) + r.choice(["", "", ".", ","]) for _ in range(n))

    base = [prose(n) for n in (300, 120, 80, 55, 50, 49, 10, 4, 3, 1)]
    passage = prose(70)
    near = base[0].split(" ")
    near[150] = "changed"
    return [
        *base, base[0], base[0].upper(), " ".join(near), base[2], base[2], prose(60) + " " + passage, passage + "\n" + prose(20), prose(5) + "\t" + passage, "", None, " \n\t ", "!!! ### 123",
        "word " * 200, "a" * 300, "a" * 260, "日本語の文章 " * 20, "line one here\nline two\nline one here\n\nline one here", prose(2000), "it's don't we'll 'S 12345    x", "é ﬁ ẞ İ \U0001f600 \x85 \x1c",
    ]


def _rows():
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], None if t is None else len(t), "x", "y", "z", "w") for i, t in enumerate(_texts())]
    return rows


def _write(spark, path, rows, benchmark=()):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows = _rows()
    item = rows[0][1][200:400]
    return _write(spark, tmp_path_factory.mktemp("some"), rows, [(1, item), (2, None), (3, "short"), (4, item), (5, "nowhere " * 30)])


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return _write(spark, tmp_path_factory.mktemp("none"), [])


def _by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("q", [decontam.query, host_rules.query, langid.query, reshard.query, suffix.query, minhash.query, bpe.query, rans.query, automata.query])
def test_empty_tables(nothing, spark, q):
    assert q(spark, nothing).collect() == []


def test_decontam(spark, tables):
    found = {(r.doc_id, r.item_id): r.distance for r in decontam.query(spark, tables).collect()}
    item = decontam.normal(_rows()[0][1][200:400])
    want = {}
    for i, t, *_ in _rows():
        if t and len(t) > 100:
            near = _distance(item, decontam.normal(t))[0]
            if near <= len(item) // decontam.CHARS_PER_EDIT:
                want |= {(i, 1): near, (i, 4): near}
    assert found == want and {(0, 1), (10, 4), (12, 1)} <= set(found)
    kept = {r.doc_id for r in decontam.stage(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables).collect()}
    assert kept == set(range(len(_rows()))) - {d for d, _ in found}


def _distance(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row), row.index(min(row))


def test_myers():
    r = random.Random(3)
    for _ in range(300):
        p, t = ("".join(r.choice("abc") for _ in range(r.randint(*n))) for n in ((1, 12), (0, 30)))
        assert decontam.myers(p, t, 99) == _distance(p, t)


def test_pigeonhole_finds_edited_items():
    r = random.Random(5)
    item = "".join(r.choice("abcdefghij ") for _ in range(200)).strip()
    m = decontam.Matcher([(9, decontam.normal(item))])
    text = list(decontam.normal(item))
    for at in r.sample(range(len(text)), len(text) // decontam.CHARS_PER_EDIT):
        text[at] = "#"
    assert [x[0] for x in m.matches("zz " * 50 + "".join(text) + " yy" * 9)] == [9]
    assert m.matches("nothing of it " * 99) == []


def test_host_rules(spark, tables):
    got = _by_id(host_rules.query(spark, tables))
    for i, t, *_ in _rows():
        t = t or ""
        words = [w.decode() for w in WORDS.findall(t.encode())]
        windows = collections.Counter(tuple(words[j : j + 3]) for j in range(len(words) - 2))
        covered = {j + k for j in range(len(words) - 2) if windows[tuple(words[j : j + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORDS.search(x.encode())]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[i][1:6]) == want, i
        assert got[i].base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert got[i].kept == (not got[i].base_failed and not got[i].host_rejected)


def test_host_verdict_shrinks(spark):
    rows = [("bad", True)] * 40 + [("good", False)] * 40 + [("few", True)] + [(None, False)] * 9
    v = {r.host: r for r in host_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert v["bad"].host_rejected and not v["good"].host_rejected and not v[None].host_rejected
    assert v["few"].rate < v["bad"].rate


def test_langid(spark, tables, tmp_path):
    got = _by_id(langid.query(spark, tables))
    assert len(got) == len(_rows())
    for i, t, *_ in _rows():
        letters = any(c.isalpha() for c in t or "")
        assert (got[i].lang_pred == "und") == (not letters) and 0 <= got[i].score <= 1
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    r = random.Random(1)
    make = {"aa": ["lor", "em", "ip"], "bb": ["zuk", "wy", "qua"]}
    rows = [(i, " ".join("".join(r.choice(make[x]) for _ in range(3)) for _ in range(40)), x, "s", 1, *"xyzw") for i in range(120) for x in [("aa", "bb")[i % 2]]]
    found = _by_id(langid.query(spark, _write(spark, tmp_path / "two", rows)))
    assert all(found[i].lang_pred == x for i, _, x, *_ in rows)


def test_reshard(spark, tables):
    rows = reshard.query(spark, tables).collect()
    sizes = {i: len((t or "").encode()) + 1 for i, t, *_ in _rows()}
    assert sorted(r.doc_id for r in rows) == sorted(sizes)
    slots = collections.defaultdict(list)
    for r in rows:
        assert r["size"] == sizes[r.doc_id] and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_min_cost_flow():
    flow = reshard.min_cost_flow([10, 0, 6], [4, 6, 6], [[int(i != j) for j in range(3)] for i in range(3)])
    assert [sum(r) for r in flow] == [10, 0, 6] and [sum(c) for c in zip(*flow, strict=True)] == [4, 6, 6]
    p = reshard.plan([10, 0, 6], [4, 6, 6])
    assert p.moved == 6 and p.affected == [0, 1]
    r = random.Random(2)
    for _ in range(30):
        supply = [r.randint(0, 9) for _ in range(3)]
        capacity = reshard.even_capacities(sum(supply), 4)
        assert reshard.plan(supply, capacity).moved == sum(supply) - sum(min(a, b) for a, b in zip(supply, capacity, strict=False))


def _removed(units, join):
    owner, out = {}, {}
    for i, x in units:
        gone = np.zeros(len(x), bool)
        keys = [join(x[j : j + 50]) for j in range(len(x) - 49)]
        for j, k in enumerate(keys):
            if k in owner:
                gone[j : j + 50] = True
        for k in keys:
            owner.setdefault(k, i)
        out[i] = gone
    return out


def test_suffix(spark, tables):
    got = _by_id(suffix.query(spark, tables))
    units = [(i, (t or "").encode()) for i, t, *_ in _rows()]
    for (i, x), gone in zip(units, _removed(units, bytes).values(), strict=True):
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(gone) else 0
        assert tuple(got[i]) == (i, len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_automata(spark, tables):
    got = _by_id(automata.query(spark, tables))
    units = [(i, WORDS.findall((t or "").encode())) for i, t, *_ in _rows()]
    for (i, x), gone in zip(units, _removed(units, tuple).values(), strict=True):
        kept = b" ".join(w for w, g in zip(x, gone, strict=True) if not g)
        assert tuple(got[i]) == (i, len(x), int(gone.sum()), hashlib.sha256(kept).hexdigest())


def test_passages_leave_only_their_spans(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    docs = spark.createDataFrame([(i, f"{passage} {'x' * (i % 2)}{i}") for i in range(6)], "doc_id long, text string")
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(root.glob("llm-*/t"))
    found = suffix.byte_spans(docs)
    assert {r.doc for r in found.collect()} == {1, 2, 3, 4, 5}
    assert len(set(root.glob("llm-*/t")) - before) == 1


def test_broadcast_reference():
    r = automata.Reference([(1, "a b c d e f"), (2, "x y z")])
    assert r.spans([b"q", b"b", b"c", b"d", b"q", b"x", b"y", b"z"], 3) == [(1, 4), (5, 8)]
    with pytest.raises(ValueError):
        automata.Reference([(1, "a b c")], most_words=2)


def test_sort_suffixes():
    r = np.random.default_rng(5)
    for n in (1, 2, 7, 60):
        for k in (1, 2, 4):
            for memory in (64 << 20, 100):
                t = r.integers(1, 1 + k, n)
                want = sorted(range(n), key=lambda i, t=t: list(t[i:]))
                sa, lcp = suffix.sort_suffixes(t, 1 << 30, memory)
                assert list(sa) == want
                for a, b, x in zip(want, want[1:], lcp[1:], strict=False):
                    assert x == next((j for j in range(n) if max(a, b) + j >= n or t[a + j] != t[b + j]), n)


def _sets(rows, words):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    out = {}
    for i, t, *_ in rows:
        w = WORDS.findall((t or "").encode().translate(lower))
        out[i] = {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    return out


def _components(sets):
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in sets}


def test_minhash(spark, tables):
    got = _by_id(minhash.query(spark, tables))
    sets = _sets(_rows(), 4)
    want = _components(sets)
    for i in sets:
        assert tuple(got[i]) == (i, len(sets[i]), want[i], want[i] == i)


def test_minhash_random_families(spark):
    r = random.Random(11)
    rows = []
    for family in range(12):
        words = [f"w{family}_{r.randint(0, 9999)}" for _ in range(r.choice([6, 12, 30, 90, 300]))]
        for _ in range(8):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 60))):
                copy[r.randrange(len(copy))] = f"e{r.random()}"
            rows.append((len(rows), " ".join(copy)))
    df = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4)
    want = _components(_sets(rows, 4))
    assert {x.doc_id: x.component_id for x in df.collect()} == want


def test_minhash_pairs_under_a_hot_template(spark):
    template = " ".join(f"t{i}" for i in range(266))
    rows = [(i, f"{template} " + " ".join(f"d{i}_{j}" for j in range(33)) + (f" pair{i // 60}" if i % 60 < 2 else f" own{i}")) for i in range(600)]
    want = {i: i - 1 if i % 60 == 1 else i for i in range(600)}
    df = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1)
    assert {x.doc_id: x.component_id for x in df.collect()} == want


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "q"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.component_id or 0 for x in minhash.near_duplicates(docs, words=4).collect()) == [0, 1, 1, 1, 2]
    kept = [x.doc_id for x in minhash.stage(spark, docs, "").collect()]
    assert kept.count(1) == 1 and kept.count(2) == 1
    assert automata.digests(docs, automata.word_spans(docs)).count() == 5


def test_texts_that_share_an_id(spark):
    p, q = (" ".join(f"{x}{i}" for i in range(80)) for x in "pq")
    docs = spark.createDataFrame([(1, p, 7), (2, p, 7), (2, q, 7), (3, q, 7)], "doc_id long, text string, n_chars int")
    assert sorted((r.doc_id, r.n_removed) for r in automata.digests(docs, automata.word_spans(docs)).collect()) == [(1, 0), (2, 0), (2, 80), (3, 80)]
    removed = sorted((r.doc_id, r.n_removed) for r in suffix.digests(docs, suffix.byte_spans(docs)).collect())
    assert removed == [(1, 0), (2, 0), (2, len(p)), (3, len(q))]
    cut = {(r.doc_id, r.text): r.n_chars for r in automata.stage(spark, docs, "").collect()}
    assert cut == {(1, p): 7, (2, ""): 0, (2, q): 7, (3, ""): 0}
    near = sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs, words=4).collect())
    assert near == [(1, 1), (2, 1), (2, 2), (3, 2)]
    assert sorted(r.doc_id for r in minhash.stage(spark, docs, "").collect()) == [1, 2]


def test_short_items(spark, tmp_path):
    texts = ["we met at noon and left", "we met at noonish", "exactly thirty characters here!", "nothing"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "at noon"), (2, "exactly thirty characters here"), (3, " "), (4, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {(r.doc_id, r.item_id) for r in decontam.query(spark, str(tmp_path)).collect()} == {(0, 1), (2, 2)}
    docs, items = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "benchmark"))
    assert {(r.doc_id, r.item_id) for r in decontam.find(docs, items, most_bytes=8).collect()} == {(0, 1), (2, 2)}
    assert {r.doc_id for r in decontam.clean(docs, items, most_bytes=8).collect()} == {1, 3}


def test_added_tokens(spark, tmp_path):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t, texts = Tokenizer.from_file(P.path("word_bpe_49k.json")), ["a <|endoftext|> b", "x<|startoftext|>y it's", "A.B, naïve\xa0c"]
    rows = [(i, x, "en", "s", 1, *"xyzw") for i, x in enumerate(texts)]
    got = _by_id(rans.query(spark, _write(spark, tmp_path / "t", rows)))
    for i, x in enumerate(texts):
        e = [*t.encode(x, add_special_tokens=False).ids, 1]
        assert (got[i].n_tokens, got[i].ids_crc32) == (len(e), zlib.crc32(np.array(e, "<u4").tobytes()))


def test_strange_texts_go(spark, tmp_path):
    r = random.Random(1)
    make = {"aa": ["lor", "em", "ip"], "bb": ["zuk", "wy", "qua"]}
    rows = [(i, " ".join("".join(r.choice(make[x]) for _ in range(3)) for _ in range(40)), x, "s", 1, *"xyzw") for i in range(60) for x in [("aa", "bb")[i % 2]]]
    rows += [(100, "жжж ёёё " * 30, None, "s", 1, *"xyzw"), (101, "12 34", None, "s", 1, *"xyzw"), (102, None, None, "s", 1, *"xyzw")]
    docs = spark.read.parquet(f"{_write(spark, tmp_path / 'd', rows)}/documents.parquet")
    assert {x.doc_id for x in langid.stage(spark, docs, "").collect()} == set(range(60))


def test_bpe_leaves_no_variables(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(bpe.uuid, "uuid4", lambda f=bpe.uuid.uuid4: made.append(f()) or made[-1])
    spark.createDataFrame([(1, "ab ab cd")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = bpe.query(spark, str(tmp_path))
    for name in [f"v_{u.hex}" for u in made]:
        with pytest.raises(AnalysisException):
            spark.sql(f"SELECT session.{name} IS NULL")
    assert df.first().n_tokens > 0


def test_bpe(spark, tables):
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = _by_id(bpe.query(spark, tables))
    for i, t, *_ in _rows():
        e = encoding.encode_ordinary(t or "")
        assert tuple(got[i]) == (i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()), i


def test_stage_binds_few_words_and_no_pieces(spark, tmp_path, monkeypatch):
    import public_tokenizers as P
    import tiktoken

    seen = []
    monkeypatch.setattr(bpe, "hot_words", lambda docs, v, pattern, most, f=bpe.hot_words: seen.append((v.pieces, most)) or f(docs, v, pattern, most))
    monkeypatch.setattr(bpe, "STAGE_HOT", 2)
    text = "ab ab ab ab cd cd ef ef one once"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ids = np.frombuffer(bpe.stage(spark, docs, "").first().ids, "<u4").tolist()
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(bpe._path(None)), special_tokens={})
    assert seen == [(None, 2)] and ids == encoding.encode_ordinary(text)


def test_bpe_of_other_ranks(spark, tmp_path):
    """Random ranks: pieces that no merges lead to, pairs of the same piece in several ways, a lower rank after a higher one."""
    import tiktoken

    r = random.Random(3)
    pieces = {bytes([i]) for i in range(256)} | {"".join(r.choice("abé") for _ in range(r.randint(2, 6))).encode() for _ in range(150)}
    order = r.sample(sorted(pieces), len(pieces))
    (tmp_path / "ranks").write_text("".join(f"{base64.b64encode(p).decode()} {k}\n" for k, p in enumerate(order)))
    encoding = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks={p: k for k, p in enumerate(order)}, special_tokens={})
    texts = [" ".join("".join(r.choice("abéz") for _ in range(r.randint(1, 12))) for _ in range(60)) for _ in range(8)]
    texts += [order[k].decode() for k in range(len(order)) if len(order[k]) > 3]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for decodes in (True, False):
        vocabulary = bpe.Vocabulary(spark, str(tmp_path / "ranks"), decodes)
        assert vocabulary.odd is not None
        for row in bpe.encode(docs, vocabulary, r"\S+|\s+", decoded="decoded" if decodes else None).collect():
            assert np.frombuffer(row.ids, "<u4").tolist() == encoding.encode_ordinary(texts[row.doc_id])
            assert not decodes or row.decoded.decode() == texts[row.doc_id]


def test_perfect_hash():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 50_000):
        keys = r.permutation(1 << 20)[:n] * 977
        moves, places = bpe.perfect(keys)
        at = bpe._xxhash64(moves[(bpe._xxhash64(keys) & np.uint64(len(moves) - 1)).astype(np.int64)], bpe._xxhash64(keys)) & np.uint64(len(places) - 1)
        assert (places[at.astype(np.int64)] == np.arange(n)).all() and (places >= 0).sum() == n


def test_bpe_marks_of_bytes_differ():
    some = [bytes([a]) for a in range(256)]
    some += [a + b for a in some for b in some]
    assert len({bpe.Vocabulary._crc_place(x) for x in some}) == len(some)


def test_rans_query(spark, tables):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got, at = _by_id(rans.query(spark, tables)), 0
    for i, text, *_ in _rows():
        e = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(got[i]) == (i, at, len(e), zlib.crc32(np.array(e, "<u4").tobytes())), i
        at += len(e)


def test_rans_words_reach_the_library_together():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    calls = collections.Counter()

    class Counted:
        def __init__(self, of):
            self.of = of

        def __getattr__(self, name):
            calls[name] += 1
            return getattr(self.of, name)

    t, table = Tokenizer.from_file(P.path("word_bpe_49k.json")), rans.WordTable(P.path("word_bpe_49k.json"))
    table.tokenizer, table.model = Counted(t), Counted(getattr(table, "model", None))
    texts = [f"a{i} {i}.{i} q-{i}! élan{i}é's İ{i} 語{i}" for i in range(50)]
    ids, offsets = table.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [t.encode(x).ids for x in texts]
    assert sum(calls.values()) <= 2


def test_rans_words_of_any_characters():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t, r = Tokenizer.from_file(P.path("word_bpe_49k.json")), random.Random(4)
    some = [chr(c) for c in range(0x250)] + list("abcXYZ'stdrvlm 09\n\t\u0301\u0308Σςẞﬁ\u2003日\U0001f600\u212b\u2c65") * 9 + ["<|endoftext|>", "</w>", "'ll"] * 5
    texts = ["".join(r.choice(some) for _ in range(r.randint(0, 60))) for _ in range(400)] + ["", None, " \n", *(f"a{chr(c)}B{chr(c)}" for c in range(1, 0x400))]
    for most in (1 << 20, 40):
        table = rans.WordTable(P.path("word_bpe_49k.json"), most)
        for some in (texts[:200], texts[100:], texts, [], [None]):
            ids, offsets = table.encode(pa.array(some, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [t.encode(x or "").ids for x in some]


def test_rans_blocks():
    r = np.random.default_rng(1)
    for n in (0, 1, 70, rans.SEGMENT, rans.SEGMENT + 1, 3 * rans.SEGMENT - 5):
        ids = (r.zipf(1.3, n) % 5000).astype(np.uint32)
        freq = rans.normalise(np.bincount(ids, minlength=5000))
        block = rans.encode(ids, freq)
        assert (rans.decode(block, freq) == ids).all()
    assert (rans.decode(block, freq, 1, 2) == ids[rans.SEGMENT : 2 * rans.SEGMENT]).all()
    with pytest.raises(ValueError):
        rans.decode(block[:-1] + bytes([block[-1] ^ 1]), freq)


def test_quotes(spark):
    rows = [
        (1, 0, "u", "Hello there my friend, how are you today?\n\nSecond paragraph here."), (1, 1, "a", "> Hello there my friend, how are you   today?\nFine thanks."),
        (1, 2, "b", "Bob wrote:\n>> Hello there my friend, how are you today?\n> Fine thanks.\nGood to hear"), (1, 3, "c", "> second paragraph here.\nand what?"),
        (1, 4, "d", "unrelated"), (1, 4, "d", "unrelated"), (None, 1, "x", "> y"), (2, 0, "u", None), (2, 1, "u", ""),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, block string")
    got = sorted(((r.conv_id or 0, r.position, r.turn, r.text, r.parent_turn, r.root_turn, r.depth) for r in quotes.link(docs).collect()), key=str)
    assert (1, 2, 2, "Good to hear", 1, 0, 2) in got and (1, 1, 1, "Fine thanks.", 0, 0, 1) in got and (1, 3, 3, "and what?", 0, 0, 1) in got
    assert len(got) == len(rows) and (2, 0, 0, "", None, 0, 0) in got
    assert quotes.link(docs.where("false")).collect() == []


def test_quotes_of_short_lines(spark):
    rows = [
        (1, 0, "u", "Shall we meet at noon on Friday then?\nOK\nSounds good to me."), (1, 1, "a", "Thanks a lot for the notes.\nOK"), (1, 2, "b", "> Sounds good to me.\nGreat"),
        (1, 3, "c", "> OK\n> thanks a lot for the notes.\nSo be it"), (1, 4, "d", "> OK\n> Great\nFine"), (1, 5, "e", "> never said\nHm"),
    ]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r.turn: r.parent_turn for r in quotes.link(docs).collect()} == {0: None, 1: None, 2: 0, 3: 1, 4: 2, 5: None}


def test_powers_take_what_they_need():
    common._POWERS.clear()
    assert common.powers(common._BASE, 10).tolist()[:2] == [1, common._BASE] and len(common._POWERS[common._BASE]) <= 1 << 20
    assert len(common.powers(common._BASE, 1 << 21)) == 1 << 21


def test_small_sets_are_compared_in_full_before_they_are_pairs(spark):
    template = " ".join(f"t{i}" for i in range(62))
    rows = [(i, f"{template} " + " ".join(f"d{i}_{j}" for j in range(9))) for i in range(60)] + [(60, f"{template} " + " ".join(f"d7_{j}" for j in range(8)) + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    reps = common.materialize(minhash.signed(docs, 1)).selectExpr("doc_id", "v", "n_shingles n", "sketch")
    entries = reps.selectExpr("1L bucket", "v", "n", "1000L most", "v component")
    sets = minhash.full_sets(docs.join(reps.select("doc_id", "v"), "doc_id").select("v", "text"), 1)
    ids = {r.v: r.doc_id for r in reps.collect()}
    assert [sorted((ids[r.a], ids[r.b])) for r in minhash._pairs(entries, reps.select("v", "sketch"), sets, 80, 3).collect()] == [[7, 60]]

"""Vector codes, byte-level BPE and ranked search against brute force, on small tables with odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from cellwise.llm import bpe, codebooks, lexical, queries

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _codes(vectors, entries=16, rounds=6, parts=8, scale=4096):
    """Plain integer k-means: vectors in the order of their ids."""
    x = np.array([[math.floor(scale * float(c)) for c in v] for v in vectors], np.int64).reshape(len(vectors), parts, -1)
    book = x[:entries].transpose(1, 0, 2).copy()

    def near():
        d2 = ((x[:, :, None] - book[None]) ** 2).sum(-1)
        return d2.argmin(-1), d2.min(-1)

    for _ in range(rounds):
        a, _d = near()
        for p in range(parts):
            for e in range(book.shape[1]):
                own = x[a[:, p] == e, p]
                if len(own):
                    book[p, e] = own.sum(0) // len(own)
    a, d2 = near()
    return ["".join(f"{c:02x}" for c in row) for row in a], d2.sum(1).tolist(), book


def _vectors(kind):
    rng = np.random.default_rng(4)
    if kind == "groups":  # a third of the rows are copies, the others lie in tight groups
        middle = rng.normal(size=(30, 16))
        rows = [(middle[i % 30] + rng.normal(size=16) * 0.01).tolist() for i in range(400)]
        return rows + [rows[7]] * 200
    if kind == "ties":
        return rng.integers(-1, 2, (300, 16)).astype(float).tolist()
    return rng.normal(size=(9, 16)).tolist()  # fewer than entries


@pytest.mark.parametrize("kind", ["groups", "ties", "few"])
def test_codes(spark, kind):
    rows = _vectors(kind)
    table = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(rows)]
    bad = [(None, None, 1), (9001, [1.0] * 15 + [None], 1), (9002, [float("nan")] * 16, 1), (9003, [float("inf")] * 16, None)]
    data = spark.createDataFrame(table + bad, "vec_id bigint, embedding array<double>, label int").withColumn("x", F.lit(1)).withColumn("error", F.lit(1))
    codes, books = codebooks.compress(data.repartition(4))
    got = {r["id"]: r for r in codebooks.with_label_errors(codes).collect()}
    code, error, book = _codes(rows)
    assert len(got) == len(rows)
    assert (books.final == book).all()
    by_label = collections.Counter()
    for i, _, label in table:
        by_label[label] += error[i]
    for i, _, label in table:
        assert (got[i]["code"], got[i]["error"], got[i]["label_error"]) == (code[i], error[i], by_label[label])
    plain = len(rows) * 8 * min(16, len(rows))
    assert books.measured[0] == plain and (kind != "groups" or sum(books.measured[1:]) < 0.6 * 5 * plain)


def test_codes_of_odd_tables(spark, tmp_path):
    schema = "vec_id bigint, embedding array<float>, label int"
    codes, books = codebooks.compress(spark.createDataFrame([], schema))
    assert codes.count() == 0 and books is None
    same = spark.createDataFrame([(1, [0.5] * 8, None)] * 20 + [(None, [0.25] * 8, None)], schema)
    codes, books = codebooks.compress(same)
    assert codes.count() == 21 and books.final.shape == (8, 16, 1)
    assert codes.where("error <> 0").count() == 0  # the first entry leaves the copies to the next one
    with pytest.raises(Exception, match="one length"):
        codebooks.compress(spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], schema))
    with pytest.raises(Exception, match="passes"):
        codebooks.compress(spark.createDataFrame([(1, [3e30] * 8, 1)], schema))


def test_bounds_never_pass_distances():
    rng = np.random.default_rng(6)
    x = rng.integers(-4096, 4096, (200, 8, 8))
    history = [rng.integers(-4096, 4096, (8, 16, 8))]
    state = codebooks._first_state(x, history[0])[:4]
    for now in range(1, 6):
        history.append(history[-1] + rng.integers(-40, 41, (8, 16, 8)))
        moved = codebooks.Codebooks(history).displacements()
        distance = np.sqrt(((x[:, :, None] - history[-1][None]) ** 2).sum(-1))
        lower = state[0] * state[2].astype(np.float64)[..., None] - moved[state[1], np.arange(8)[None, :, None], np.arange(16)]
        assert (lower <= distance).all()
        found = codebooks._next_state(x, history[-1], moved, now, *state)
        assert (found[3] == distance.argmin(-1)).all() and found[5] < x.shape[0] * 128
        state = found[:4]


@pytest.fixture(scope="module")
def plain():
    ranks = bpe.parse_ranks(bpe.read_ranks(PATH))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.parse_ranks(bpe.read_ranks(PATH)), public_tokenizers.PATTERN)


ODD = [None, "", " ", "\n\n \n", "don't we'll I'M", "naïve Ünïcödé 東京 🦆🦆", "a" * 5000, " " * 700 + "x", "x1234567890 !!?? <|endoftext|>", "tab\tand\r\nlines\n\n", "\x00\x01\x1c\x85 ", "zażółć gęślą jaźń"]


def test_byte_bpe(spark, plain):
    texts = [*ODD, *[r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()], ODD[4]]
    docs = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int").repartition(3)
    shared = bpe.share(spark, PATH)
    got = bpe.decode(bpe.encode(docs, shared, public_tokenizers.PATTERN), shared).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"] or 0] or ""
        want = plain.encode_ordinary(text)
        assert r["n_tokens"] == len(want) and bytes(r["ids"]) == struct.pack(f"<{len(want)}I", *want)
        assert bytes(r["decoded"]) == text.encode()
    assert bpe.encode(docs.limit(0), shared, public_tokenizers.PATTERN).count() == 0
    one = {r["doc_id"]: r for r in queries.op12_byte_bpe(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").limit(20).collect():
        want = plain.encode_ordinary(r["text"])
        assert one[r["doc_id"]]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert one[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_every_character_as_the_library_does(vocabulary, plain):
    for low in range(0, 0x110000, 512):
        text = "".join(f"a{chr(c)} {chr(c)}1" for c in range(low, low + 512) if not 0xD800 <= c <= 0xDFFF)
        assert np.frombuffer(vocabulary.encode(text), "<u4").tolist() == plain.encode_ordinary(text), hex(low)


def test_each_prefix_has_the_last_token_of_its_encoding(vocabulary, plain):
    for word in (" unbelievably", "aaaaaaaaaaaaa", "Straßenbahnhaltestelle", "=====-----====="):
        data = word.encode()
        last = vocabulary.last_tokens(data)
        for n in range(1, len(data) + 1):
            assert last[n - 1] == vocabulary.ranks[vocabulary.merged(data[:n])[-1]]
            assert vocabulary.last_tokens(data, last[:n]) == last  # an exact append
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Vocabulary({b"a": 0}, ".")


def test_edits_are_exact(vocabulary, plain):
    rng = np.random.default_rng(8)
    letters = "".join(rng.choice(list("abcdefghinorst"), 4000))
    parts = ["", "x", " ", "the", "\n \n", " word é", "'ll", "12", " " * 7, "qzx"]
    for text in ("It's a test, isn't it?  We'll see 123 times.\n\n" * 20, letters):
        e = bpe.EncodedText.of(vocabulary, text)
        assert e.ids() == plain.encode_ordinary(text)
        for _ in range(80):
            start = int(rng.integers(len(e.text) + 1))
            encoded = e.replace(start, min(len(e.text), start + int(rng.choice([0, 1, 5, 40]))), parts[int(rng.integers(len(parts)))])
            assert encoded < 40 and e.ids() == plain.encode_ordinary(e.text)
        e.append(" and more")
        assert e.ids() == plain.encode_ordinary(e.text)
    with pytest.raises(ValueError, match="within"):
        e.replace(5, 4, "")


def test_edits_of_a_long_piece_stay_near(vocabulary):
    data = bytes(np.random.default_rng(9).choice(list(b"abcdefghinorst"), 5000))
    last = vocabulary.last_tokens(data)
    new = data[:2500] + b"zq" + data[2501:]
    asked = []
    vocabulary.may_follow, plain = lambda *pair: asked.append(pair) or type(vocabulary).may_follow(vocabulary, *pair), vocabulary.may_follow
    vocabulary.pairs.clear()
    try:
        again = vocabulary.last_tokens(new, last[:2500], last, 2502)
    finally:
        vocabulary.may_follow = plain
    assert again == vocabulary.last_tokens(new) and len(asked) < 2000


def _ranked(docs, items, k=10):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def terms(text):
        return re.findall(pattern, (text or "").translate({c: c + 32 for c in range(65, 91)}))

    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = collections.Counter()
    for item, text in items:
        found = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(found)[:k], 1):
            out[(item, rank, i, -score)] += 1
    return out


@pytest.mark.parametrize("limits", [(1024, 1 << 16, 4096), (2, 40, 3)])
def test_lexical_search(spark, monkeypatch, limits):
    for name, value in zip(("BLOCK_DOCS", "BLOCK_TERMS", "QUERY_TERMS"), limits, strict=True):
        monkeypatch.setattr(lexical, name, value)
    rng = np.random.default_rng(11)
    word = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(word, int(rng.integers(1, 90))) if i % 4 else ["w1"] * (1 + i % 9))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "-- !!"), (203, "É É é Zażółć"), (None, docs[1][1]), docs[2], docs[2], (204, " ".join(rng.choice(word, 4000)))]
    docs += [(300 + i, docs[5][1]) for i in range(15)]  # ties beyond the tenth
    items = [(1, "w1 w2 w2 W3"), (2, docs[5][1]), (3, None), (4, "unknown"), (None, "é zażółć"), (5, " ".join(word)), (6, "..."), (1, "w7")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit(1)).withColumn("words", F.lit(1)).repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", F.lit(1))
    index = lexical.build_index(table)
    got = collections.Counter(map(tuple, lexical.search(index, benchmark).collect()))
    assert got == _ranked(docs, items)
    if limits[0] > 2:
        assert lexical.search(index, benchmark.limit(0)).count() == 0
        assert lexical.search(lexical.build_index(table.limit(0)), benchmark).count() == 0


def test_bounds_of_scores():
    rng = np.random.default_rng(12)
    texts = pa.array([" ".join(f"t{k}" for k in rng.integers(0, 50, int(rng.integers(1, 80)))) for _ in range(300)])
    batches = list(lexical._indexed([pa.record_batch({"doc_id": np.arange(300), "text": texts})]))
    asked = lexical._queries(["t1 t2 t3 t3 t9", "t40 absent"])
    places = [lexical._positions(asked.hashes, level) for level in range(3)]
    n_words = sum(b.column("n_words")[0].as_py() for b in batches)
    for b in batches:
        block = lexical._Block(b, 0, 300, n_words)
        marks = block.marks(places)
        for terms, repeats in zip(asked.terms, asked.repeats, strict=True):
            exact = block.scores(np.arange(block.size), asked.hashes[terms], repeats.astype(np.int64))
            assert (block.most_possible(marks, terms, repeats.astype(np.int64)) >= exact).all()

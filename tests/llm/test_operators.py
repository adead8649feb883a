"""The numbered operators against brute force, on small tables with odd rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellwise.llm import contamination, graph, htmltext, jaccard, mixture, quality, queries, repeats, secrets, stages, textgrid, toxicity, urlfilter, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, ties, near copies, a long text."""
    rng = np.random.default_rng(7)
    word = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(word, 60)) for _ in range(6)]
    near = base[0].split(" ")
    near[30] = "other"
    texts = [*base, " ".join(near), base[1], base[1] + " tail", None, "", " \n\t", "one", "one", "two  words", base[2][:150], "x" * 450, "ab" * 300, " ".join(rng.choice(word, 9000)), base[3] + "\n" + base[4] + "\n" + base[3]]
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", None) for i, t in enumerate(texts)]
    rows += [rows[2], (None, base[5], None, None, 3), (None, "single null id", None, "s1", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def _repeats(texts, length):
    rows = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + length] for r in rows for i in range(len(r) - length + 1))
    out = []
    for r in rows:
        hit = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                hit[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out.append((len(r), int(hit.sum()), runs, hashlib.sha256(bytes(b for b, h in zip(r, hit, strict=False) if not h)).hexdigest()))
    return out


@pytest.mark.parametrize("group", [repeats.GROUP, 1])
def test_repeats(odd, empty, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = odd.select("text").collect()
    want = collections.Counter(_repeats([r["text"] for r in rows], 200))
    got = repeats.remove_repeats(odd).select("n_bytes", "n_removed", F.size("spans"), "kept_sha256").collect()
    assert collections.Counter(map(tuple, got)) == want
    assert repeats.remove_repeats(empty).count() == 0


def test_spread_names_give_the_same_runs():
    import pyarrow as pa

    text = [b"a" * 100 + bytes([i]) * 150 + b"b" * 100 for i in range(3)] * 2
    part = pa.record_batch({"name": np.arange(6) * 0 + 9, "text_key": np.arange(6), "first": np.zeros(6, np.int64), "ahead": np.full(6, 5), "bytes": pa.array(text, pa.binary())})
    near = pa.concat_batches(list(repeats._compare(part, 200))).to_pydict()
    marks = collections.Counter(m for b in repeats._spread(part, 200) for m in b.column("mark").to_pylist())
    starts = {(k, f) for b in repeats._spread(part, 200) for k, f, m in zip(*(b.column(c).to_pylist() for c in ("text_key", "first", "mark")), strict=True) if marks[m] > 1}
    assert {(k, i) for k, f, e in zip(near["text_key"], near["first"], near["last"], strict=True) for i in range(f, e + 1)} == starts


def test_long_texts_are_sampled_in_parts(monkeypatch):
    data = np.frombuffer(b"".join(bytes(np.random.default_rng(i).integers(0, 256, 900, np.uint8)) for i in range(3)), np.uint8)
    whole = repeats.samples(data, np.array([0, len(data)]))
    monkeypatch.setattr(repeats, "PART", 500)
    parts = repeats.samples(data, np.array([0, len(data)]))
    assert set(whole[1].tolist()) == set(parts[1].tolist())
    covered = {i for f, e in zip(parts[2].tolist(), parts[3].tolist(), strict=True) for i in range(f, e + 1)}
    assert covered == set(range(len(data) - 199))


def test_warc(spark, tmp_path):
    big = "".join(chr(97 + i % 26) for i in range(90_000)) + "é\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/", "x"), (2, None, None), (3, "http://b/\n", ""), (4, "http://c", big), (5, "u", big), (6, "u", "x"), (6, "u", "x"), (7, "u", big + "z"), (7, "u", big + "z"), (None, "n", "null id")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    got = warc.read_archive(spark, path).collect()
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = collections.Counter()
    for i, _, h in rows:
        h = h or ""
        again = i is not None and last[h] != i
        sha = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want[(None if i is None else str(i), len(h.encode()), sha, "revisit" if again else "response", str(last[h]) if again else None, None if again else h.encode())] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["digest"], r["type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    assert warc.unchunked(warc.chunked(big.encode())) == big.encode()


def test_warc_missing_segment_is_an_error(spark, tmp_path):
    records = warc.records_of(1, "u", b"q" * 100_000, None, False)
    lost = spark.createDataFrame([(r,) for r in [records[0], *records[2:]]], "record binary").select(F.col("record").cast("string"))
    lost.write.option("lineSep", "\r\n").option("compression", "gzip").text(str(tmp_path / "lost"))
    with pytest.raises(Exception, match="missing"):
        warc.read_archive(spark, str(tmp_path / "lost")).collect()


def test_mixture(odd, empty):
    one = mixture.mix(odd).collect()
    assert [r["shuffle_key"] for r in one] == sorted(r["shuffle_key"] for r in one)
    again = mixture.mix(odd.withColumn("copy", F.lit(9)).repartition(7)).collect()
    assert collections.Counter(map(str, one)) == collections.Counter(map(str, again))
    assert mixture.mix(empty).count() == 0
    many = odd.sparkSession.range(2000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") < 1800, "big").otherwise("small").alias("source"))
    sizes = {r["source"]: r["count"] for r in mixture.mix(many).groupBy("source").count().collect()}
    assert abs(sizes["big"] - 1000) < 130 and abs(sizes["small"] - 1000) < 130
    assert set(r["source"] for r in mixture.mix(many, weights={"small": 1.0}, budget=8.0).select("source").distinct().collect()) == {"small"}


def test_quality_statistics(odd):
    got = {r["doc_id"]: r for r in quality.with_statistics(odd, "text").collect()}
    for i, r in got.items():
        text = r["text"] or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen = collections.Counter(zip(ws, ws[1:], ws[2:], strict=False))
        hit = {j for k in range(len(ws) - 2) if seen[tuple(ws[k : k + 3])] > 1 for j in range(k, k + 3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, i


def test_quality_rules(odd, empty):
    rng = np.random.default_rng(1)
    table = {"n_words": rng.uniform(0, 100, 900), "symbol_share": rng.uniform(0, 1, 900)}
    low = (table["n_words"] < 30) & (table["symbol_share"] > 0.5)
    rules = quality.learn(table, low)
    hit = np.logical_or.reduce([quality._all(c, table) for c, _, _ in rules])
    assert (hit == low).mean() > 0.95
    labels = odd.sparkSession.createDataFrame([(None, 1), (2, None)], "doc_id bigint, quality int")
    assert quality.learn_rules(odd, labels, "doc_id", "text", "quality") == []
    judged = quality.judge(odd, [])
    assert judged.where("kept = base_failed").count() == 0 and judged.count() == odd.count()
    assert quality.judge(empty, []).count() == 0


def _contaminated(text, items, width=13):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    ws, hit, found = re.findall(pattern, _lower(text)), set(), set()
    for item, t in items:
        iw = re.findall(pattern, _lower(t))
        n = min(width, len(iw))
        windows = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if n else set()
        for k in range(len(ws) - n + 1) if n else []:
            if tuple(ws[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                found |= {str(item)} if item is not None else set()
    return len(ws), len(hit), sorted(found)


@pytest.mark.parametrize("limit", [contamination.MAX_WINDOWS, 1])
def test_contamination(odd, empty, spark, limit):
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    items = [(1, texts[0]), (10, texts[3][20:140]), (2, "One"), (3, None), (4, "..."), (None, texts[4]), (1, texts[0])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = contamination.find_contamination(odd, benchmark, max_windows=limit).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i, r in by_id.items():
        assert (r["n_words"], r["n_hit"], list(r["items"])) == _contaminated(texts[i], items), i
    assert contamination.find_contamination(empty, benchmark).count() == 0
    assert contamination.find_contamination(odd, benchmark.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("most_bits", [contamination.MAX_BITS, 64])
def test_benchmark_windows_stay_out_of_plans(spark, monkeypatch, most_bits):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(40)]
    clean = " ".join(f"v{k}" for k in range(50))
    texts = [*[f"{clean} {t[5:400]} {clean}" for _, t in items[:10]], clean, None, ""]
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (0, clean), (None, texts[1]), (None, clean)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    plans, cut = [], contamination.cut_lineage

    def note(df):
        plans.append(df._jdf.queryExecution().toString())
        return cut(df)

    monkeypatch.setattr(contamination, "cut_lineage", note)
    monkeypatch.setattr(contamination, "MAX_BITS", most_bits)  # with 64 bits all windows pass the filter
    found = contamination.find_contamination(docs, benchmark, keep=("text",))
    plans.append(found._jdf.queryExecution().toString())
    assert not any("w7x30 w7x31" in p for p in plans)
    got = found.collect()
    assert len(got) == len(texts) + 4 and sum(r["n_hit"] > 0 for r in got) == 12
    for r in got:
        assert (r["n_words"], r["n_hit"], list(r["items"])) == _contaminated(r["text"], items)


def test_url_filter(spark):
    urls = ["http://A.net/x", "https://example.net/en/", "ftp://www.example.com/de/a?b", "x://q.org/fr/", "http://bad.biz/p/?utm_source=a", "http://www.BAD.biz/p#t", "http://ok.biz/", None, "", "nothing", "http://net", "http://bad.biz/q"]
    pages = spark.createDataFrame(list(enumerate([*urls, urls[4]])), "page_id bigint, url string")
    listed = spark.createDataFrame([("http://bad.biz/p",), (None,), ("no url",)], "url string")
    for blocks in (urlfilter.MAX_BLOCKS, 1):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.filter_urls(pages, listed, max_blocks=blocks).collect()}
        assert got[0] == ("a.net", "/x", "net/", "block") and got[1][2:] == ("example.net/en/", "allow")
        assert got[2] == ("www.example.com", "/de/a", "example.com/de/", "block") and got[3][2:] == ("org/fr/", "allow")
        assert [got[i][3] for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)] == ["block", "block", "allow", "allow", "allow", "allow", "allow", "allow", "block"]
        assert got[7][:2] == ("", "") and got[10] == ("net", "", None, "allow")
    assert urlfilter.filter_urls(pages, listed.limit(0)).where("listed").count() == 0


def _components(rows, percent=80):
    sets = []
    for _, text in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
        sets.append({tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    return collections.Counter((i, len(sets[k]), min([x for x in least[find(k)] if x is not None], default=None)) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("leaf", [jaccard.LEAF, 2])
def test_jaccard(odd, empty, spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    rng = np.random.default_rng(5)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(40):  # a family of many degrees of likeness, with shared beginnings
        ws = [w if rng.random() > 0.01 * (i % 6) else f"z{rng.integers(999)}" for w in common]
        rows.append((100 + i, " ".join([*ws, *[f"t{i % 4}{k}" for k in range(i % 9)]])))
    rows += [(r["doc_id"], r["text"]) for r in odd.collect()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard.jaccard_components(docs).collect()
    assert collections.Counter(map(tuple, got)) == _components(rows)
    if leaf == 2:
        assert jaccard.jaccard_components(empty).count() == 0


def test_texts_of_sets_are_dealt_once(spark):
    """Texts stand in buckets by their set: no verification deals them again."""
    texts = [(1, "a b c d e f"), (2, "A b  c d e f"), (3, "q"), (4, None), (5, " "), (6, "a b c d e f")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    sized = jaccard.describe(docs, "doc_id", "text").where("n > 0").select("doc_id", "sig")
    sig = {r["doc_id"]: r["sig"] for r in sized.collect()}
    assert sig[1] == sig[2] == sig[6] != sig[3]
    stored = jaccard.packed_texts(docs, "text", sized.select("sig").distinct(), f"texts_{uuid.uuid4().hex}")
    assert sorted(r["sig"] for r in stored.collect()) == sorted({sig[1], sig[3]})
    pairs = spark.createDataFrame([(sig[1], sig[1]), (sig[1], sig[3])], "a bigint, b bigint")
    found = jaccard.verified(pairs, stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(sig[1], sig[1])]
    assert plan.count("Exchange hashpartitioning") == 2  # the pairs, to either side


def test_overlap_bound_at_any_size():
    n, m = np.array([20_000_000, 300, 300]), np.array([20_000_000, 300, 300])
    point = np.full((3, jaccard.GROUPS), 255, np.uint8)
    point[1:] = 1
    point[2, 0] = 255
    assert (jaccard._bound(point, point, np.minimum(n, m)) >= [20_000_000, 256, 300]).all()
    batch = pa.record_batch({"a": [1], "b": [2], "an": n[:1], "bn": m[:1], "ap": [point[0].tobytes()], "bp": [point[0].tobytes()]})
    assert sum(b.num_rows for b in jaccard._pairs_in_bound(80, [batch])) == 1


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (5, 5), (9, 8), (8, 7), (7, 1), (3, 1)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in graph.components(links).collect()}
    assert got == {2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 5: 4}
    assert graph.components(links.limit(0)).count() == 0


def test_toxicity(spark, odd, empty):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        lines = [" ".join(f"w{k}" for k in rng.integers(0, 200, 8)) for _ in range(6)]
        if i % 6 == 0:
            lines[int(rng.integers(6))] += " vilest slur"
        rows.append((i, ".\n".join(lines), int(i % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(3)
    labels = docs.select("doc_id", "toxic").where(~toxicity.held_out())
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic")
    scored = toxicity.score(docs, model, keep=("toxic", "text")).collect()
    assert all((r["score"] >= 0.5) == (r["toxic"] == 1) for r in scored)
    for r in scored:
        assert len(r["offending"]) == r["toxic"]
        assert all("vilest" in r["text"][s["start"] : s["end"]] for s in r["offending"])
    strange = toxicity.score(odd, model).collect()
    assert len(strange) == odd.count() and all(0 <= r["score"] <= 1 for r in strange)
    nothing = toxicity.train(docs, labels.limit(0), "doc_id", "text", "toxic")
    assert toxicity.score(docs, nothing).where("score >= 0.5").count() == 0 and toxicity.score(empty, model).count() == 0
    marks = {r["doc_id"]: r["h"] for r in odd.select("doc_id", toxicity.held_out().alias("h")).collect()}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, h in marks.items())


def test_secrets(spark, empty, tmp_path):
    texts = ["secret=token:abcdefgh", "é PassWord = 'hunter22' and api-key: short", "AKIA" + "A1" * 9, "AKIAAKIA1", "f" * 24 + "g" + "0" * 23, None, "", "token: abcdef token:=xyz12345", "x" + "deadbeef" * 4]
    rows = [*enumerate(texts), (1, texts[1]), (None, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    ledger = str(tmp_path / "ledger")
    secrets.update_ledger(docs, ledger)
    got = collections.Counter((r["doc_id"], r["s"]) for r in secrets.findings(docs, ledger).select("doc_id", secrets.listed(F.col("spans")).alias("s")).collect())
    want = collections.Counter()
    for i, text in rows:
        spans = []
        for k, rule in enumerate(secrets.BASE):
            spans += [(m.start(), k, rule.kind, m.end()) for m in re.finditer(rule.pattern, text or "") if len(m[rule.group]) >= rule.least]
        want[(i, ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(spans)))] += 1
    assert got == want
    n = spark.read.parquet(ledger).count()
    secrets.update_ledger(docs, ledger)  # nothing is new
    assert spark.read.parquet(ledger).count() == n
    newer = [secrets.Rule("hex", r"[0-9a-f]+", 20, version=2), *secrets.BASE[:2]]
    secrets.update_ledger(docs, ledger, rules=newer)  # one rule is new
    assert {tuple(r["rules"]) for r in spark.read.parquet(ledger).collect()} == {tuple(r.name for r in secrets.RULES), ("hex@2",)}
    secrets.update_ledger(empty, str(tmp_path / "none"))
    assert secrets.findings(empty, str(tmp_path / "none")).count() == 0


def test_html_text(spark):
    page = "<html><head><title>T</title><script>x='<p>no</p>'</script></head><body><nav><li>Home</nav><article><header><h1>A &amp; B</h1></header><p>one<b>two</b>\n three<p class='ad'>buy<p>four<!-- no --><div class='comments'><p>me</div></article><footer>f"
    foot = "all rights reserved by the owners of this host forever"
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (3, "http://h/3", ""), (4, "http://h/4", f"<p>unique words here <p>{foot}"), (5, "http://h/5", f"<div>other text</div><div>{foot}</div>"), (6, "http://g/6", f"<p>{foot}"), (7, None, "plain &lt;text&gt;"), (8, "http://k/", f"<p>copied page {foot}"), (9, "http://k/", f"<p>copied page {foot}"), (4, "http://h/4", f"<p>unique words here <p>{foot}")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = collections.Counter((r["page_id"], r["text"], r["n_chars"]) for r in htmltext.main_text(pages).collect())
    want = [(1, "A & B onetwo three four"), (2, ""), (3, ""), (4, "unique words here"), (5, "other text"), (6, foot), (7, "plain <text>"), (8, f"copied page {foot}"), (9, f"copied page {foot}"), (4, "unique words here")]
    assert got == collections.Counter((i, t, len(t)) for i, t in want)


def test_html_articles_in_wrappers():
    cases = [
        ("<body><form id=aspnetForm><div class=header>logo</div><article><p>whole page</p></article><footer>f</footer></form>", ["whole page"]),
        ("<div class='layout sidebar-right'><article>whole <div class=ad>buy</div>page</article><div class=sidebar>s</div></div>", ["whole", "page"]),
        ("<div class='layout sidebar-right'><div class=related><article>a teaser</article></div><article>whole page</article></div>", ["whole page"]),
        ("<form><main><p>whole page</p><nav>n</nav></main></form>", ["whole page"]),
        ("<main><div class=has-sidebar><article>the whole page</article></div></main>", ["the whole page"]),
        ("<article>the text</article><article class='comment'>a reader with more words</article>", ["the text"]),
        ("<article>the text<section class=comments><article>a reader</article></section></article>", ["the text"]),
        ("<article>the text<article role=complementary>other</article></article>", ["the text"]),
        ("<main><p>the text</p><article class='comment-body'>a reader with more words</article></main>", ["the text"]),
        ("<article class='post tag-cookies has-sidebar'>the text</article>", ["the text"]),
        ("<aside><article>a teaser</article></aside><p>open</p>", None),
        ("<div class=related><article>a teaser</article></div><p>open text of the page</p>", None),
        ("<p>open</p><article class=comment>a reader with more words</article>", None),
    ]
    for html, want in cases:
        assert htmltext._article(htmltext.blocks_of(html)) == want, html


def test_pipeline_stages(spark, odd):
    kept = odd
    for stage in (stages.reject_toxic, stages.drop_near_duplicates, stages.drop_contaminated, stages.drop_secrets):
        kept = stage(spark, kept, SF)
        assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.select("doc_id").collect())
    assert [i for none, i in ids if not none] == [0, 1, 2, 3, 4, 5, 9, 10, 11, 12, 14, 15, 16, 18, 19]  # 17 is a run of hex digits
    assert stages.mix_sources(spark, kept, SF).count() > 0


def test_near_duplicates_by_row(spark, odd):
    def words(name, n=30):
        return " ".join(f"{name}{k}" for k in range(n))

    rows = [
        (None, words("a")), (1, words("a") + " tail"), (None, words("b")), (None, words("c")), (None, words("c")), (None, "alone"), (None, None), (None, " \n"),
        (7, words("d")), (7, words("e")), (3, words("d") + " tail"), (8, words("f")), (8, words("f") + " tail"), (9, words("g")), (9, words("g")), (10, words("h")), (10, None), (10, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS).repartition(3)
    got = collections.Counter((r["doc_id"], r["text"]) for r in stages.drop_near_duplicates(spark, docs, SF).collect())
    eighth = [k for k in got if k[0] == 8]
    assert len(eighth) == 1 and eighth[0] in rows
    want = [rows[k] for k in (1, 2, 3, 5, 6, 7, 9, 10, 13, 15, 16, 17)]
    assert got == collections.Counter([*want, *eighth])
    assert "single null id" in [r["text"] for r in stages.drop_near_duplicates(spark, odd, SF).where("doc_id is null").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.ORACLE[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF).select(*columns).collect()
    rows = con.sql(queries.ORACLE[name]).select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert collections.Counter(map(tuple, got)) == collections.Counter(rows)


def test_blocks_of_text_stay_small():
    import tracemalloc

    rng = np.random.default_rng(2)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(0, 5000, 60_000)) for _ in range(3)] + ["ab cd " * 400] * 300)
    for f, limit in ((repeats.samples, 80e6), (toxicity.features, 40e6)):
        tracemalloc.start()
        for _, data, offsets in textgrid.blocks(texts):
            f(data, offsets)
        assert tracemalloc.get_traced_memory()[1] < limit
        tracemalloc.stop()


def test_findings_are_those_of_the_version_asked_for(spark, tmp_path):
    docs = spark.createDataFrame([(1, "f" * 30), (2, "a" * 44), (3, "none")], "doc_id bigint, text string")
    ledger = str(tmp_path / "ledger")
    secrets.update_ledger(docs, ledger)
    strict = [secrets.Rule("hex", r"[0-9a-f]+", 40, version=2)]
    secrets.update_ledger(docs, ledger, rules=strict)

    def found(rules):
        return {r["doc_id"]: r["s"] for r in secrets.findings(docs, ledger, rules=rules).select("doc_id", secrets.listed(F.col("spans")).alias("s")).collect()}

    assert found(strict) == {1: "", 2: "hex:0:44", 3: ""}
    assert found(secrets.RULES) == {1: "hex:0:30", 2: "hex:0:44", 3: ""}
    assert secrets.leaking_blobs(spark, ledger, strict).count() == 1 and secrets.leaking_blobs(spark, ledger).count() == 2


def test_columns_that_clash_and_empty_tables(spark, odd, empty, tmp_path):
    names = "_rate _source rate row mean draws steps key mark id own times blob rules spans score offending n sig class n_words n_hit items token stretch copies"
    wide = odd
    for name in names.split():
        wide = wide.withColumn(name, F.lit(1))
    plain, more = mixture.mix(odd), mixture.mix(wide)
    assert collections.Counter(map(str, more.select(*plain.columns).collect())) == collections.Counter(map(str, plain.collect()))
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").withColumn("n_hit", F.lit(1)).withColumn("token", F.lit(1))
    assert repeats.remove_repeats(wide).count() == odd.count()
    assert contamination.find_contamination(wide, benchmark).count() == odd.count()
    assert jaccard.jaccard_components(wide).count() == odd.count()
    ledger = str(tmp_path / "ledger")
    secrets.update_ledger(wide, ledger)
    assert secrets.findings(wide, ledger).count() == odd.count()
    assert quality.judge(wide, []).count() == odd.count()
    kept, kept_wide = odd, wide
    for stage in (stages.reject_toxic, stages.drop_near_duplicates, stages.drop_contaminated, stages.drop_secrets):
        kept, kept_wide = stage(spark, kept, SF), stage(spark, kept_wide, SF)
        assert kept_wide.columns == wide.columns
        assert sorted(str(r["text"]) for r in kept_wide.collect()) == sorted(str(r["text"]) for r in kept.collect())
        assert stage(spark, empty, SF).count() == 0
    assert stages.mix_sources(spark, empty, SF).count() == 0
    pages = spark.createDataFrame([(1, "http://a/", "<article>x</article>", 1, 1)], "page_id bigint, url string, html string, begin int, text int")
    assert [r["text"] for r in htmltext.main_text(pages).collect()] == ["x"]
    assert htmltext.main_text(pages.limit(0)).count() == 0
    assert urlfilter.filter_urls(pages.withColumn("host", F.lit(1)), pages.limit(0)).count() == 1
    assert urlfilter.filter_urls(pages.limit(0), pages.limit(0)).count() == 0


def test_odd_markup():
    text = htmltext._article
    assert text(htmltext.blocks_of("<article>a<![foo[ b]]>c<![ x</article>")) == ["ac"] or text(htmltext.blocks_of("<article>a<![foo[ b]]>c<![ x>d</article>")) == ["acd"]
    for bad in ("<![", "<![x", "<![CDATA[x]]>", "<!x", "<![if IE]>y<![endif]>"):
        htmltext.blocks_of(f"<article>a{bad}")
    import time

    started = time.perf_counter()
    htmltext.blocks_of("<b>" * 20_000 + "<br>" * 20_000 + "</i>" * 20_000 + "<article>" * 2_000)
    assert time.perf_counter() - started < 5
    for name in ("ad-break-free story", "share-price", "header-image-story"):
        assert text(htmltext.blocks_of(f"<article><div class='{name}'>kept</div></article>")) == ["kept"], name
    for name in ("ad", "ad-slot-2", "site_footer", "x comments-list", "cookie-banner"):
        assert text(htmltext.blocks_of(f"<article>kept<div id='{name}'>gone</div></article>")) == ["kept"], name


def test_of_equal_rows_one_stays_in_any_partitioning(spark):
    rows = [(1, "a b c d e f g", None, f"s{k}", k) for k in range(9)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = {stages.drop_near_duplicates(spark, docs.repartition(n, "n_chars"), SF).first()["source"] for n in (1, 4, 9)}
    assert len(kept) == 1


def test_fine_points_of_long_sets(spark):
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)) for n in (1200, 1100, 5000)]
    sets.append(np.unique(np.concatenate([sets[0][:900], sets[1]])))
    for x in sets:
        for y in sets:
            assert jaccard.fine_bound(jaccard.fine_point(x), jaccard.fine_point(y)) >= len(np.intersect1d(x, y))
    assert jaccard.fine_point(np.arange(300, dtype=np.uint64) << np.uint64(20)) is None  # all in one group: nothing is bounded
    words = [f"w{k}" for k in rng.integers(0, 5000, 24_000)]
    texts = [" ".join(words[:12_000]), " ".join(words[12_000:]), " ".join(words[100:12_000])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sized = jaccard.describe(docs, "doc_id", "text").where("n is not null")
    sig = {r["doc_id"]: r["sig"] for r in sized.collect()}
    pairs = spark.createDataFrame([(sig[0], sig[1]), (sig[0], sig[2])], "a bigint, b bigint")
    assert jaccard.within_bound(pairs, sized.select("sig", "n", "point")).count() == 2  # points of 256 groups do not tell them apart
    stored = jaccard.packed_texts(docs, "text", sized.select("sig"), f"texts_{uuid.uuid4().hex}")
    left = jaccard.within_fine_bound(pairs, stored)
    assert [tuple(r) for r in left.collect()] == [(sig[0], sig[2])] == [tuple(r) for r in jaccard.verified(left, stored).collect()]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


def test_rows_of_cells_stay_small(spark, monkeypatch):
    """Tokens that a row knows only spare repeated pairs: pairs are the same and once each, with any number of them."""
    rows = [(t, s, 40 + s % 3) for t in range(30) for s in range(1, 9)]
    grouped = spark.createDataFrame(rows, "token bigint, sig bigint, n int")
    point = jaccard._shrunk(np.ones(jaccard.GROUPS, np.uint8))
    assert len(point) < 100
    points = spark.createDataFrame([(s, 40 + s % 3, point) for s in range(1, 9)], "sig bigint, n int, point binary")
    roots = spark.createDataFrame([(2, 1)], "node bigint, root bigint")
    want = {(a, b) for a in range(1, 9) for b in range(a + 1, 9)} - {(1, 2)}
    for known in (0, jaccard.KNOWN):
        monkeypatch.setattr(jaccard, "KNOWN", known)
        got = [tuple(r) for r in jaccard.tree_pairs(grouped, points, roots).collect()]
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("most", [htmltext.MAX_BEGINS, 3])
def test_runs_of_a_host_within_articles(spark, monkeypatch, most):
    """A notice without a class, in half of a host's articles, goes; what fewer share, near copies and short runs stay."""
    monkeypatch.setattr(htmltext, "MAX_BEGINS", most)
    notice = "subscribe to our weekly letter and never miss a story again"
    own = [" ".join(f"p{i}w{k}" for k in range(30)) for i in range(12)]
    rows = [(i, f"http://A.b/{i}", f"<article><p>{own[i][:79]}</p><div>{notice}</div><p>{own[i]}</p></article>", f"{own[i][:79]} {own[i]}") for i in range(5)]
    rows += [(i, f"http://a.b/{i}", f"<main><p>{own[i]}</main>", own[i]) for i in range(5, 8)]
    rows += [(20 + i, f"http://few/{i}", f"<article>{own[i]} {notice}</article>", f"{own[i]} {notice}") for i in range(3)]
    rows += [(30 + i, f"http://rare/{i}", f"<article>{own[i]}{f' {notice}' if i < 4 else ''}</article>", f"{own[i]}{f' {notice}' if i < 4 else ''}") for i in range(9)]
    rows += [(40 + i, f"http://near/{i}", f"<article>{own[0]} n{i}</article>", f"{own[0]} n{i}") for i in range(6)]
    rows += [(50 + i, "http://copy/", f"<article>{own[1]}</article>", own[1]) for i in range(6)]
    rows += [(60 + i, f"http://short/{i}", f"<article>{own[i]} read more here</article>", f"{own[i]} read more here") for i in range(6)]
    rows += [rows[0], (None, *rows[1][1:])]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    for parts in (1, 7):
        got = collections.Counter((r["page_id"], r["text"]) for r in htmltext.main_text(pages.repartition(parts)).collect())
        assert got == collections.Counter((r[0], r[3]) for r in rows)


def test_order_of_suffixes(spark):
    """What neighbours share, counted over edges of batches and partitions, is what a plain count finds."""
    rng = np.random.default_rng(4)
    rows = [(int(h), int(b), int(s), bool(f)) for h, b, s, f in zip(rng.integers(0, 2, 400), rng.integers(0, 60, 400) ** 2 // 60, rng.integers(0, 9, 400), rng.integers(0, 2, 400), strict=True)]
    want = {}
    for h, b, s, f in rows:
        streams, pages = want.setdefault((h, b), (set(), []))
        streams.add(s)
        pages.append(f)
    suffixes = spark.createDataFrame(rows, "host bigint, begin bigint, stream bigint, first boolean").repartition(5)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r["host"], r["begin"]): (r["streams"], r["pages"]) for r in htmltext.shared_beginnings(suffixes).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == {k: (len(s), sum(p)) for k, (s, p) in want.items() if len(s) > 1}


def test_beginnings_that_half_of_a_host_may_have(spark):
    """Never leaves out what half of the pages have, and leaves out what one chunk of many has."""
    rng = np.random.default_rng(8)
    for _ in range(3):
        chunks = [(h, int(n)) for h in (1, 2) for n in rng.integers(1, 6, 9)]
        shared, total = [], collections.Counter()
        for h, n in chunks:
            for b in range(40):
                c = int(rng.binomial(n, b / 40))
                total[h, b] += c
                if 2 * c >= n:
                    shared.append((h, b, 2 * c - n))
        got = {tuple(r) for r in htmltext.possible_beginnings(spark.createDataFrame(shared, "host bigint, begin bigint, at int"), spark.createDataFrame([(h,) for h, _ in chunks], "host bigint")).collect()}
        pages = collections.Counter()
        for h, n in chunks:
            pages[h] += n
        assert {k for k, c in total.items() if 2 * c >= pages[k[0]]} <= got and not {(1, 0), (2, 0), (1, 4), (2, 4)} & got

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from cellwise.operators import nearest, summarize
from cellwise.plans.config import FitConfig, SeedConfig
from cellwise.plans.estimator import ParallelKMeans
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.seeding import seed_candidates
from cellwise.sources import profile, sparse

DOCS = ["the cat sat on the mat", "The dog; the LOG", "", "cat dog élan élan Élan", "the"]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id bigint, text string").repartition(3)
    entries = sparse.term_matrix(docs).cache()
    dictionary = sparse.index_columns(entries)
    long = sparse.with_column_ids(entries, dictionary).cache()
    rows = docs.select(F.col("doc_id").alias("row_id"))
    return rows, entries, dictionary, long, dictionary.count()


def brute_weights():
    counts = [Counter(t for t in d.lower().replace(";", " ").split()) for d in DOCS]
    df = Counter(t for c in counts for t in c)
    out = {}
    for i, c in enumerate(counts):
        w = {t: (1 + math.log(n)) * math.log(len(DOCS) / df[t]) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / norm for t, x in w.items() if x > 0})
    return out


def test_term_weights_match_their_formula(corpus):
    got = {(r["row_id"], r["term"]): r["value"] for r in corpus[1].collect()}
    want = brute_weights()
    assert got.keys() == want.keys()
    assert got == pytest.approx(want)


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("budget", [1 << 27, 150, 1])
def test_term_matrix_counts_texts_in_parts(spark, small_blocks, monkeypatch, budget):
    """Repeated and null ids, null texts, rows over several batches and parts, and terms beyond the budget."""
    rng = np.random.default_rng(5)
    words = [f"W{i}" if i % 3 else f"w{i}" for i in range(60)]
    texts = [" ,".join(rng.choice(words, int(rng.integers(0, 30)) if i % 7 else 200)) for i in range(90)]
    table = [(None if i % 11 == 0 else i // 2, None if i == 5 else t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(table, "doc_id bigint, text string").repartition(5)
    counts, df = {}, Counter()
    for i, text in table:
        terms = [t for t in (text or "").lower().replace(",", " ").split()]
        counts.setdefault(i, Counter()).update(terms)
        df.update(set(terms))
    want = {}
    for i, c in counts.items():
        w = {t: (1 + math.log(n)) * math.log(len(table) / df[t]) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want.update({(i, t): x / norm for t, x in w.items() if x > 0})
    small_blocks(budget)
    monkeypatch.setattr(sparse, "_COUNTED_ROWS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        entries = sparse.term_matrix(docs)
        found = [((r["row_id"], r["term"]), r["value"]) for r in entries.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == len(want)
    assert dict(found) == pytest.approx(want)
    # no table of all pairs of row and term is grouped, sorted or dealt: a task's memory is that of its texts
    assert "Window" not in _plan(entries) and "Aggregate" not in _plan(entries)


@pytest.mark.parametrize("budget", [1 << 27, 300, 1])
def test_columns_and_rows_beyond_the_budget(spark, small_blocks, budget):
    """Common columns are joined without dealing entries by term, rarer ones by term; runs of a row meet again."""
    rng = np.random.default_rng(8)
    cells = {(i, f"t{int(j)}"): float(rng.uniform(0.1, 1)) for i in range(40) for j in rng.geometric(0.2, 6)}
    table = [(None if i == 3 else i, t, v) for (i, t), v in cells.items()]
    entries = spark.createDataFrame(table, "row_id bigint, term string, value double").repartition(4)
    dictionary = sparse.index_columns(entries)
    ids = {r["term"]: r["col_id"] for r in dictionary.collect()}
    small_blocks(budget)
    long = sparse.with_column_ids(entries, dictionary)
    assert Counter(tuple(r) for r in long.collect()) == Counter((i, ids[t], v) for i, t, v in table)
    rows = spark.range(45).select(F.col("id").alias("row_id"))
    got = {r["row_id"]: r["features"] for r in sparse.sparse_rows(rows, long, len(ids)).collect()}
    for i, f in got.items():
        assert list(zip(f["indices"], f["values"], strict=True)) == sorted((ids[t], v) for j, t, v in table if j == i)
    # what is dealt by row are runs, not single entries
    assert "MapInArrow" in _plan(sparse.sparse_rows(rows, long, len(ids)))


def test_dictionary_is_dense_and_ordered(corpus):
    found = sorted((r["col_id"], r["term"]) for r in corpus[2].collect())
    assert [i for i, _ in found] == list(range(len(found)))
    assert [t for _, t in found] == sorted(t for _, t in found)


def test_rows_without_entries_are_kept(corpus):
    rows, _, _, long, width = corpus
    vectors = {r["row_id"]: r["features"] for r in sparse.sparse_rows(rows, long, width).collect()}
    assert set(vectors) == set(range(5))
    assert vectors[2]["indices"] == [] and vectors[2]["size"] == width
    assert all(v["indices"] == sorted(v["indices"]) for v in vectors.values())
    counts = {r["row_id"]: r["nnz"] for r in summarize.nnz_per_row(rows, long).collect()}
    assert counts == {i: len(v["indices"]) for i, v in vectors.items()}


def test_clustering_sparse_rows_equals_clustering_dense_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 60")
    entries = sparse.term_matrix(docs).cache()
    dictionary = sparse.index_columns(entries)
    width = dictionary.count()
    rows = docs.select(F.col("doc_id").alias("row_id"))
    thin = sparse.sparse_rows(rows, sparse.with_column_ids(entries, dictionary), width)
    thin = thin.withColumnRenamed("row_id", "point_id").cache()
    dense = thin.select("point_id", nearest.as_dense(thin, "features").alias("features")).cache()

    config = SeedConfig(5, 2, seed=4)
    a, b = seed_candidates(thin, config), seed_candidates(dense, config)
    keep = ("idx", "point_id", "round", "weight")
    assert sorted(a.candidates.select(*keep).collect()) == sorted(b.candidates.select(*keep).collect())
    assert a.log[-1].cost == pytest.approx(b.log[-1].cost)
    start = np.array([nearest.to_array(r["center"]) for r in b.candidates.orderBy("idx").limit(3).collect()])
    left, right = fit_centers(thin, start, FitConfig(3, 0.0)), fit_centers(dense, start, FitConfig(3, 0.0))
    np.testing.assert_allclose(left.centers, right.centers, atol=1e-12)
    both = nearest.classify(thin, left.centers).join(
        nearest.classify(dense, right.centers).select("point_id", F.col("cluster").alias("other")), "point_id"
    )
    assert both.where("cluster <> other").count() == 0
    clusterer = ParallelKMeans(3, 5, 2).seed(thin, seed=4).fit(thin, max_iter=2)
    assert clusterer.final_centers.shape == (3, width)
    clusterer.release(), a.release(), b.release()


def test_sparse_centres_equal_dense_ones(spark, small_blocks):
    rng = np.random.default_rng(3)
    width, table = 300, []
    for i in range(120):
        cols = sorted(rng.choice(width, int(rng.integers(0, 25)), replace=False).tolist())
        table.append((i, (0, width, cols, rng.uniform(0.1, 1, len(cols)).tolist())))
    kind = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    thin = spark.createDataFrame(table, f"point_id bigint, features {kind}").repartition(5).cache()
    far = (0, width, [299], [90.0])  # attracts nothing and keeps its entries
    start = spark.createDataFrame([*[(c, table[c + 1][1]) for c in range(4)], (4, far)], f"cluster int, center {kind}")
    model = fit_centers(thin, start, FitConfig(4, 0.0))
    plain = fit_centers(thin, np.stack([nearest.to_array(r["center"]) for r in start.orderBy("cluster").collect()]), FitConfig(4, 0.0))
    sparse_found = np.stack([nearest.to_array(r["center"]) for r in model.centers_frame(spark).orderBy("cluster").collect()])
    np.testing.assert_allclose(sparse_found, plain.centers, atol=1e-12)
    assert [x.cost for x in model.log] == pytest.approx([x.cost for x in plain.log])
    assert [x.shift for x in model.log] == pytest.approx([x.shift for x in plain.log])
    assert len(model.centers_frame(spark).where("cluster = 4").first()["center"]["indices"]) == 1
    small_blocks(8 * width)  # one centre a block
    again = fit_centers(thin, start, FitConfig(2, 1e9))
    assert again.converged and len(again.log) == 1


def test_ingest_is_idempotent_and_verified(spark, corpus, tmp_path):
    rows, _, _, long, width = corpus
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    y = sparse.label_entries(labels, "doc_id", ["quality", "toxic"])
    out = str(tmp_path / "corpus")
    with pytest.raises(FileNotFoundError, match="ingest"):
        profile.verify_profile(spark, out)
    first = sparse.ingest_sparse(long, y, out, 5, width, 2).first()
    assert (first["n_samples"], first["n_features"], first["n_categories"]) == (5, width, 2)
    assert first["x_nnz"] == long.count() and first["y_nnz"] == 3
    assert first["x_size_mb"] >= 0 and first["save_time_s"] >= 0
    assert {r["ok"] for r in profile.verify_profile(spark, out).collect()} == {True}
    stored = sorted(tuple(r) for r in sparse.load_sparse(spark, first["x_path"]).collect())
    assert stored == sorted(tuple(r) for r in long.collect())

    shorter = long.where("row_id <> 0")
    assert sparse.ingest_sparse(shorter, y, out, 5, width, 2).first() == first  # nothing is rebuilt
    again = sparse.ingest_sparse(shorter, y, out, 5, width, 2, force=True).first()
    assert again["x_nnz"] == shorter.count() < first["x_nnz"]

    sparse.write_sparse(long, first["x_path"], "overwrite")
    with pytest.raises(ValueError, match="x_nnz"):
        profile.verify_profile(spark, out)


def test_forced_ingest_that_dies_is_repeated(spark, corpus, tmp_path, monkeypatch):
    _, _, _, long, width = corpus
    y = spark.createDataFrame([(0, 1)], "row_id bigint, category_id int")
    out = str(tmp_path / "corpus")
    sparse.ingest_sparse(long, y, out, 5, width, 2)
    shorter = long.where("row_id <> 0")
    with monkeypatch.context() as patch:
        patch.setattr(sparse, "dataset_profile", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sparse.ingest_sparse(shorter, y, out, 5, width, 2, force=True)
    assert sparse.ingest_sparse(shorter, y, out, 5, width, 2).first()["x_nnz"] == shorter.count()


def test_verification_sees_lost_rows_and_columns(spark, corpus, tmp_path):
    rows, _, dictionary, long, width = corpus
    y = spark.createDataFrame([(0, 0), (0, 1), (3, 1)], "row_id bigint, category_id int")
    keys = {"rows": rows, "columns": dictionary.select("col_id"), "categories": spark.range(2).selectExpr("cast(id as int)")}

    def failed(name, x=None, y_lost=None, **keys_changed):
        out = str(tmp_path / name)
        stored = sparse.ingest_sparse(long, y, out, 5, width, 2, keys={**keys, **keys_changed}).first()
        if x is not None:
            sparse.write_sparse(x, stored["x_path"], "overwrite")
        if y_lost is not None:
            sparse.write_sparse(y_lost, stored["y_path"], "overwrite")
        return {r["check"]: r["actual"] for r in profile.verification(spark, out).collect() if not r["ok"]}

    assert failed("whole") == {}
    entries = {r["row_id"]: r["count"] for r in long.groupBy("row_id").count().collect()}
    lost = failed("row", long.where("row_id <> 1"))
    assert lost["x_rows_changed"] == 1 and lost["x_nnz"] == long.count() - entries[1]
    assert failed("column", long.where("col_id <> 2"))["x_columns_changed"] == 1
    # as many entries as before, but one in another column, and one in an unknown row
    moved = long.withColumn("col_id", F.when(F.col("col_id") == 2, 0).otherwise(F.col("col_id")))
    assert failed("moved", moved) == {"x_columns_changed": 2}
    strange = long.withColumn("row_id", F.when(F.col("row_id") == 1, 99).otherwise(F.col("row_id")))
    assert failed("strange", strange) == {"x_rows_changed": 2}
    assert set(failed("label", y_lost=y.where("row_id <> 3"))) == {"y_nnz", "y_rows_changed", "y_columns_changed"}
    assert failed("short", rows=rows.where("row_id <> 2")) == {"n_samples": 4}  # a row without entries
    assert failed("narrow", columns=dictionary.select("col_id").where("false")) == {}  # occurring keys stay
    with pytest.raises(ValueError, match="x_rows_changed"):
        profile.verify_profile(spark, str(tmp_path / "strange"))


def test_profile_checks_report_mismatches(spark, corpus):
    _, _, _, long, width = corpus
    y = spark.createDataFrame([(0, 1)], "row_id bigint, category_id int")
    expected = profile.dataset_profile(long, y, 5, width, 2)
    assert expected.first()["y_density_pct"] == 10.0
    checks = profile.profile_checks(long.where("row_id <> 0"), y, 5, width, 2, expected)
    assert {r["check"] for r in checks.where("not ok").collect()} == {"x_nnz"}


def test_libsvm_rows_are_clustered_as_sparse_vectors(spark, tmp_path):
    (tmp_path / "a.libsvm").write_text("0 1:1.0 3:2.0\n1 2:5.0\n")
    frame = sparse.load_libsvm(spark, str(tmp_path / "a.libsvm"), 4)
    got = nearest.nearest_center(frame, np.array([[1.0, 0, 2.0, 0], [0, 5.0, 0, 0]]))
    assert sorted((r["label"], r["idx"], r["d2"]) for r in got.collect()) == [(0.0, 0, 0.0), (1.0, 1, 0.0)]


@pytest.mark.parametrize(
    "values",
    [np.arange(1000) / 7, np.repeat([0.1, 0.2, 0.3], 50), np.array([2.0]), np.random.default_rng(0).normal(size=3000),
     np.arange(0, 101) / 100],
)
def test_histogram_equals_numpy(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = sorted(summarize.histogram(frame, "v").collect())
    counts, edges = np.histogram(values, bins=100)
    assert [r["n"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["lower"] for r in got], edges[:-1])
    assert got[-1]["upper"] == edges[-1]


def test_histograms_of_integers_and_of_nothing(spark):
    frame = spark.createDataFrame([(0,), (0,), (1,), (3,)], "n bigint")
    assert sorted(tuple(r) for r in summarize.integer_histogram(frame, "n").collect()) == [(0, 2), (1, 1), (2, 0), (3, 1)]
    empty = frame.limit(0)
    assert summarize.integer_histogram(empty, "n").count() == 0
    assert summarize.histogram(empty, "n").agg(F.sum("n")).first()[0] == 0


def test_summary_and_ranking(spark):
    frame = spark.createDataFrame([(i, n) for i, n in enumerate([5, 1, 5, 0, 9, 2])], "c int, n bigint")
    assert tuple(summarize.summary(frame, "n").first()) == (6, 0.0, 9.0, pytest.approx(22 / 6), 3.5)
    assert summarize.summary(frame, "n", with_mean=False).columns == ["n", "min", "max", "median"]
    top = sorted(tuple(r) for r in summarize.top_ranked(frame, "n", "c", 3).collect())
    assert top == [(1, 4, 9), (2, 0, 5), (3, 2, 5)]


def test_rows_per_term_counts_the_entries_of_the_matrix(spark):
    texts = [(1, "all One one two"), (2, "all two"), (3, "ALL three"), (4, "all"), (5, " all . ")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    entries = sparse.term_matrix(docs)
    wanted = {r["term"]: 0 for r in sparse.vocabulary(docs).collect()}
    wanted |= {r["term"]: r["count"] for r in entries.groupBy("term").count().collect()}
    assert {r["term"]: r["n"] for r in sparse.rows_per_term(docs).collect()} == wanted
    assert wanted["all"] == 0 and wanted["two"] == 2
    gaps = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sparse.rows_per_term(gaps).count() == 0 == sparse.rows_per_term(gaps.limit(0)).count()


def test_frequencies_of_terms_take_few_bytes(spark, small_blocks, monkeypatch):
    """Terms go to the tasks as keys; those of a shared key as they are."""
    words = [f"élan{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words[i % 2 :] + [f"only{i}"])) for i in range(4)], "doc_id long, text string")
    small_blocks(16 * 60)
    df = sparse._rows_with_term(docs, "text")
    wanted = {r["term"]: r["df"] for r in df.collect()}
    assert "Join" not in _plan(sparse.term_matrix(docs))  # all repeated terms fit
    terms = pa.array(sorted(wanted), pa.large_string())
    stored = {r["term"]: r["key"] for r in df.select("term", sparse._key(F.col("term")).alias("key")).collect()}
    assert sparse._keys(terms).tolist() == [stored[t] for t in terms.to_pylist()]

    def found(keys):
        counts = np.ones(len(terms), np.int64)
        known = sparse._common_terms(df)[0].value.look_up(terms, keys, counts)
        return dict(zip(terms.to_pylist(), counts.tolist(), strict=True)), known

    counts, known = found(sparse._keys(terms))
    assert counts == wanted and known.sum() == 60
    monkeypatch.setattr(sparse, "_key", lambda term: F.length(term).cast("bigint"))
    counts, known = found(np.array([len(t) for t in terms.to_pylist()], np.int64))
    assert counts == wanted and known.all()

"""Centres of any number: the index of blocks, lazy searches, slices of distances, merging in levels."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import make_points
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cellwise.functions import kernels
from cellwise.operators import centers as centers_module
from cellwise.operators import means, nearest
from cellwise.operators.centers import IndexedBlock, build_index, matrix_frame, search_blocks
from cellwise.plans.config import FitConfig, SeedConfig
from cellwise.plans.estimator import ParallelKMeans
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.seeding import seed_candidates

RNG = np.random.default_rng(11)
MATRIX = RNG.normal(size=(300, 5)) * RNG.lognormal(size=(300, 1)) * 4


@pytest.fixture(scope="module")
def points(spark):
    frame = make_points(spark, MATRIX).cache()
    frame.count()
    return frame


def found(frame, *columns):
    return [tuple(r) for r in frame.orderBy("point_id").select(*columns).collect()]


def in_memory(centers, rows):
    """Blocks by norm as the index makes them, and their reader."""
    norms = np.linalg.norm(centers, axis=1)
    order = np.argsort(norms, kind="stable")
    parts = [np.sort(order[lo : lo + rows]) for lo in range(0, len(order), rows)]
    blocks = tuple(IndexedBlock(i, norms[p].min(), norms[p].max()) for i, p in enumerate(parts))
    return blocks, lambda i: (parts[i], centers[parts[i]])


@pytest.mark.parametrize("rows", [1, 7, 300])
def test_blocks_give_the_nearest_centre_and_the_lowest_index(rows):
    centers = np.vstack([MATRIX[:100], MATRIX[:100][::-1], np.zeros((1, 5))])  # ties all over
    want = kernels.nearest(MATRIX, centers)
    got = search_blocks(MATRIX, *in_memory(centers, rows))
    np.testing.assert_array_equal(got[0], want[0])
    np.testing.assert_array_equal(got[1], want[1])


def test_norms_exclude_most_pairs():
    centers = RNG.normal(size=(2000, 5)) * np.repeat(np.geomspace(1, 1e4, 20), 100)[:, None]
    near = centers[RNG.integers(0, 2000, 500)] + RNG.normal(size=(500, 5)) * 0.01
    d2, index, compared = search_blocks(near, *in_memory(centers, 50))
    np.testing.assert_array_equal(index, kernels.nearest(near, centers)[1])
    assert compared < 0.35 * len(near) * len(centers)


def test_search_of_no_points():
    d2, index, compared = search_blocks(np.zeros((0, 5)), *in_memory(MATRIX, 10))
    assert len(d2) == len(index) == compared == 0


def test_index_holds_every_centre_once(spark):
    frame = matrix_frame(spark, MATRIX).repartition(3)
    for by_norm in (True, False):
        index = build_index(frame, 5 * 8 * 7, by_norm=by_norm)
        parts = [index.read(b.number) for b in index.blocks]
        assert max(len(i) for i, _ in parts) <= 7
        numbers = np.concatenate([i for i, _ in parts])
        assert sorted(numbers.tolist()) == list(range(300))
        np.testing.assert_array_equal(np.concatenate([m for _, m in parts]), MATRIX[numbers])
        assert (numbers.tolist() == sorted(numbers.tolist())) == (not by_norm)


def test_equal_centres_are_cut_to_blocks_too(spark):
    index = build_index(matrix_frame(spark, np.ones((50, 2))), 2 * 8 * 4)
    assert len(index.blocks) == 13


def test_sparse_points_against_an_index(spark, small_blocks):
    data = [(i, Vectors.sparse(6, {i % 6: float(i), 5: 1.0})) for i in range(40)]
    frame = spark.createDataFrame(data, ["point_id", "features"])
    centers = RNG.normal(size=(9, 6)) * 10
    want = found(nearest.nearest_center(frame, centers), "idx", "d2")
    small_blocks(8)
    assert found(nearest.nearest_center(frame, centers), "idx", "d2") == want


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, spark.sparkContext.statusTracker().getJobIdsForGroup(group)


def test_classify_is_lazy_at_any_budget(spark, points, small_blocks):
    small_blocks(8)
    clusterer = ParallelKMeans(k=4, l=8, r=2).seed(points, seed=1).fit(points, max_iter=3)
    got, jobs = jobs_of(spark, "lazy-classify", lambda: clusterer.classify(points))
    assert not jobs
    with pytest.raises(ValueError, match="centers_frame"):
        _ = clusterer.final_centers
    table = sorted(clusterer.model.centers_frame(spark).collect())
    centers = np.array([r["center"] for r in table])
    assert [c for (c,) in found(got, "cluster")] == kernels.nearest(MATRIX, centers)[1].tolist()
    clusterer.release()
    small_blocks(1 << 20)
    np.testing.assert_allclose(clusterer.final_centers, centers)


def test_classify_streams_over_many_blocks(spark, points, small_blocks, tmp_path):
    points.write.parquet(str(tmp_path / "in"))
    small_blocks(8)
    stream = spark.readStream.schema(points.schema).parquet(str(tmp_path / "in"))
    query = (
        nearest.classify(stream, MATRIX[:20]).writeStream.format("memory").queryName("classified")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = found(spark.table("classified"), "cluster")
    assert [c for (c,) in got] == kernels.nearest(MATRIX, MATRIX[:20])[1].tolist()


def test_classify_keeps_columns_of_other_meaning(spark, points):
    marked = points.withColumn("d2", F.lit("mine")).withColumn("idx", F.lit("own"))
    row = nearest.classify(marked, MATRIX[:3]).first()
    assert (row["d2"], row["idx"]) == ("mine", "own")


def test_large_rounds_of_seeding_equal_small_ones(spark, points, small_blocks):
    config = SeedConfig(6, 3, seed=5)
    one = seed_candidates(points, config)
    small_blocks(5 * 8 * 2)
    two = seed_candidates(points, config)
    assert found(one.state, "point_id", "idx", "d2") == found(two.state, "point_id", "idx", "d2")
    for seeding in (one, two):
        seeding.release()


def test_slices_join_to_the_whole_vector(spark, points, small_blocks):
    centers = MATRIX[:23]
    want = kernels.distances(MATRIX, centers)
    small_blocks(5 * 8 * 4)
    rows = nearest.distance_slices(points, centers).collect()
    assert max(len(r["distances"]) for r in rows) == 4
    got = np.full(want.shape, np.nan)
    for r in rows:
        got[r["point_id"], r["first"] : r["first"] + len(r["distances"])] = r["distances"]
    np.testing.assert_allclose(got, want, rtol=1e-12)
    assert nearest.distance_slices(points.limit(0), centers).count() == 0


def test_slices_of_very_many_centres(spark):
    """262,144 centres: rows stay slices of one block, whatever the number of points."""
    frame = make_points(spark, MATRIX[:40, :2], 2)
    table = spark.range(1 << 18).select(
        F.col("id").cast("int").alias("idx"), F.array(F.col("id").cast("double"), F.lit(0.0)).alias("center")
    )
    sliced = nearest.distance_slices(frame, table)
    sizes = sliced.groupBy("point_id").agg(F.sum(F.size("distances")).alias("n"), F.max(F.size("distances")).alias("most"))
    assert {(r["n"], r["most"]) for r in sizes.collect()} == {(1 << 18, 1 << 18)}


def test_merging_in_levels(spark, points, monkeypatch):
    monkeypatch.setattr(means, "FAN_IN", 3)
    spread = points.repartition(40).withColumn("cluster", F.lit(0))
    row = means.cluster_means(spread, 5).first()
    np.testing.assert_allclose(row["center"], MATRIX.mean(axis=0), rtol=1e-12)
    assert row["n"] == 300


def test_merged_sums_fold_while_they_wait():
    merged = kernels.MergedSums()
    keys = RNG.integers(0, 50, 30_000)
    sums = RNG.normal(size=(30_000, 4))
    for lo in range(0, len(keys), 1000):
        part = slice(lo, lo + 1000)
        merged.add(kernels.sums_batch(keys[part], keys[part] % 3, np.ones(1000, int), sums[part, 0], sums[part]))
        assert merged.n_waiting <= 4096 + 1000
    (batch,) = merged.drain()
    assert isinstance(batch, pa.RecordBatch) and batch.num_rows == 50
    want = {k: sums[keys == k].sum(axis=0) for k in range(50)}
    for row in batch.to_pylist():
        assert row["segment"] == row["cluster"] % 3 and row["n"] == int((keys == row["cluster"]).sum())
        np.testing.assert_allclose(row["sums"], want[row["cluster"]])
    assert list(merged.drain()) == []


def test_fit_gives_one_kind_of_centres(spark, points, small_blocks):
    plain = fit_centers(points, MATRIX[:4], FitConfig(3, 0.0))
    small_blocks(5 * 8 * 4)
    held = fit_centers(points, plain.centers_frame(spark), FitConfig(1, 0.0))
    assert isinstance(held.centers, np.ndarray) and held.centers_frame(spark).columns == ["cluster", "center"]


KIND = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def sparse_table(n, width, most=12, seed=4):
    """Sparse rows, some without entries, over columns from 0 to the last of ``width``."""
    rng = np.random.default_rng(seed)
    columns = np.r_[np.arange(25), width - 1 - np.arange(25)]
    cells = [sorted(rng.choice(columns, int(rng.integers(0, most)), replace=False).tolist()) for _ in range(n)]
    return [(i, (0, width, c, rng.uniform(0.1, 1, len(c)).tolist())) for i, c in enumerate(cells)]


@pytest.mark.parametrize("budget", [None, 3000, 1])
def test_centres_of_sparse_points_are_never_made_dense(spark, small_blocks, monkeypatch, budget):
    """A row of 2^31 - 1 columns would take 16 GB: neither the driver nor a task makes one, in memory or from an index."""
    def dense(*_):
        raise AssertionError("a sparse vector was made dense")

    monkeypatch.setattr(kernels.SparseRows, "to_dense", dense)
    monkeypatch.setattr(centers_module, "as_dense", dense)
    if budget:
        small_blocks(budget)
    wide, narrow = 2**31 - 1, 50
    table = sparse_table(150, wide)
    frame = spark.createDataFrame(table, f"point_id bigint, features {KIND}").repartition(5).cache()
    seeding = seed_candidates(frame, SeedConfig(6, 2, seed=5))
    chosen = seeding.candidates.select("idx", "point_id", "weight").orderBy("idx").collect()
    matrix = np.zeros((150, narrow))
    for i, (_, _, columns, values) in table:
        matrix[i, [c if c < 25 else wide - 1 - c + 25 for c in columns]] = values
    assert [r["idx"] for r in chosen] == list(range(len(chosen))) and len(chosen) > 3
    apart = ((matrix[:, None] - matrix[[r["point_id"] for r in chosen]][None]) ** 2).sum(axis=2)
    state = sorted(seeding.state.select("point_id", "d2", "idx").collect())
    np.testing.assert_allclose([r["d2"] for r in state], apart.min(axis=1), atol=1e-9)
    np.testing.assert_allclose(apart[np.arange(150), [r["idx"] for r in state]], apart.min(axis=1), atol=1e-9)
    assert [r["weight"] for r in chosen] == np.bincount([r["idx"] for r in state], minlength=len(chosen)).tolist()
    near = nearest.nearest_center(frame, seeding.candidates, index_col="idx").select("point_id", "d2", "idx")
    assert sorted(near.collect()) == state
    seeding.release()
    frame.unpersist()


@pytest.mark.parametrize("budget", [1 << 20, 200])
def test_stored_points_are_seeded_without_a_cached_copy(spark, points, small_blocks, monkeypatch, budget):
    """Equal candidates with sparse and dense points, in memory (also of repeated ids) and from an index."""
    from pyspark.sql import DataFrame

    thin = spark.createDataFrame([(i // 2 if budget > 200 else i, v) for i, v in sparse_table(90, 40)], f"point_id bigint, features {KIND}").repartition(4).cache()
    kept = ("idx", "point_id", "round", "weight")
    small_blocks(budget)
    for frame in (points, thin):
        frame.count()
        one = seed_candidates(frame, SeedConfig(6, 3, seed=5))
        want, state, costs = (sorted(one.candidates.select(*kept).collect()), sorted(one.state.select("point_id", "d2", "idx").collect()), [x.cost for x in one.log])
        one.release()
        with monkeypatch.context() as patch:
            if budget > 200:  # nothing is held, nor written
                patch.setattr(DataFrame, "persist", lambda *_: 1 / 0)
            two = seed_candidates(frame, SeedConfig(6, 3, seed=5, storage=None))
        assert len(want) > 6 and sorted(two.candidates.select(*kept).collect()) == want
        assert sorted(two.state.select("point_id", "d2", "idx").collect()) == state
        assert [x.cost for x in two.log] == pytest.approx(costs)
        two.release()
    thin.unpersist()


def test_slices_to_sparse_centres(spark, points, small_blocks):
    table = [(i, v) for i, v in sparse_table(9, 50)]
    centers = spark.createDataFrame(table, f"idx int, center {KIND}")
    thin = spark.createDataFrame(sparse_table(20, 50, seed=9), f"point_id bigint, features {KIND}")
    plain = thin.select("point_id", nearest.as_dense(thin, "features").alias("features"))
    for budget in (1 << 20, 8 * 50 * 4):
        small_blocks(budget)
        a, b = (sorted((r["point_id"], r["first"] + j, x) for r in nearest.distance_slices(f, centers).collect() for j, x in enumerate(r["distances"])) for f in (thin, plain))
        assert len(a) == 180
        np.testing.assert_allclose(a, b, atol=1e-9)
        both = [sorted(nearest.nearest_center(f, centers).select("point_id", "idx").collect()) for f in (thin, plain)]
        assert both[0] == both[1]

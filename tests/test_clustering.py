"""Seeding, reduction, Lloyd iterations and the estimator."""

import numpy as np
import pytest
from conftest import DATA, make_points
from pyspark.errors import PythonException
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cellwise.functions.scalar import planned_rounds
from cellwise.operators import means, nearest
from cellwise.operators.checks import require_unique, validate_points
from cellwise.operators.joins import join_checked
from cellwise.plans.config import FitConfig, SeedConfig, centers_frame, distance_passes, log_frame
from cellwise.plans.estimator import ParallelKMeans
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.reduce import reduce_candidates
from cellwise.plans.seeding import append_candidates, sampled_rows_bound, seed_candidates
from cellwise.plans.sweep import SweepConfig, spread, sweep
from cellwise.sources.synthetic import blobs
from cellwise.sources.tabular import load_points

RNG = np.random.default_rng(0)
MATRIX = RNG.normal(size=(400, 6)) + RNG.integers(0, 4, (400, 1)) * 8


@pytest.fixture(scope="module")
def points(spark):
    frame = make_points(spark, MATRIX).cache()
    frame.count()
    return frame


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def brute_state(matrix, candidates):
    d2 = ((matrix[:, None, :] - candidates[None, :, :]) ** 2).sum(axis=2)
    return d2.min(axis=1), d2.argmin(axis=1)


def candidate_matrix(seeding):
    found = sorted(seeding.candidates.collect(), key=lambda r: r["idx"])
    assert [r["idx"] for r in found] == list(range(len(found)))
    return np.array([nearest.to_array(r["center"]) for r in found]), found


# --- nearest centre -----------------------------------------------------------


def test_sql_path_arrow_path_and_blocks_agree(spark, points, small_blocks):
    centers = MATRIX[:30]
    fast = rows(nearest.nearest_center(points, centers), "point_id", "idx", "d2")
    slow = rows(nearest.nearest_center_sql(points, centers), "point_id", "idx", "d2")
    assert [r[:2] for r in fast] == [r[:2] for r in slow]
    np.testing.assert_allclose([r[2] for r in fast], [r[2] for r in slow], rtol=1e-12)
    small_blocks(2 * 6 * 8)  # two centres per block: 15 passes, with a lineage cut between
    assert rows(nearest.nearest_center(points, centers), "point_id", "idx", "d2") == fast
    frame = centers_frame(spark, centers)
    assert rows(nearest.nearest_center(points, frame, index_col="cluster"), "point_id", "idx", "d2") == fast


def test_all_distances_give_minimum_and_first_argmin(points, small_blocks):
    centers = np.vstack([MATRIX[:5], MATRIX[:5]])  # every centre twice
    table = nearest.argmin_distance(nearest.min_distances(nearest.all_distances(points, centers)))
    got = table.orderBy("point_id").collect()
    d2, index = brute_state(MATRIX, centers)
    np.testing.assert_allclose([r["d2"] for r in got], d2, rtol=1e-12)
    assert [r["idx"] for r in got] == index.tolist()
    assert max(r["idx"] for r in got) < 5
    small_blocks(3 * 6 * 8)
    again = nearest.all_distances(points, centers).orderBy("point_id").collect()
    assert [r["distances"] for r in again] == [r["distances"] for r in got]


def test_optional_inputs_of_probabilities(points):
    whole = nearest.probabilities(points, 5, MATRIX[:3])
    near = nearest.nearest_center(points, MATRIX[:3])
    again = nearest.probabilities(near, 5, cost=nearest.total_cost(near))
    assert rows(whole, "point_id", "p") == rows(again, "point_id", "p")
    with pytest.raises(ValueError, match="centres"):
        nearest.probabilities(points, 5)


def test_center_indexes_must_have_no_gaps(spark, points):
    gap = centers_frame(spark, MATRIX[:3]).where("cluster <> 1")
    with pytest.raises(ValueError, match="without gaps"):
        nearest.nearest_center(points, gap, index_col="cluster")
    with pytest.raises(ValueError, match="no centres"):
        nearest.nearest_center(points, gap.limit(0), index_col="cluster")


def test_ml_vectors_are_accepted(spark):
    data = [(0, Vectors.sparse(4, [1], [2.0])), (1, Vectors.dense([0.0, 0.0, 1.0, 0.0])), (2, Vectors.sparse(4, [], []))]
    frame = spark.createDataFrame(data, ["point_id", "features"])
    got = nearest.nearest_center(frame, np.array([[0, 2.0, 0, 0], [0, 0, 0, 0]]))
    assert rows(got, "point_id", "idx", "d2") == [(0, 0, 0.0), (1, 1, 1.0), (2, 1, 0.0)]


# --- seeding --------------------------------------------------------------------


def test_seeding_properties(spark, points):
    seeding = seed_candidates(points, SeedConfig(8, 4, seed=3))
    matrix, found = candidate_matrix(seeding)
    originals = {tuple(row) for row in MATRIX}
    assert all(tuple(row) in originals for row in matrix)
    assert sum(r["weight"] for r in found) == len(MATRIX)
    d2, index = brute_state(MATRIX, matrix)
    state = seeding.state.orderBy("point_id").collect()
    np.testing.assert_allclose([r["d2"] for r in state], d2, rtol=1e-9, atol=1e-12)
    assert [r["idx"] for r in state] == index.tolist()
    costs = [r.cost for r in seeding.log]
    assert costs == sorted(costs, reverse=True)
    assert [r["round"] for r in found] == sorted(r["round"] for r in found)
    assert distance_passes(seeding.log) == 1 + sum(1 for r in seeding.log[1:] if r.n_sampled)
    assert log_frame(spark, seeding.log).count() == 5
    seeding.release()


def test_same_candidates_for_any_partitioning(points):
    results = []
    for parts in (1, 5, 20):
        seeding = seed_candidates(points.repartition(parts), SeedConfig(6, 3, seed=11))
        results.append((rows(seeding.candidates, "idx", "point_id", "round", "weight"), seeding.log[-1].cost))
        seeding.release()
    assert results[0][0] == results[1][0] == results[2][0]
    assert results[1][1] == pytest.approx(results[0][1], rel=1e-9)


def test_large_rounds_give_the_same_candidates(points, small_blocks):
    config = SeedConfig(12, 3, seed=5)
    small = seed_candidates(points, config)
    want = rows(small.candidates, "idx", "point_id", "round", "weight")
    want_state = rows(small.state, "point_id", "idx", "d2")
    small.release()
    small_blocks(3 * 6 * 8)  # three candidates per block
    assert sampled_rows_bound(12) * 6 * 8 > 3 * 6 * 8
    large = seed_candidates(points, config)
    assert rows(large.candidates, "idx", "point_id", "round", "weight") == want
    assert rows(large.state, "point_id", "idx", "d2") == want_state
    large.release()


def test_many_rounds_keep_the_plan_short(points):
    seeding = seed_candidates(points, SeedConfig(3, 18, seed=2))
    matrix, _ = candidate_matrix(seeding)
    assert sum(1 for r in seeding.log if r.n_sampled) > 9
    d2, index = brute_state(MATRIX, matrix)
    assert [r["idx"] for r in seeding.state.orderBy("point_id").collect()] == index.tolist()
    assert seeding.log[-1].cost == pytest.approx(d2.sum(), rel=1e-9)
    seeding.release()


def test_append_candidates_numbers_in_key_order(spark, points):
    start = points.where("point_id = 7").select(
        F.lit(0).alias("idx"), "point_id", F.lit(0).alias("round"), F.col("features").alias("center")
    )
    grown = append_candidates(start, points.where("point_id in (300, 4, 50)"), 2)
    assert rows(grown, "idx", "point_id", "round") == [(0, 7, 0), (1, 4, 2), (2, 50, 2), (3, 300, 2)]


def test_planned_rounds():
    assert planned_rounds(np.exp(2.5)) == 2 and planned_rounds(np.exp(3.5)) == 4  # half to even
    assert planned_rounds(0.0) == 0 and planned_rounds(0.5) == 0 and planned_rounds(1.0) == 0
    assert planned_rounds(np.exp(5), alpha=2.0) == 10


def test_rounds_are_planned_from_the_cost(points):
    seeding = seed_candidates(points, SeedConfig(2, None, alpha=0.5))
    assert len(seeding.log) - 1 == planned_rounds(seeding.log[0].cost, 0.5)
    seeding.release()


def test_identical_points_stop_at_cost_zero(spark):
    same = make_points(spark, np.ones((50, 3)))
    seeding = seed_candidates(same, SeedConfig(5, 4))
    assert rows(seeding.candidates, "idx", "weight") == [(0, 50.0)]
    assert len(seeding.log) == 1
    assert seed_candidates(same, SeedConfig(5, None)).log[0].cost == 0.0
    with pytest.raises(ValueError, match=r"k=2 .* gave 1"):
        reduce_candidates(seeding.candidates, 2)


def test_duplicate_points_share_the_first_candidate(spark):
    frame = make_points(spark, np.repeat(MATRIX[:4], 30, axis=0))
    seeding = seed_candidates(frame, SeedConfig(40, 3, seed=1))
    _, found = candidate_matrix(seeding)
    first_seen = {}
    for r in found:
        first_seen.setdefault(tuple(r["center"]), r["idx"])
    assert len(found) > len(first_seen) == 4
    assert all((r["weight"] > 0) == (first_seen[tuple(r["center"])] == r["idx"]) for r in found)


def test_an_empty_round_counts(spark):
    far = make_points(spark, np.array([[0.0], [1.0]]))
    seeding = seed_candidates(far, SeedConfig(1e-9, 3))
    assert [r.n_sampled for r in seeding.log] == [1, 0, 0, 0]
    assert seeding.candidates.count() == 1
    assert distance_passes(seeding.log) == 1


def test_empty_input_and_bad_settings_are_refused(spark, points):
    with pytest.raises(ValueError, match="empty"):
        seed_candidates(points.limit(0), SeedConfig(2, 2))
    with pytest.raises(ValueError, match="positive"):
        SeedConfig(0, 1)


def test_bad_vectors_fail_the_job(spark):
    ragged = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "point_id bigint, features array<double>")
    with pytest.raises(PythonException, match="differ in length"):
        seed_candidates(ragged, SeedConfig(2, 2))


# --- reduction --------------------------------------------------------------------


def test_reduction_gives_exactly_k_centres(spark, points):
    seeding = seed_candidates(points, SeedConfig(20, 4, seed=1))
    n = seeding.candidates.where("weight > 0").count()
    for k in (1, 4, n - 1, n):
        centers = reduce_candidates(seeding.candidates, k)
        assert centers.shape == (k, 6)
        assert len(np.unique(centers, axis=0)) == k
    with pytest.raises(ValueError, match=f"k={n + 1} "):
        reduce_candidates(seeding.candidates, n + 1)
    with pytest.raises(ValueError, match="at least 1"):
        reduce_candidates(seeding.candidates, 0)
    seeding.release()


def test_reduction_respects_weights(spark):
    rows_ = [(0, [0.0], 99.0), (1, [1.0], 1.0), (2, [10.0], 50.0)]
    frame = spark.createDataFrame(rows_, "idx int, center array<double>, weight double")
    centers = np.sort(reduce_candidates(frame, 2).ravel())
    assert centers == pytest.approx([0.01, 10.0])


def test_reduction_of_a_table_draws_the_same(spark, points, small_blocks):
    seeding = seed_candidates(points, SeedConfig(12, 2, seed=3))
    kept = seeding.candidates.cache()
    near = reduce_candidates(kept, 4, seed=9, rng="md5")
    small_blocks(8)
    np.testing.assert_allclose(reduce_candidates(kept, 4, seed=9, rng="md5"), near, rtol=1e-12)
    seeding.release()


def test_reduction_of_copies_is_refused(spark):
    rows_ = [(i, [1.0, 2.0], 1.0) for i in range(5)]
    frame = spark.createDataFrame(rows_, "idx int, center array<double>, weight double")
    with pytest.raises(ValueError, match="k=2 "):
        reduce_candidates(frame, 2)


# --- Lloyd ------------------------------------------------------------------------


def plain_lloyd(matrix, centers, iterations):
    for _ in range(iterations):
        _, index = brute_state(matrix, centers)
        centers = np.array(
            [matrix[index == c].mean(axis=0) if (index == c).any() else centers[c] for c in range(len(centers))]
        )
    return centers


def test_lloyd_matches_a_plain_loop_and_cost_falls(points):
    model = fit_centers(points, MATRIX[:5], FitConfig(6, 0.0))
    np.testing.assert_allclose(model.centers, plain_lloyd(MATRIX, MATRIX[:5], 6), rtol=1e-10)
    costs = [r.cost for r in model.log]
    assert all(a >= b - 1e-9 for a, b in zip(costs, costs[1:], strict=False))


def test_lloyd_stops_below_the_tolerance(points):
    model = fit_centers(points, MATRIX[:5], FitConfig(100, 1e-4))
    assert model.converged and model.log[-1].shift < 1e-4 <= model.log[-2].shift
    assert len(model.log) < 100
    assert not fit_centers(points, MATRIX[:5], FitConfig(1, 1e-4)).converged


def test_no_iterations_return_the_start(points):
    assert np.array_equal(fit_centers(points, MATRIX[:5], FitConfig(0)).centers, MATRIX[:5])


def test_an_empty_cluster_keeps_its_centre(points):
    start = np.vstack([MATRIX[:2], np.full((1, 6), 1e6)])
    assert np.array_equal(fit_centers(points, start, FitConfig(2, 0.0)).centers[2], start[2])


def test_centres_beyond_the_budget_use_tables(spark, points, small_blocks):
    start = np.vstack([MATRIX[:5], np.full((1, 6), 1e6)])
    want = fit_centers(points, start, FitConfig(3, 0.0))
    small_blocks(2 * 6 * 8)
    got = fit_centers(points, start, FitConfig(3, 0.0))
    table = sorted(got.centers_frame(spark).collect())
    np.testing.assert_allclose([r["center"] for r in table], want.centers, rtol=1e-10)
    np.testing.assert_allclose([r.shift for r in got.log], [r.shift for r in want.log], rtol=1e-9)
    np.testing.assert_allclose([r.cost for r in got.log], [r.cost for r in want.log], rtol=1e-9)


def test_start_from_a_table(spark, points):
    got = fit_centers(points, centers_frame(spark, MATRIX[:5]), FitConfig(2, 0.0))
    assert np.array_equal(got.centers, fit_centers(points, MATRIX[:5], FitConfig(2, 0.0)).centers)


def test_means_agree_on_both_paths_and_across_segments(spark):
    wide = np.random.default_rng(4).normal(size=(60, 130))
    frame = make_points(spark, wide).withColumn("cluster", (F.col("point_id") % 7).cast("int"))
    fast = {r["cluster"]: r for r in means.cluster_means(frame, 130).collect()}
    slow = {(r["cluster"], r["dim"]): r["mean"] for r in means.cluster_means_sql(frame).collect()}
    for c in range(7):
        assert fast[c]["n"] == (np.arange(60) % 7 == c).sum()
        np.testing.assert_allclose(fast[c]["center"], wide[np.arange(60) % 7 == c].mean(axis=0), atol=1e-12)
        assert fast[c]["center"][129] == pytest.approx(slow[c, 129])


def test_one_point_and_empty_partitions(spark):
    one = make_points(spark, np.array([[1.0, 2.0]]), partitions=6)
    clusterer = ParallelKMeans(1, 2, 2).seed(one).fit(one)
    assert clusterer.final_centers.tolist() == [[1.0, 2.0]]
    assert clusterer.inertia(one) == 0.0


def test_float_vectors_give_the_same_clusters(spark):
    path = f"{DATA}/embeddings.parquet"
    single = load_points(spark, path, "vec_id", "embedding", as_double=False)
    double = load_points(spark, path, "vec_id", "embedding")
    assert single.schema["features"].dataType.simpleString() == "array<float>"
    one = ParallelKMeans(5, 10, 2).seed(single, seed=1).fit(single, max_iter=3)
    two = ParallelKMeans(5, 10, 2).seed(double, seed=1).fit(double, max_iter=3)
    assert rows(one.candidates, "idx", "point_id", "weight") == rows(two.candidates, "idx", "point_id", "weight")
    np.testing.assert_allclose(one.final_centers, two.final_centers, rtol=1e-9, atol=1e-12)
    one.release(), two.release()


# --- estimator and sweep -------------------------------------------------------------


def test_estimator_finds_separated_blobs(spark):
    data = blobs(spark, 800, 2, 4, seed=42, std=0.3).cache()
    truth = data.groupBy("label").agg(
        F.avg(F.get("features", F.lit(0))).alias("x"), F.avg(F.get("features", F.lit(1))).alias("y")
    )
    best = nearest.inertia(data, np.array([[r["x"], r["y"]] for r in truth.collect()]))
    points = data.select("point_id", "features")
    found = []
    for seed in (1, 2, 3):
        clusterer = ParallelKMeans(4, 8, 4).seed(points, seed=seed).fit(points)
        found.append(clusterer.inertia(points))
        clusterer.release()
    assert min(found) <= best * 1.02
    labels = clusterer.classify(data)
    assert labels.columns == ["point_id", "features", "label", "cluster"]


def test_overrides_and_restart(points):
    clusterer = ParallelKMeans(3, 2, 9)
    with pytest.raises(ValueError, match="seed"):
        clusterer.fit(points)
    with pytest.raises(ValueError, match="fit"):
        _ = clusterer.final_centers
    clusterer.seed(points, l=10, max_iter=2)
    assert len(clusterer.log) == 3
    first = rows(clusterer.candidates, "idx", "point_id")
    clusterer.fit(points, max_iter=1)
    clusterer.seed(points, l=10, max_iter=2)
    assert rows(clusterer.candidates, "idx", "point_id") == first
    assert clusterer.min_distances.count() == len(MATRIX)
    assert clusterer.distance_passes >= 1
    clusterer.release()


def test_sweep_reports_every_configuration(spark, points):
    configs = [SweepConfig(2, 10, 3, k=4), SweepConfig(5, 10, 3, k=4), SweepConfig(5, 1, 1, k=200)]
    result = sweep(points, configs).collect()
    assert [r["run_id"] for r in result][-1] == 2 and "k=200" in result[-1]["error"]
    costs = [r["cost"] for r in result[:2]]
    assert costs == sorted(costs)
    assert costs[0] == pytest.approx(costs[1], rel=1e-6)
    assert {r["parts"] for r in result} == {2, 5}
    assert all(r["workers"] == spark.sparkContext.defaultParallelism for r in result)


@pytest.mark.parametrize("contiguous", [False, True])
def test_spread_changes_only_the_partitions(points, contiguous):
    for n in (1, 5, 20):
        placed = spread(points, n, contiguous=contiguous)
        assert placed.rdd.getNumPartitions() == n
        assert rows(placed, "point_id") == rows(points, "point_id")


# --- checks ----------------------------------------------------------------------------


def test_validate_points(spark, points):
    assert validate_points(points) == 6
    for bad, message in (
        ([(1, None)], "null vectors"),
        ([(None, [1.0])], "null ids"),
        ([(1, [float("nan")])], "bad vectors"),
        ([(1, [1.0, None])], "bad vectors"),
        ([(1, [1.0]), (2, [1.0, 2.0])], "length"),
        ([], "no points"),
    ):
        frame = spark.createDataFrame(bad, "point_id bigint, features array<double>")
        with pytest.raises(ValueError, match=message):
            validate_points(frame)


def test_checked_join_is_the_same_with_and_without_broadcast(spark, points, small_blocks):
    hot = points.withColumn("label", F.when(F.col("point_id") % 3 == 0, 0).otherwise(F.col("point_id") % 5))
    side = spark.createDataFrame([(i, i * 10) for i in range(4)], "label int, value int")
    within = join_checked(hot, side, "label", 8)
    small_blocks(1)
    beyond = join_checked(hot, side, "label", 8)
    assert rows(within, "point_id", "value") == rows(beyond, "point_id", "value")
    assert "Broadcast" in within._jdf.queryExecution().executedPlan().toString()


def test_require_unique(spark, points):
    require_unique(points)
    with pytest.raises(ValueError, match="occurs 2 times"):
        require_unique(points.unionByName(points.where("point_id = 3")))


def test_classify_on_a_stream(spark, tmp_path):
    source = spark.read.parquet(f"{DATA}/embeddings.parquet").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").cast("array<double>").alias("features")
    )
    source.write.parquet(str(tmp_path / "in"))
    centers = np.array([r["features"] for r in source.orderBy("point_id").limit(3).collect()])
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    query = (
        nearest.classify(stream, centers).writeStream.format("memory").queryName("classified")
        .outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table("classified"), "point_id", "cluster") == rows(
        nearest.classify(source, centers), "point_id", "cluster"
    )

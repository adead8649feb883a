"""A grid in shared passes against every run alone."""

import numpy as np
import pytest
from conftest import make_points

from cellwise.plans.config import FitConfig, SeedConfig
from cellwise.plans.grid import cost_many, fit_many, grid, seed_many, step_many
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.seeding import seed_candidates
from cellwise.plans.sweep import SweepConfig, sweep


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    return np.vstack([rng.normal(c, 0.5, (60, 70)) for c in (0.0, 3.0, 9.0)])


@pytest.fixture(scope="module")
def points(spark, matrix):
    return make_points(spark, matrix).cache()


CONFIGS = [SeedConfig(3, 5, seed=1), SeedConfig(6, 2, seed=1), SeedConfig(4, 3, seed=9, rng="md5"), SeedConfig(2, None, seed=2, alpha=0.3)]


def candidate_rows(seeding):
    return sorted((r["idx"], r["point_id"], r["round"], r["weight"]) for r in seeding.candidates.collect())


def logged(log):
    return [(r.phase, r.round, round(r.cost, 6), r.n_sampled, r.n_candidates) for r in log]


def states(seeding):
    return {r["point_id"]: (round(r["d2"], 9), r["idx"]) for r in seeding.state.collect()}


@pytest.mark.parametrize("budget", [None, 70 * 8 * 230])
def test_seedings_equal_single_ones(points, small_blocks, budget):
    if budget:
        small_blocks(budget)  # the shared rounds do not fit, some runs go on alone
    together = seed_many(points, CONFIGS)
    for config, found in zip(CONFIGS, together):
        single = seed_candidates(points, config)
        assert candidate_rows(found) == candidate_rows(single)
        assert logged(found.log) == logged(single.log)
        assert states(found) == states(single)
        single.release()
    for found in together:
        found.release()


@pytest.mark.parametrize("budget", [None, 70 * 8 * 5, 70 * 8 * 2])
def test_fits_equal_single_ones(points, matrix, small_blocks, budget):
    if budget:
        small_blocks(budget)  # one or no model a pass
    starts = [matrix[[0, 60, 120]], matrix[[0, 1]], np.vstack([matrix[:2], np.full(70, 500.0)])]
    configs = [FitConfig(10), FitConfig(1), FitConfig(4)]
    found = fit_many(points, starts, configs)
    costs = cost_many(points, found)
    for start, config, model, cost in zip(starts, configs, found, costs):
        single = fit_centers(points, start, config)
        centers = np.array([r["center"] for r in model.centers_frame(points.sparkSession).orderBy("cluster").collect()])
        alone = np.array([r["center"] for r in single.centers_frame(points.sparkSession).orderBy("cluster").collect()])
        np.testing.assert_allclose(centers, alone, atol=1e-9)
        assert [r.round for r in model.log] == [r.round for r in single.log]
        assert model.converged == single.converged
        direct = ((matrix[:, None, :] - centers[None]) ** 2).sum(2).min(1).sum()
        assert cost == pytest.approx(direct)


def test_step_rejects_what_does_not_fit(points, small_blocks):
    small_blocks(70 * 8)
    with pytest.raises(ValueError, match="exceed"):
        step_many(points, [np.zeros((1, 70)), np.zeros((1, 70))])


def test_nothing_to_do(points, spark):
    assert seed_many(points, []) == [] and fit_many(points, [], []) == [] and step_many(points, []) == []
    assert grid(points, []).collect() == []
    with pytest.raises(ValueError, match="empty"):
        seed_many(make_points(spark, np.zeros((1, 2))).limit(0), [SeedConfig(2, 1)])


def test_grid_equals_sweep_with_fewer_jobs(spark, points):
    configs = [SweepConfig(4, 2, 3, k=k) for k in (2, 3)] + [SweepConfig(4, 4, 2), SweepConfig(8, 4, 2), SweepConfig(4, 1, 1, k=40), SweepConfig(4, 3, 4, seed=7, max_iter=3)]
    sc = spark.sparkContext

    def counted(group, run):
        sc.setJobGroup(group, group)
        rows = run(points, configs).collect()
        sc.setLocalProperty("spark.jobGroup.id", None)
        return rows, len(sc.statusTracker().getJobIdsForGroup(group))

    shared, few = counted("grid", grid)
    single, many = counted("sweep", sweep)
    key = lambda r: (r["run_id"], r["k"], r["l"], r["r"], r["seed"], r["n_candidates"], r["distance_passes"], r["error"])
    assert sorted(map(key, shared)) == sorted(map(key, single))
    costs = {r["run_id"]: r["cost"] for r in single}
    for row in shared:
        assert row["cost"] == (pytest.approx(costs[row["run_id"]]) if costs[row["run_id"]] is not None else None)
    assert [r["cost"] for r in shared if r["cost"] is not None] == sorted(r["cost"] for r in shared if r["cost"] is not None)
    assert shared[-1]["error"] and 2 * few < many

"""A grid of clusterings in shared passes over the points.

Draws depend on seed, round and key alone, so several seedings can take their rounds in
the same two jobs, and several models their iterations in the same one: each batch of
points is decoded once and compared with the centres of every run.  Runs that end drop out.
Everything a run yields equals what it yields alone, up to the order in which sums are added.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions import kernels
from cellwise.functions.scalar import planned_rounds, sampling_probability
from cellwise.functions.uniform import keyed_uniform
from cellwise.operators.centers import CenterBlock
from cellwise.operators.means import PARTIAL_SCHEMA, SEGMENT, center_shift, merge_sums
from cellwise.operators.nearest import CenterSearch, nearest_udf, total_cost
from cellwise.operators.sampling import seed_point
from cellwise.plans.config import FitConfig, KMeansModel, LogRow, SeedConfig, Seeding, distance_passes
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.reduce import TooFewCandidates, reduce_candidates
from cellwise.plans.seeding import sampled_rows_bound, seed_candidates
from cellwise.plans.sweep import SweepConfig
from cellwise.session import center_budget, local_frame, ship_package

GRID_SCHEMA = (
    "run_id int, k int, l double, r int, seed int, n_candidates bigint, distance_passes int, cost double, error string"
)
# Cached rounds stacked before the state is computed from the points again, as in seeding alone.
_ROUNDS_PER_CUT = 4


@dataclass
class _Run:
    """One seeding on its way: its candidates so far and its place in the state."""

    number: int
    config: SeedConfig
    tables: list[pa.Table] = field(default_factory=list)
    matrices: list[np.ndarray] = field(default_factory=list)
    log: list[LogRow] = field(default_factory=list)
    cost: float = 0.0
    planned: int = 0

    @property
    def column(self) -> str:
        return f"run_{self.number}"

    @property
    def n_candidates(self) -> int:
        return sum(len(m) for m in self.matrices)

    def add(self, found: pa.Table, round_number: int, key: str, features: str) -> int:
        """Number drawn points in key order after the candidates so far; returns how many came."""
        if found.num_rows:
            found = found.take(pc.sort_indices(found, sort_keys=[(key, "ascending")]))
            start = self.n_candidates
            idx = np.arange(start, start + found.num_rows, dtype=np.int32)
            rounds = np.full(found.num_rows, round_number, dtype=np.int32)
            columns = {"idx": pa.array(idx), key: found[key], "round": pa.array(rounds), "center": found[features]}
            self.tables.append(pa.table(columns))
            self.matrices.append(np.ascontiguousarray(kernels.densify(kernels.decode_points(found[features]))))
        return found.num_rows


def _near(spark: SparkSession, start: int, matrix: np.ndarray, features: str) -> Column:
    ship_package(spark)
    return nearest_udf(spark.sparkContext.broadcast((start, matrix)))(F.col(features))


def _whole_state(points: DataFrame, runs: list[_Run], features: str) -> DataFrame:
    """Nearest candidate in every run, from the points alone."""
    spark = points.sparkSession
    return points.withColumns({r.column: _near(spark, 0, np.vstack(r.matrices), features) for r in runs})


def _closer_state(state: DataFrame, grown: list[_Run], features: str) -> DataFrame:
    """Compare with the latest candidates of the runs that drew some; on equal distance the older one stays."""
    spark, names = state.sparkSession, state.columns
    near = {
        f"_{r.column}": _near(spark, r.n_candidates - len(r.matrices[-1]), r.matrices[-1], features) for r in grown
    }
    columns = {r.column: F.when(F.col(f"_{r.column}.d2") < F.col(f"{r.column}.d2"), F.col(f"_{r.column}")).otherwise(F.col(r.column)) for r in grown}
    return state.withColumns(near).select(*[columns[c].alias(c) if c in columns else F.col(c) for c in names])


def _set_costs(state: DataFrame, runs: list[_Run]) -> None:
    """Costs of all runs in one job, which also fills the cache of the state."""
    found = state.agg(*[F.sum(F.col(f"{r.column}.d2")) for r in runs]).first()
    for run, cost in zip(runs, found):
        run.cost = float(cost)


def seed_many(
    points: DataFrame, configs: list[SeedConfig], key: str = "point_id", features: str = "features"
) -> list[Seeding]:
    """:func:`seed_candidates` for several configurations, two jobs a round for all of them.

    Every result equals that of its configuration alone.  A run whose next round might not fit
    the session budget beside the others leaves the shared passes and is seeded alone.  The states are views of
    one cached table: releasing one seeding releases the cache of all.
    """
    if not configs:
        return []
    spark, budget = points.sparkSession, center_budget(points.sparkSession)
    points = points.select(key, features)
    runs = [_Run(i, c) for i, c in enumerate(configs)]
    started = time.perf_counter()
    firsts: dict[tuple[int, str], pa.Table] = {}
    for run in runs:
        where = (run.config.seed, run.config.rng)
        if where not in firsts:
            firsts[where] = seed_point(points, key, *where).select(key, features).toArrow()
        if not run.add(firsts[where], 0, key, features):
            raise ValueError("cannot seed clusters from an empty input")
    row_bytes = 8 * max(1, runs[0].matrices[0].shape[1])
    storage = configs[0].storage or StorageLevel.MEMORY_AND_DISK
    state = _whole_state(points, runs, features).persist(storage)
    _set_costs(state, runs)
    for run in runs:
        run.planned = run.config.rounds if run.config.rounds is not None else planned_rounds(run.cost, run.config.alpha)
        run.log.append(LogRow("seed", 0, run.cost, 1, 1, None, time.perf_counter() - started))

    alone: list[_Run] = []
    number, grown_rounds = 0, 0
    while True:
        number += 1
        active = [r for r in runs if r not in alone and number <= r.planned and r.cost > 0.0]
        held = sum(r.n_candidates for r in runs if r not in alone)
        bounds = {r.number: sampled_rows_bound(r.config.oversampling) for r in active}
        while active and (held + sum(bounds[r.number] for r in active)) * row_bytes > budget:
            widest = max(active, key=lambda r: bounds[r.number])
            active.remove(widest)
            alone.append(widest)
            held -= widest.n_candidates
        if not active:
            break
        started = time.perf_counter()
        drawn = {
            f"drawn_{r.number}": keyed_uniform(key, r.config.seed, number, r.config.rng)
            < sampling_probability(F.col(f"{r.column}.d2"), r.config.oversampling, r.cost)
            for r in active
        }
        any_run = F.array_contains(F.array(*drawn), True)
        found = state.select(key, features, *[c.alias(n) for n, c in drawn.items()]).where(any_run).toArrow()
        sizes = {r.number: r.add(found.filter(found[f"drawn_{r.number}"]), number, key, features) for r in active}
        grown = [r for r in active if sizes[r.number]]
        if grown:
            grown_rounds += 1
            together = [r for r in runs if r not in alone]
            restate = grown_rounds % _ROUNDS_PER_CUT == 0
            newer = _whole_state(points, together, features) if restate else _closer_state(state, grown, features)
            newer = newer.persist(storage)
            _set_costs(newer, together)
            state.unpersist()
            state = newer
        elapsed = time.perf_counter() - started
        for run in active:
            run.log.append(LogRow("seed", number, run.cost, sizes[run.number], run.n_candidates, None, elapsed))

    if len(alone) == len(runs):
        state.unpersist()
    weights = _weights(state, [r for r in runs if r not in alone])
    seedings = []
    for run in runs:
        if run in alone:
            seedings.append(seed_candidates(points, run.config, key, features))
            continue
        table = pa.concat_tables(run.tables).append_column("weight", pa.array(weights[run.number]))
        own = state.select(key, features, F.col(f"{run.column}.d2"), F.col(f"{run.column}.idx"))
        seedings.append(Seeding(spark.createDataFrame(table).coalesce(1), own, run.log, [state.unpersist]))
    return seedings


def _weights(state: DataFrame, runs: list[_Run]) -> dict[int, np.ndarray]:
    """Points nearest to each candidate, of all runs in one job."""
    weights = {r.number: np.zeros(r.n_candidates) for r in runs}
    if runs:
        cells = F.array(*[F.struct(F.lit(r.number).alias("run"), F.col(f"{r.column}.idx").alias("idx")) for r in runs])
        counts = state.select(F.inline(cells)).groupBy("run", "idx").agg(F.count(F.lit(1)).alias("n"))
        for run, idx, n in counts.collect():
            weights[run][idx] = n
    return weights


def step_many(
    points: DataFrame, centers: list[np.ndarray], features: str = "features"
) -> list[tuple[np.ndarray, float]]:
    """One iteration of several models in one job: new centres and the cost of the old ones, for each.

    Clusters of all models are numbered one after the other, so the shuffle carries a short row a task,
    model, cluster and segment.  All centres together must fit the session budget.
    """
    if not centers:
        return []
    spark, dim = points.sparkSession, centers[0].shape[1]
    budget, total = center_budget(spark), sum(c.nbytes for c in centers)
    if total > budget:
        raise ValueError(f"{total} bytes of centres exceed spark.cellwise.maxCenterBytes")
    ship_package(spark)
    shared = spark.sparkContext.broadcast(centers)
    offsets = np.cumsum([0] + [len(c) for c in centers])
    segment = min(SEGMENT, dim)

    def assign_and_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        partial = kernels.PartialSums(max(budget, 2 * total))
        for batch in batches:
            if batch.num_rows:
                block = kernels.decode_points(batch.column(0), dim)
                for offset, matrix in zip(offsets, models):
                    d2, clusters = kernels.nearest(block, matrix)
                    partial.add(block, clusters + offset, d2)
        yield from partial.drain(segment)

    found = merge_sums(points.select(features).mapInArrow(assign_and_sum, PARTIAL_SCHEMA)).toArrow()
    shared.unpersist()
    cluster, part, n, cost = (found[c].to_numpy() for c in ("cluster", "segment", "n", "cost"))
    size = int(offsets[-1])
    sums = np.zeros((size, -(-dim // segment), segment))
    if found.num_rows:
        sums[cluster, part] = found["sums"].combine_chunks().flatten().to_numpy().reshape(-1, segment)
    sums = sums.reshape(size, -1)[:, :dim]
    counts, costs = np.bincount(cluster, n, size), np.bincount(cluster, cost, size)
    results = []
    for lo, hi, old in zip(offsets, offsets[1:], centers):
        filled = counts[lo:hi] > 0
        new = old.copy()
        new[filled] = sums[lo:hi][filled] / counts[lo:hi][filled, None]
        results.append((new, float(costs[lo:hi].sum())))
    return results


def _packed(centers: dict[int, np.ndarray], budget: int) -> Iterator[list[int]]:
    """Runs whose centres fit one pass together, in order; each run fits alone."""
    pack, held = [], 0
    for run, matrix in centers.items():
        if pack and held + matrix.nbytes > budget:
            yield pack
            pack, held = [], 0
        pack.append(run)
        held += matrix.nbytes
    if pack:
        yield pack


def fit_many(
    points: DataFrame, starts: list[np.ndarray], configs: list[FitConfig], features: str = "features"
) -> list[KMeansModel]:
    """:func:`fit_centers` for several starts, one pass an iteration for all that fit the budget together.

    Starts that exceed the budget each are fitted alone.
    """
    if len(starts) != len(configs):
        raise ValueError("one fit configuration a start is needed")
    budget = center_budget(points.sparkSession)
    models: list[KMeansModel | None] = [None] * len(starts)
    small = {}
    for i, start in enumerate(starts):
        if start.nbytes > budget:
            models[i] = fit_centers(points, start, configs[i], features)
        else:
            models[i] = KMeansModel(start, [], False)
            small[i] = start
    number = 0
    while True:
        number += 1
        active = {i: models[i].held for i in small if not models[i].converged and number <= configs[i].max_iter}
        if not active:
            return models
        for pack in _packed(active, budget):
            started = time.perf_counter()
            stepped = step_many(points, [active[i] for i in pack], features)
            elapsed = time.perf_counter() - started
            for i, (new, cost) in zip(pack, stepped):
                shift = center_shift(active[i], new)
                models[i].held = new
                models[i].converged = shift < configs[i].tol
                models[i].log.append(LogRow("lloyd", number, cost, None, None, shift, elapsed))


def cost_many(points: DataFrame, models: list[KMeansModel], features: str = "features") -> list[float]:
    """Sum of squared distances to the nearest centre, for each model; a pass for all that fit the budget together."""
    spark = points.sparkSession
    budget = center_budget(spark)
    held = {i: m.held for i, m in enumerate(models)}
    small = {i: h for i, h in held.items() if isinstance(h, np.ndarray) and h.nbytes <= budget}
    costs = [0.0] * len(models)
    for pack in _packed(small, budget):
        for i, (_, cost) in zip(pack, step_many(points, [small[i] for i in pack], features)):
            costs[i] = cost
    for i in held.keys() - small.keys():
        search = CenterSearch(spark, held[i], "cluster")
        costs[i] = total_cost(search.nearest(points, features))
        search.release()
    return costs


def grid(points: DataFrame, configs: Iterable[SweepConfig], key: str = "point_id", features: str = "features") -> DataFrame:
    """One row a configuration, cheapest clustering first, from shared passes.

    Where :func:`cellwise.plans.sweep.sweep` measures each run by itself, this finds the best one with the
    fewest passes: configurations with equal seeding share it, all seedings share their rounds and all
    models their iterations.  Points stay in the partitions they come in, ``parts`` is not used.
    """
    spark, configs = points.sparkSession, list(configs)
    plans = [SeedConfig(oversampling=c.l, rounds=c.r, seed=c.seed, rng=c.rng) for c in configs]
    kinds = [(p.oversampling, p.rounds, p.seed, p.rng) for p in plans]
    distinct = list(dict.fromkeys(kinds))
    held = points.select(key, features).persist(StorageLevel.MEMORY_AND_DISK)
    seedings: list[Seeding] = []
    try:
        seedings = seed_many(held, [plans[kinds.index(kind)] for kind in distinct], key, features)
        starts: dict[tuple, np.ndarray] = {}
        errors: dict[tuple, str] = {}
        for c, kind in zip(configs, kinds):
            if (kind, c.k) not in starts and (kind, c.k) not in errors:
                try:
                    starts[kind, c.k] = reduce_candidates(seedings[distinct.index(kind)].candidates, c.k, c.seed, c.rng)
                except TooFewCandidates as problem:
                    errors[kind, c.k] = str(problem)
        wanted = list(dict.fromkeys((kind, c.k, c.max_iter) for c, kind in zip(configs, kinds) if (kind, c.k) in starts))
        models = fit_many(held, [starts[w[:2]] for w in wanted], [FitConfig(w[2]) for w in wanted], features)
        costs = dict(zip(wanted, cost_many(held, models, features)))
    finally:
        for seeding in seedings:
            seeding.release()
        held.unpersist()
    rows = []
    for run_id, (c, kind) in enumerate(zip(configs, kinds)):
        log = seedings[distinct.index(kind)].log
        sampled = [row.n_candidates for row in log if row.n_candidates]
        rows.append((
            run_id, c.k, float(c.l), c.r, c.seed, sampled[-1] if sampled else None, distance_passes(log),
            costs.get((kind, c.k, c.max_iter)), errors.get((kind, c.k)),
        ))
    frame = local_frame(spark, rows, GRID_SCHEMA)
    return frame.orderBy(F.col("cost").asc_nulls_last(), "run_id")

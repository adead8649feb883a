"""Parallel oversampling seeding (k-means||; Bahmani et al., VLDB 2012).

Two Spark jobs per round: one aggregates the cost while caching the updated
per-point state, one samples new candidates from that cache.  Points never leave
the executors; the driver sees one cost per round and the few sampled points.
Points that are stored already need not be cached: their distances are computed again.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions import kernels
from cellwise.functions.scalar import planned_rounds, sampling_probability
from cellwise.operators.centers import is_sparse, stored_bytes
from cellwise.operators.indexing import with_consecutive_index
from cellwise.operators.nearest import (
    CenterBlock,
    CenterSearch,
    total_cost,
    update_nearest,
    with_nearest,
)
from cellwise.operators.sampling import sample_by_probability, seed_point
from cellwise.operators.weights import candidate_weights
from cellwise.plans.config import LogRow, SeedConfig, Seeding
from cellwise.session import center_budget, cut_lineage



# Cached rounds stacked before the plan is cut.  Spark prints a cached adaptive plan twice
# within the plan that reads it, so planning time doubles with every level.
_ROUNDS_PER_CUT = 4


def sampled_rows_bound(oversampling: float) -> int:
    """Rows a round may sample, but for a probability below exp(-oversampling - 100).

    The draws are independent and at most ``oversampling`` rows are expected, so
    the Chernoff bound applies.
    """
    return int(4 * oversampling) + 200


def sample_round(
    state: DataFrame, config: SeedConfig, round_number: int, cost: float, key: str = "point_id"
) -> DataFrame:
    """Points drawn in one round, each with probability ``min(1, d2 * l / cost)``."""
    p = sampling_probability("d2", config.oversampling, cost)
    return sample_by_probability(state, key, p, config.seed, round_number, config.rng)


def append_candidates(
    candidates: DataFrame, sampled: DataFrame, round_number: int, key: str = "point_id",
    features: str = "features",
) -> DataFrame:
    """Append sampled points, numbering them after the last candidate in key order."""
    start = candidates.agg(F.coalesce(F.max("idx") + 1, F.lit(0))).first()[0]
    numbered = with_consecutive_index(sampled.select(key, features), key, start)
    return candidates.unionByName(_candidate_rows(numbered, round_number, key, features))


def _candidate_rows(numbered: DataFrame, round_number: int, key: str, features: str) -> DataFrame:
    return numbered.select(
        F.col("idx").cast("int").alias("idx"),
        F.col(key),
        F.lit(round_number).cast("int").alias("round"),
        F.col(features).alias("center"),
    )


class _SmallRound:
    """Candidates of one round, collected as an Arrow table; sparse ones keep to their stored entries."""

    def __init__(self, sampled: DataFrame, start: int, number: int, key: str, features: str):
        found = sampled.select(key, features).toArrow()
        found = found.take(pc.sort_indices(found, sort_keys=[(key, "ascending")]))
        self.spark, self.start, self.size = sampled.sparkSession, start, found.num_rows
        self.table = pa.table(
            {
                "idx": pa.array(np.arange(start, start + self.size), pa.int32()),
                key: found[key],
                "round": pa.array(np.full(self.size, number), pa.int32()),
                "center": found[features],
            }
        )
        if self.size:
            self.matrix = kernels.lean(kernels.decode_points(found[features]))

    def blocks(self) -> Iterator[CenterBlock]:
        return iter([CenterBlock(self.start, self.matrix)])

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.table).coalesce(1)


class _LargeRound:
    """Candidates of a round that may be too large to collect at once.

    They are numbered and written by Spark, and compared from an index in blocks.
    """

    def __init__(self, sampled: DataFrame, start: int, number: int, key: str, features: str):
        numbered = with_consecutive_index(sampled.select(key, features), key, start)
        self.rows = _candidate_rows(numbered, number, key, features)
        self.size = self.rows.count()

    def frame(self) -> DataFrame:
        return self.rows


@dataclass
class _Measure:
    """Sum and greatest of the distances of a state, most stored values of a point, points by nearest candidate."""

    cost: float
    farthest: float
    longest: int
    counts: dict[int, int]


def _measure(state: DataFrame, features: str) -> _Measure:
    """One pass; the driver gets a row for each candidate that attracts points."""
    entries = F.size(f"{features}.values") if is_sparse(state, features) else F.lit(0)
    by_candidate = state.groupBy("idx").agg(F.sum("d2"), F.max("d2"), F.max(entries), F.count(F.lit(1)))
    found = by_candidate.collect()
    cost = float(sum(r[1] for r in found))
    return _Measure(cost, max(r[2] for r in found), max(r[3] for r in found), {r[0]: r[4] for r in found})


def _in_reach(points: DataFrame, config: SeedConfig, number: int, last: _Measure, key: str) -> DataFrame:
    """Points that a round draws if they are as far as the farthest one; of the others it draws none."""
    p = sampling_probability(F.lit(last.farthest), config.oversampling, last.cost)
    return sample_by_probability(points, key, p, config.seed, number, config.rng)


def seed_candidates(
    points: DataFrame, config: SeedConfig, key: str = "point_id", features: str = "features"
) -> Seeding:
    """Choose weighted candidates for the starting centres.

    ``points`` needs a unique ``key``.  Draws depend on ``(seed, round, key)``
    only, so retries and repartitioning do not change which points are drawn.
    """
    spark = points.sparkSession
    budget = center_budget(spark)
    points = points.select(key, features)
    log: list[LogRow] = []
    started = time.perf_counter()

    first = _SmallRound(seed_point(points, key, config.seed, config.rng), 0, 0, key, features)
    if not first.size:
        raise ValueError("cannot seed clusters from an empty input")
    round_bound = sampled_rows_bound(config.oversampling)
    rounds: list[_SmallRound | _LargeRound] = [first]
    n_candidates = 1
    held = config.storage is not None  # whether the state is stored with its distances
    state = with_nearest(points, next(first.blocks()), features)
    if held:
        state = state.persist(config.storage)
    last = _measure(state, features)  # fills the cache in the same job
    cost, dim = last.cost, kernels.points_dim(first.matrix)
    row_bytes = stored_bytes(last.longest, dim) if is_sparse(points, features) else 8 * max(1, dim)
    log.append(LogRow("seed", 0, cost, 1, 1, None, time.perf_counter() - started))

    planned = config.rounds if config.rounds is not None else planned_rounds(cost, config.alpha)
    for number in range(1, planned + 1):
        if cost <= 0.0:
            break
        started = time.perf_counter()
        drawn_from = state if held else _restated(_in_reach(points, config, number, last, key), rounds, features)
        sampled = sample_round(drawn_from, config, number, cost, key)
        # collected candidates stay on the driver, so all of them count
        small = (n_candidates + round_bound) * row_bytes <= budget
        if small:
            added = _SmallRound(sampled, n_candidates, number, key, features)
        else:
            added = _LargeRound(sampled, n_candidates, number, key, features)
        if added.size:
            rounds.append(added)
            n_candidates += added.size
            if not small:
                newer = cut_lineage(CenterSearch(spark, added.rows).update(state, features))
                held = True
            elif not held or (len(rounds) - 1) % _ROUNDS_PER_CUT == 0:
                newer = _restated(points, rounds, features)
            else:
                newer = update_nearest(state, next(added.blocks()), features)
            if small and held:
                newer = newer.persist(config.storage)
            if small:
                last = _measure(newer, features)
                cost = last.cost
            else:
                cost = total_cost(newer)
            state.unpersist()
            state = newer
        # a round without samples counts as a round
        elapsed = time.perf_counter() - started
        log.append(LogRow("seed", number, cost, added.size, n_candidates, None, elapsed))

    return Seeding(_weighted(spark, rounds, state, last.counts), state, log, [state.unpersist])


def _weighted(spark: SparkSession, rounds: list, state: DataFrame, counts: dict[int, int]) -> DataFrame:
    """All candidates with the number of points nearest to each; ``counts`` are those of collected candidates."""
    if all(isinstance(r, _SmallRound) for r in rounds):
        table = pa.concat_tables(r.table for r in rounds)
        weights = np.zeros(table.num_rows)
        for number, n in counts.items():
            weights[number] = n
        return spark.createDataFrame(table.append_column("weight", pa.array(weights))).coalesce(1)
    return cut_lineage(candidate_weights(_union(rounds), state))


def _union(rounds: list) -> DataFrame:
    whole = rounds[0].frame()
    for r in rounds[1:]:
        whole = whole.unionByName(r.frame())
    return whole


def _restated(points: DataFrame, rounds: list[_SmallRound], features: str) -> DataFrame:
    """The state computed from the input, so that a lost executor costs one pass, not all rounds.

    Keeping the closer candidate round by round equals comparing with all of them at
    once.  Their size was checked when the last round was collected.
    """
    return with_nearest(points, CenterBlock(0, kernels.stack([r.matrix for r in rounds])), features)

"""Parameter sweep: seed, fit, time and score every configuration."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from cellwise.plans.estimator import ParallelKMeans
from cellwise.plans.reduce import TooFewCandidates
from cellwise.session import local_frame

RESULT_SCHEMA = (
    "run_id int, workers int, parts int, k int, l double, r int, seed int, "
    "n_candidates bigint, distance_passes int, cost double, time double, error string"
)


@dataclass(frozen=True)
class SweepConfig:
    parts: int
    l: float  # noqa: E741 - public parameter name
    r: int | None
    k: int = 5
    seed: int = 42
    max_iter: int = 10
    rng: str = "xxhash64"


def spread(points: DataFrame, parts: int, key: str = "point_id", contiguous: bool = False) -> DataFrame:
    """Points in ``parts`` partitions: dealt out evenly, or as contiguous key ranges."""
    return points.repartitionByRange(parts, key) if contiguous else points.repartition(parts)


def sweep(points: DataFrame, configs: Iterable[SweepConfig], key: str = "point_id") -> DataFrame:
    """One result row per configuration, cheapest clustering first.

    ``workers`` is the parallelism of the session.  Points are spread and cached
    again only when the partition count changes.  A configuration that yields too
    few candidates for ``k`` is reported in ``error`` and does not stop the sweep.
    """
    spark = points.sparkSession
    workers = spark.sparkContext.defaultParallelism
    results, cached, current = [], None, None
    try:
        for run_id, c in enumerate(configs):
            if c.parts != current:
                if cached is not None:
                    cached.unpersist()
                cached = spread(points, c.parts).persist(StorageLevel.MEMORY_AND_DISK)
                cached.count()
                current = c.parts
            results.append(_run(run_id, workers, cached, c, key))
    finally:
        if cached is not None:
            cached.unpersist()
    frame = local_frame(spark, results, RESULT_SCHEMA)
    return frame.orderBy(frame["cost"].asc_nulls_last(), "run_id")


def _run(run_id: int, workers: int, points: DataFrame, c: SweepConfig, key: str) -> tuple:
    clusterer = ParallelKMeans(c.k, c.l, c.r)
    started = time.perf_counter()
    cost, error = None, None
    try:
        clusterer.seed(points, seed=c.seed, rng=c.rng, key=key)
        clusterer.fit(points, max_iter=c.max_iter)
        elapsed = time.perf_counter() - started
        cost = clusterer.inertia(points)
    except TooFewCandidates as problem:
        elapsed, error = time.perf_counter() - started, str(problem)
    finally:
        clusterer.release()
    sampled = [row.n_candidates for row in clusterer.log if row.n_candidates]
    return (
        run_id, workers, c.parts, c.k, float(c.l), c.r, c.seed,
        sampled[-1] if sampled else None, clusterer.distance_passes, cost, elapsed, error,
    )

"""Parameters and results of the clustering plans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from cellwise.operators.centers import as_matrix, vector_length
from cellwise.operators.nearest import CenterSearch
from cellwise.session import center_budget, local_frame

LOG_SCHEMA = (
    "phase string, round int, cost double, n_sampled bigint, n_candidates bigint, "
    "shift double, elapsed_s double"
)


@dataclass(frozen=True)
class SeedConfig:
    """Parallel oversampling seeding.

    ``oversampling`` is the expected number of new candidates per round.
    ``rounds=None`` plans ``alpha * ln(initial cost)`` rounds.  ``storage=None`` is for points that
    can be read again at little cost: distances are computed from them in every round, and no copy is cached.
    """

    oversampling: float
    rounds: int | None = None
    alpha: float = 1.0
    seed: int = 42
    rng: str = "xxhash64"
    storage: StorageLevel | None = field(default_factory=lambda: StorageLevel.MEMORY_AND_DISK)

    def __post_init__(self):
        if self.oversampling <= 0:
            raise ValueError("oversampling must be positive")


@dataclass(frozen=True)
class FitConfig:
    """Lloyd iterations: stop after ``max_iter`` or when the centres move less than ``tol``."""

    max_iter: int = 100
    tol: float = 1e-4


@dataclass
class LogRow:
    phase: str
    round: int
    cost: float | None = None
    n_sampled: int | None = None
    n_candidates: int | None = None
    shift: float | None = None
    elapsed_s: float | None = None

    def as_tuple(self) -> tuple:
        return (
            self.phase, self.round, self.cost, self.n_sampled,
            self.n_candidates, self.shift, self.elapsed_s,
        )


def log_frame(spark: SparkSession, log: list[LogRow]) -> DataFrame:
    """Iteration log as a DataFrame; one row per seeding round or Lloyd iteration."""
    return local_frame(spark, [row.as_tuple() for row in log], LOG_SCHEMA)


def distance_passes(log: list[LogRow]) -> int:
    """Full passes of distance computations during seeding.

    One for the first candidate and one per round that sampled something.
    """
    return sum(1 for row in log if row.phase == "seed" and (row.round == 0 or row.n_sampled))


@dataclass
class Seeding:
    """Candidates with weights, and the per-point state that led to them.

    ``state`` holds ``d2`` (distance to the nearest candidate) for every point and
    stays cached until :meth:`release` is called, if the points are cached at all.
    """

    candidates: DataFrame  # idx int, point_id, round int, center, weight double
    state: DataFrame  # point_id, features, d2, idx
    log: list[LogRow]
    _cleanup: list[Callable[[], object]] = field(default_factory=list)

    def release(self) -> None:
        for action in self._cleanup:
            action()
        self._cleanup.clear()


@dataclass
class KMeansModel:
    """Final centres and how they were found.

    :attr:`centers` is always a matrix, :meth:`centers_frame` always a table
    ``(cluster, center)``, and :meth:`search` finds nearest centres, whichever way they are held.
    """

    held: np.ndarray | DataFrame
    log: list[LogRow]
    converged: bool
    _search: CenterSearch | None = None

    @property
    def centers(self) -> np.ndarray:
        """All centres on the driver; an error if they exceed the session budget."""
        if isinstance(self.held, np.ndarray):
            return self.held
        spark = self.held.sparkSession
        n = self.held.count()
        if n * vector_length(self.held, "center") * 8 > center_budget(spark):
            raise ValueError(f"{n} centres exceed spark.cellwise.maxCenterBytes: use centers_frame()")
        return as_matrix(r["center"] for r in sorted(self.held.collect(), key=lambda r: r["cluster"]))

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        return centers_frame(spark, self.held) if isinstance(self.held, np.ndarray) else self.held

    def search(self, spark: SparkSession) -> CenterSearch:
        """The centres prepared for lazy searches, once a model."""
        if self._search is None:
            self._search = CenterSearch(spark, self.held, "cluster")
        return self._search

    def release(self) -> None:
        if self._search is not None:
            self._search.release()


def centers_frame(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    """Centres as ``(cluster, center)`` rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
    return local_frame(spark, rows, "cluster int, center array<double>")

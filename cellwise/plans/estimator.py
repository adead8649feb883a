"""The clustering API in one object: seed, fit, classify, score."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from cellwise.operators import nearest
from cellwise.plans.config import FitConfig, KMeansModel, LogRow, SeedConfig, distance_passes, log_frame
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.reduce import reduce_candidates
from cellwise.plans.seeding import seed_candidates


class ParallelKMeans:
    """k-means with parallel oversampling seeding over a DataFrame of vectors.

    ``k`` clusters, oversampling factor ``l``, ``r`` seeding rounds (``None``:
    planned from the initial cost).  Points are rows ``(point_id, features)`` with
    a unique id and ``array<double>`` or ML-vector features.  Calling ``seed`` or
    ``fit`` again starts afresh.
    """

    def __init__(self, k: int, l: float, r: int | None = None):  # noqa: E741 - public parameter name
        self.k, self.l, self.r = k, l, r
        self.candidates: DataFrame | None = None
        self.starting_centers: np.ndarray | None = None
        self.model: KMeansModel | None = None
        self.min_distances: DataFrame | None = None
        self._seeding = None
        self._seed_log: list[LogRow] = []

    def seed(
        self,
        points: DataFrame,
        alpha: float = 1.0,
        l: float | None = None,  # noqa: E741
        max_iter: int | None = None,
        seed: int = 42,
        rng: str = "xxhash64",
        key: str = "point_id",
        features: str = "features",
    ) -> "ParallelKMeans":
        """Compute ``starting_centers``; ``l`` and ``max_iter`` override ``l`` and ``r``."""
        self.release()
        config = SeedConfig(
            oversampling=self.l if l is None else l,
            rounds=self.r if max_iter is None else max_iter,
            alpha=alpha, seed=seed, rng=rng,
        )
        self._seeding = seed_candidates(points, config, key, features)
        self._seed_log = self._seeding.log
        self.candidates = self._seeding.candidates
        self.min_distances = self._seeding.state.select(key, "d2")
        self.model = None
        self.starting_centers = reduce_candidates(self.candidates, self.k, seed, rng)
        return self

    def fit(
        self, points: DataFrame, max_iter: int = 100, tol: float = 1e-4, features: str = "features"
    ) -> "ParallelKMeans":
        """Refine the starting centres with Lloyd iterations."""
        if self.starting_centers is None:
            raise ValueError("call seed() before fit()")
        self.model = fit_centers(points, self.starting_centers, FitConfig(max_iter, tol), features)
        self.model.search(points.sparkSession)  # prepared here, so that classify() runs no job
        return self

    @property
    def final_centers(self) -> np.ndarray:
        """The fitted centres as a matrix; beyond the session budget take ``model.centers_frame()``."""
        return self._fitted().centers

    def _fitted(self) -> KMeansModel:
        if self.model is None:
            raise ValueError("call fit() first")
        return self.model

    def classify(self, points: DataFrame, features: str = "features") -> DataFrame:
        """Lazily add ``cluster``, the index of the nearest final centre; runs no job, streams included."""
        return nearest.classify(points, self._fitted().search(points.sparkSession), features)

    def inertia(self, points: DataFrame, features: str = "features") -> float:
        """Sum of squared distances to the nearest final centre."""
        return nearest.total_cost(self._fitted().search(points.sparkSession).nearest(points, features))

    @property
    def log(self) -> list[LogRow]:
        return self._seed_log + (self.model.log if self.model else [])

    def iteration_log(self, points: DataFrame) -> DataFrame:
        return log_frame(points.sparkSession, self.log)

    @property
    def distance_passes(self) -> int:
        return distance_passes(self.log)

    def release(self) -> None:
        """Free the cached seeding state and the executors' copies of the centres."""
        if self._seeding is not None:
            self._seeding.release()
            self._seeding = None
        if self.model is not None:
            self.model.release()

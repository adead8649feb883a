"""Lloyd iterations: assign, average, keep empty clusters, test the shift."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.operators.centers import is_sparse
from cellwise.operators.means import (
    assigned_partial_sums,
    center_shift,
    center_shift_sql,
    cluster_means,
    collect_sums,
    keep_empty,
    merge_sums,
)
from cellwise.operators.nearest import CenterSearch, as_matrix
from cellwise.plans.config import FitConfig, KMeansModel, LogRow, centers_frame
from cellwise.plans.sparse_lloyd import fit_sparse
from cellwise.session import center_budget, cut_lineage


def lloyd_step(points: DataFrame, centers: np.ndarray, features: str = "features") -> tuple[np.ndarray, float]:
    """One iteration in one job; returns the new centres and the cost of the old ones."""
    k, dim = centers.shape
    partials, shared = assigned_partial_sums(points, centers, features)
    sums, counts, cost = collect_sums(merge_sums(partials), k, dim)
    shared.unpersist()
    new = centers.copy()
    filled = counts > 0
    new[filled] = sums[filled] / counts[filled, None]
    return new, cost


def lloyd_step_table(
    points: DataFrame, centers: DataFrame, dim: int, features: str = "features"
) -> tuple[DataFrame, float]:
    """One iteration for centres of any number, held as ``(cluster, center)`` rows."""
    search = CenterSearch(points.sparkSession, centers, "cluster")
    means = cut_lineage(cluster_means(search.nearest(points, features), dim, features, "idx", "d2"))
    search.release()
    new = cut_lineage(keep_empty(centers, means))
    return new, float(means.agg(F.coalesce(F.sum("cost"), F.lit(0.0))).first()[0])


def fit_centers(
    points: DataFrame,
    start: np.ndarray | DataFrame,
    config: FitConfig = FitConfig(),
    features: str = "features",
) -> KMeansModel:
    """Refine starting centres.

    Sparse centres of sparse points stay sparse (:mod:`cellwise.plans.sparse_lloyd`).
    Each iteration is one pass over ``points``; cache them (or keep them in a
    columnar file) to make passes cheap.  The result is the last set of means, and
    the loop stops once the Frobenius norm of the change is below ``tol``.
    """
    spark = points.sparkSession
    if isinstance(start, DataFrame):
        bounds = start.agg(F.count("*"), F.countDistinct("cluster"), F.min("cluster"), F.max("cluster")).first()
        rows = bounds[0]
        if rows and tuple(bounds[1:]) != (rows, 0, rows - 1):
            raise ValueError(f"clusters must be numbered from 0 to {rows - 1}, each once")
        if is_sparse(start, "center") and is_sparse(points, features):
            return fit_sparse(points, start, config, features)
        dim = len(start.select("center").first()[0]) if rows else 0
        if 8 * rows * dim <= center_budget(spark):
            start = as_matrix(
                r[0] for r in start.orderBy("cluster").select("center").collect()
            )
    elif start.nbytes > center_budget(spark):
        dim = start.shape[1]
        start = centers_frame(spark, start)
    local = isinstance(start, np.ndarray)
    centers, log, converged = start, [], False
    for number in range(1, config.max_iter + 1):
        started = time.perf_counter()
        if local:
            new, cost = lloyd_step(points, centers, features)
            shift = center_shift(centers, new)
        else:
            new, cost = lloyd_step_table(points, centers, dim, features)
            shift = center_shift_sql(centers, new)
        log.append(LogRow("lloyd", number, cost, None, None, shift, time.perf_counter() - started))
        centers = new
        if shift < config.tol:
            converged = True
            break
    return KMeansModel(centers, log, converged)

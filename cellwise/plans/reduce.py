"""Reduce weighted candidates to exactly k starting centres.

Centres are drawn one after the other, each candidate in proportion to its weight times its
squared distance to the centres so far: the one with the smallest exponential key
``-ln(1 - u) / (weight * d2)`` is such a draw.  The uniforms depend on the seed, the candidate and
the number of the draw only.  Weighted Lloyd iterations over the candidates follow.

Candidates that fit the budget of centres are handled on the driver, where they came
from; beyond it each draw and each iteration is a Spark job over the table of candidates.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cellwise.functions import kernels
from cellwise.functions.uniform import keyed_uniform
from cellwise.operators.nearest import CenterBlock, as_dense, as_matrix, update_nearest, with_nearest
from cellwise.session import center_budget, cut_lineage

REDUCE_ITERATIONS = 10


class TooFewCandidates(ValueError):
    """Seeding left fewer distinct candidates than centres are wanted."""


def _too_few(k: int, n: int) -> TooFewCandidates:
    return TooFewCandidates(
        f"k={k} centres need at least {k} distinct candidates, but seeding gave {n}; "
        "raise the oversampling factor or the number of rounds"
    )


def draw_uniform(candidate: str, draw: Column, seed: int, rng: str) -> Column:
    """The uniform of a candidate in a draw."""
    return keyed_uniform(F.concat_ws(":", F.col(candidate).cast("string"), draw.cast("string")), seed, "reduce", rng)


def reduce_candidates(
    candidates: DataFrame, k: int, seed: int = 42, rng: str = "xxhash64", max_iter: int = REDUCE_ITERATIONS
) -> np.ndarray:
    """Weighted k-means of the candidates ``(idx, center, weight)``; returns ``k x d`` in the order of the draws.

    A candidate of weight zero repeats an earlier one, so those left are distinct;
    fewer than ``k`` of them cannot give ``k`` centres.  ``idx`` must be unique.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    weighted = candidates.where(F.col("weight") > 0).select("idx", "center", "weight")
    n = weighted.count()
    if n < k:
        raise _too_few(k, n)
    dim = len(as_matrix([weighted.select("center").first()[0]])[0])
    if 8 * n * (dim + k) <= center_budget(candidates.sparkSession):
        return _reduce_collected(weighted, k, seed, rng, max_iter)
    return _reduce_table(weighted, k, seed, rng, max_iter)


def _reduce_collected(weighted: DataFrame, k: int, seed: int, rng: str, max_iter: int) -> np.ndarray:
    """All draws and iterations on the driver; the size of candidates and uniforms was checked."""
    uniforms = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: draw_uniform("idx", j, seed, rng))
    rows = weighted.select("idx", "center", "weight", uniforms.alias("u")).toArrow().sort_by("idx")
    points = kernels.densify(kernels.decode_points(rows["center"]))
    weight = rows["weight"].to_numpy()
    u = np.array(rows["u"].to_pylist())
    chosen, d2 = [], np.ones(len(points))
    for j in range(k):
        mass = weight * d2
        if not (mass > 0).any():
            raise _too_few(k, j)
        keys = np.where(mass > 0, -np.log(1.0 - u[:, j]) / np.where(mass > 0, mass, 1.0), np.inf)
        chosen.append(int(keys.argmin()))
        own, _ = kernels.nearest(points, points[chosen[-1:]])
        d2 = own if j == 0 else np.minimum(d2, own)
    centers = points[chosen]
    for _ in range(max_iter):
        _, nearest = kernels.nearest(points, centers)
        sums, total = np.zeros_like(centers), np.bincount(nearest, weight, minlength=k)
        np.add.at(sums, nearest, points * weight[:, None])
        new = np.where(total[:, None] > 0, sums / np.where(total > 0, total, 1.0)[:, None], centers)
        if (new == centers).all():
            break
        centers = new
    return centers


def _reduce_table(weighted: DataFrame, k: int, seed: int, rng: str, max_iter: int) -> np.ndarray:
    """The same over a table of candidates; only the ``k`` centres reach the driver."""
    kind = weighted.schema["center"].dataType
    dense = "center" if isinstance(kind, ArrayType) else as_dense(weighted, "center").alias("center")
    table = cut_lineage(weighted.select(F.col("idx").alias("candidate"), dense, "weight"))
    state, centers = table.withColumn("mass", F.col("weight")), []
    for j in range(k):
        key = -F.ln(F.lit(1.0) - draw_uniform("candidate", F.lit(j), seed, rng)) / F.col("mass")
        drawn = state.where("mass > 0").select("center", "candidate", key.alias("key")).orderBy("key", "candidate").first()
        if drawn is None:
            raise _too_few(k, j)
        centers.append(as_matrix([drawn["center"]]))
        block = CenterBlock(j, centers[-1])
        near = with_nearest(table, block, "center") if j == 0 else update_nearest(state.drop("mass"), block, "center")
        state = cut_lineage(near).withColumn("mass", F.col("weight") * F.col("d2"))
    found = np.vstack(centers)
    for _ in range(max_iter):
        near = with_nearest(table, CenterBlock(0, found), "center")
        parts = near.select("idx", "weight", F.posexplode("center").alias("dim", "v"))
        sums = parts.groupBy("idx", "dim").agg((F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("v")).toArrow()
        new = found.copy()
        new[sums["idx"].to_numpy(), sums["dim"].to_numpy()] = sums["v"].to_numpy()
        if (new == found).all():
            break
        found = new
    return found

"""Row sampling keyed by point id: the same rows for any partitioning."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.functions.uniform import keyed_uniform
from cellwise.operators.order_stats import values_at


def sample_fraction(
    df: DataFrame, key: str, fraction: float, seed: int, stream: int | str = 0, rng: str = "xxhash64"
) -> DataFrame:
    """Keep each row independently with the same probability."""
    return df.where(keyed_uniform(key, seed, stream, rng) < F.lit(float(fraction)))


def sample_by_probability(
    df: DataFrame,
    key: str,
    probability: Column | str,
    seed: int,
    stream: int | str = 0,
    rng: str = "xxhash64",
) -> DataFrame:
    """Keep each row independently with its own probability."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return df.where(keyed_uniform(key, seed, stream, rng) < p)


def seed_point(df: DataFrame, key: str, seed: int, rng: str = "xxhash64") -> DataFrame:
    """One row chosen uniformly (a distributed top-1, no full sort)."""
    u = keyed_uniform(key, seed, 0, rng)
    return df.withColumn("_u", u).orderBy("_u", key).limit(1).drop("_u")


def sample_exact(
    df: DataFrame, key: Column | str, n: int, seed: int, rng: str = "xxhash64"
) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, uniformly chosen.

    The sample is the ``n`` rows with the smallest keyed uniforms.  The n-th
    smallest uniform is found by counting (:func:`values_at`), after which the
    sample is a plain filter; nothing is sorted or gathered.  Only rows that share
    the boundary value exactly are ordered by ``key``, which must be unique.
    """
    if n <= 0:
        return df.limit(0)
    key = F.col(key) if isinstance(key, str) else key
    marked = df.withColumn("_u", keyed_uniform(key, seed, 0, rng))
    # the search reads eight bytes per row several times; the rows are computed once more at the end
    uniforms = marked.select("_u").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = values_at(uniforms, "_u", lambda rows: [n - 1] if rows > n else [])
        if not found:
            return df
        edge = F.lit(found[0])
        counts = uniforms.agg(
            F.count_if(F.col("_u") < edge), F.count_if(F.col("_u") == edge)
        ).first()
    finally:
        uniforms.unpersist()
    if counts[0] + counts[1] == n:
        return marked.where(F.col("_u") <= edge).select(*df.columns)
    below = marked.where(F.col("_u") < edge).select(*df.columns)
    tied = marked.where(F.col("_u") == edge).withColumn("_key", key)
    return below.unionByName(tied.orderBy("_key").limit(n - counts[0]).select(*df.columns))

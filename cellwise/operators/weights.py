"""How many points each candidate attracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nearest_frequencies(state: DataFrame, index_col: str = "idx") -> DataFrame:
    """``(idx, n)`` for candidates that attract at least one point."""
    return state.groupBy(index_col).agg(F.count(F.lit(1)).alias("n"))


def candidate_weights(candidates: DataFrame, state: DataFrame, index_col: str = "idx") -> DataFrame:
    """Add ``weight`` to every candidate; one that attracts nothing weighs 0."""
    counts = nearest_frequencies(state, index_col)
    weight = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    return candidates.join(counts, index_col, "left").select(
        *[F.col(c) for c in candidates.columns], weight.alias("weight")
    )

"""Joining many rows with a side that is expected to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.session import center_budget, cut_lineage


def join_checked(large: DataFrame, side: DataFrame, key: str, row_bytes: int) -> DataFrame:
    """Inner join that leaves ``large`` where it is when ``side`` fits the broadcast budget.

    ``side`` is written once and counted; within the budget it is broadcast, so
    that a key holding a large share of ``large`` costs nothing extra.  Beyond it
    both sides are shuffled, and adaptive execution splits skewed partitions.
    """
    written = cut_lineage(side)
    fits = written.count() * row_bytes <= center_budget(large.sparkSession)
    return large.join(F.broadcast(written) if fits else written, key)

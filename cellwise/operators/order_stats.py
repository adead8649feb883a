"""Exact order statistics in two passes, without sorting or gathering the values.

The first pass takes counts, ends and a grid of approximate quantiles from a mergeable
sketch.  The second counts every distinct value between the two marks around the
wanted rank, and what lies below; that small table is kept and read off, or searched by counting
in buckets of equal width if it is not small.  Counts of the second pass prove the bracket right; if the sketch
missed the rank, all values are counted instead.  Repeated values are merged before the shuffle.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType

from cellwise.session import cut_lineage

_BUCKETS = 1024
# Marks of the sketch, and its accuracy: ranks within n / _ACCURACY, far closer than the marks.
_MARKS = 1000
_ACCURACY = 10_000
# Distinct values around the ranks that may be collected; more of them are searched by jobs.
_COLLECTED = 50_000


def _bucket(column: str, kind: DataType, lo, hi) -> Column:
    """Bucket number that never decreases as the value grows."""
    x = F.col(column)
    if isinstance(kind, IntegralType):
        x, lo_, hi_ = x.cast("bigint"), int(lo), int(hi)
        if hi_ - lo_ >= 1 << 62:
            # halve before subtracting: the difference would overflow
            x, lo_, hi_ = F.shiftright(x, 1), lo_ >> 1, hi_ >> 1
        offset, width = (x - F.lit(lo_)).cast("double"), float(hi_ - lo_)
    else:
        x = x.cast("double")
        if float(hi) - float(lo) == float("inf"):
            x, lo, hi = x / F.lit(2.0), float(lo) / 2.0, float(hi) / 2.0
        offset, width = x - F.lit(float(lo)), float(hi) - float(lo)
    scaled = F.floor(offset / F.lit(width) * F.lit(float(_BUCKETS)))
    return F.least(scaled, F.lit(_BUCKETS - 1)).cast("int")


def _counted_value(counted: DataFrame, kind: DataType, rank: int):
    """The value at ``rank`` of a table ``(v, n)`` of distinct finite values."""
    lo, hi = counted.agg(F.min("v"), F.max("v")).first()
    while lo != hi:
        before = (lo, hi)
        parts = (
            counted.where(F.col("v").between(F.lit(lo), F.lit(hi)))
            .groupBy(_bucket("v", kind, lo, hi).alias("bucket"))
            .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        for part in sorted(parts, key=lambda r: r["bucket"]):
            if rank < part["n"]:
                lo, hi = part["lo"], part["hi"]
                break
            rank -= part["n"]
        if (lo, hi) == before and len(parts) == 1:
            raise ArithmeticError(f"values between {lo} and {hi} can't be told apart as doubles")
    return lo


def values_at(df: DataFrame, column: str, choose: Callable[[int], list[int]]) -> list:
    """The values at the ascending, close ranks that ``choose`` picks, given how many values there are.

    NULLs are left out; no ranks give an empty list after the first pass.
    """
    kind = df.schema[column].dataType
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    v, top = F.col("v"), F.lit(float("inf"))
    limited = isinstance(kind, FractionalType) and not isinstance(kind, DecimalType)
    finite = (v > -top) & (v < top) if limited else F.lit(True)
    inside = F.when(finite, v)
    marks = F.percentile_approx(inside, [i / _MARKS for i in range(_MARKS + 1)], _ACCURACY)
    seen = values.agg(
        F.count(F.lit(1)).alias("n"), F.count(inside).alias("finite"), marks.alias("marks"),
        F.count_if(v == -top if limited else F.lit(False)).alias("low"),
        F.count_if(v <= top if limited else F.lit(True)).alias("numbers"),
        F.min(inside).alias("least"), F.max(inside).alias("most"),
    ).first()
    ranks = choose(seen["n"])
    wanted = sorted({r - seen["low"] for r in ranks if 0 <= r - seen["low"] < seen["finite"]})
    found = _finite_values(values.where(finite), kind, wanted, seen) if wanted else {}

    def value(rank: int):
        if rank < seen["low"]:
            return float("-inf")
        if rank - seen["low"] in found:
            return found[rank - seen["low"]]
        return float("inf") if rank < seen["numbers"] else float("nan")

    return [value(r) for r in ranks]


def _finite_values(values: DataFrame, kind: DataType, ranks: list[int], seen) -> dict[int, object]:
    """Values at ascending ranks among finite ``values``, from one counting pass around them."""
    v, n, marks = F.col("v"), seen["finite"], seen["marks"]
    before, after = ranks[0] * _MARKS // n - 1, ranks[-1] * _MARKS // n + 2
    lo = marks[before] if before >= 0 else seen["least"]
    hi = marks[after] if after <= _MARKS else seen["most"]
    around = F.when(v >= F.lit(lo), v).alias("v")
    number = F.count(F.lit(1)).alias("n")
    counted = values.where(v <= F.lit(hi)).groupBy(around).agg(number).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = counted.agg(F.sum(F.when(v.isNull(), F.col("n"))), F.sum("n"), F.count(v)).first()
        below, upto, distinct = sums[0] or 0, sums[1] or 0, sums[2]
        if below <= ranks[0] and ranks[-1] < upto:
            kept = counted.where(v.isNotNull())
            if distinct <= _COLLECTED:
                return _listed_values(kept, [rank - below for rank in ranks], below)
            return {rank: _counted_value(kept, kind, rank - below) for rank in ranks}
    finally:
        counted.unpersist()
    counted = cut_lineage(values.groupBy("v").agg(number))  # the sketch missed the ranks
    return {rank: _counted_value(counted, kind, rank) for rank in ranks}


def _listed_values(counted: DataFrame, ranks: list[int], below: int) -> dict[int, object]:
    """:func:`_counted_value` for a table of checked size, collected once."""
    rows = sorted(counted.collect(), key=lambda r: r["v"])
    ends = list(accumulate(r["n"] for r in rows))
    return {rank + below: rows[bisect_right(ends, rank)]["v"] for rank in ranks}


def value_at_rank(df: DataFrame, column: str, rank: int):
    """The value at zero-based ``rank`` among the non-NULL values in ascending order.

    Infinities stand at the ends and NaN after them, as in Spark's order; the search is
    over the finite values only.
    """

    def choose(n: int) -> list[int]:
        if not 0 <= rank < n:
            raise ValueError(f"rank {rank} is outside 0..{n - 1}")
        return [rank]

    return values_at(df, column, choose)[0]


def median(df: DataFrame, column: str) -> float | None:
    """Exact median: the mean of the two middle values when their number is even."""
    middle = values_at(df, column, lambda n: [(n - 1) // 2, n // 2] if n else [])
    return (float(middle[0]) + float(middle[1])) / 2.0 if middle else None

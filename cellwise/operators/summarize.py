"""Summaries, histograms and rankings of counts and values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellwise.operators.order_stats import median
from cellwise.session import cut_lineage, local_frame


def counts_with_zeros(
    keys: DataFrame, entries: DataFrame, key: str, output: str
) -> DataFrame:
    """Entries per key, for every key of ``keys``; 0 where there is none."""
    counts = entries.groupBy(key).agg(F.count(F.lit(1)).alias(output))
    return keys.select(key).join(counts, key, "left").select(
        key, F.coalesce(output, F.lit(0)).cast("bigint").alias(output)
    )


def nnz_per_row(rows: DataFrame, entries: DataFrame, row_col: str = "row_id") -> DataFrame:
    """Stored entries per row, empty rows included."""
    return counts_with_zeros(rows, entries, row_col, "nnz")


def rows_per_category(categories: DataFrame, entries: DataFrame, category_col: str) -> DataFrame:
    """Rows per category, empty categories included."""
    return counts_with_zeros(categories, entries, category_col, "n")


def summary(df: DataFrame, column: str, with_mean: bool = True) -> DataFrame:
    """One row ``(n, min, max[, mean], median)``; the median is exact.

    Computed at once, so the result does not depend on ``df`` any more.
    """
    names = ["n", "min", "max"] + (["mean"] if with_mean else [])
    stats = [F.count(column), F.min(column).cast("double"), F.max(column).cast("double")]
    if with_mean:
        stats.append(F.avg(column))
    values = df.select(column).persist()
    try:
        row = values.agg(*stats).first()
        middle = median(values, column)
    finally:
        values.unpersist()
    schema = ", ".join(f"{n} {'bigint' if n == 'n' else 'double'}" for n in [*names, "median"])
    return local_frame(df.sparkSession, [(*row, middle)], schema)


def _edge(index: Column, lo: float, hi: float, bins: int) -> Column:
    step = (hi - lo) / bins
    return F.when(index == bins, F.lit(hi)).otherwise(F.lit(lo) + index * F.lit(step))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Equal-width bins over ``[min, max]``: ``(bin, lower, upper, n)``, empty ones too.

    Bins are half-open but for the last, which includes the maximum.  When all
    values are equal the range is widened by a half to both sides.  Infinity, NaN and
    a range too wide for a double are errors.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).cast("double").alias("x")).where("x is not null").persist()
    try:
        lo, hi = values.agg(F.min("x"), F.max("x")).first()
        if lo is None:
            lo, hi = 0.0, 1.0
        elif not math.isfinite(hi - lo):
            raise ValueError(f"a histogram needs a finite range, not {lo} to {hi}")
        elif lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        x = F.col("x")
        guess = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))).cast("int")
        guess = F.least(guess, F.lit(bins - 1))
        # the division may round across an edge; the edges decide
        placed = (
            F.when(x < _edge(guess, lo, hi, bins), guess - 1)
            .when((guess < bins - 1) & (x >= _edge(guess + 1, lo, hi, bins)), guess + 1)
            .otherwise(guess)
        )
        # at most one row per bin reaches the driver
        counted = values.groupBy(placed.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    finally:
        values.unpersist()
    counts = {r["bin"]: r["n"] for r in counted}
    step = (hi - lo) / bins
    edges = [lo + i * step for i in range(bins)] + [hi]
    rows = [(i, edges[i], edges[i + 1], counts.get(i, 0)) for i in range(bins)]
    return local_frame(spark, rows, "bin int, lower double, upper double, n bigint")


def integer_histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows per integer from 0 to the maximum: ``(value, n)``, empty ones too.

    The table is as long as the maximum; NULL is not counted, a negative value is an error.
    """
    value = F.col(column).cast("bigint").alias("value")
    # one short row per distinct integer, written once because it is read twice
    counts = cut_lineage(df.groupBy(value).agg(F.count(F.lit(1)).alias("n")))
    low, top = counts.agg(F.coalesce(F.min("value"), F.lit(0)), F.coalesce(F.max("value"), F.lit(-1))).first()
    if low < 0:
        raise ValueError(f"a histogram of counts can't hold {low}")
    values = df.sparkSession.range(int(top) + 1).select(F.col("id").alias("value"))
    return values.join(counts, "value", "left").select(
        "value", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def top_ranked(df: DataFrame, count_col: str, key: str, n: int = 15) -> DataFrame:
    """The ``n`` largest counts with their rank; ties go to the smaller key."""
    top = df.orderBy(F.desc(count_col), F.asc(key)).limit(n)
    # the window sees the n rows of the report only
    rank = F.row_number().over(Window.orderBy(F.desc(count_col), F.asc(key)))
    return top.select(rank.alias("rank"), key, count_col)

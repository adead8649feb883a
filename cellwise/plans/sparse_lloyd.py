"""Lloyd iterations over sparse rows, with sparse centres.

Sums are grouped by cluster and column, so a task holds only entries that occur, merges
them before the shuffle and spills beyond its memory; no task makes a table of clusters by
columns.  Centres stay a table of sparse vectors; the nearest-centre search reads them in blocks.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.operators.means import keep_empty
from cellwise.operators.nearest import CenterSearch
from cellwise.plans.config import FitConfig, KMeansModel, LogRow
from cellwise.session import cut_lineage


def sparse_vector(size: Column, entries: Column) -> Column:
    """A sparse vector from sorted ``(col_id, value)`` structs."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), size.cast("int").alias("size"),
        F.transform(entries, lambda e: e["col_id"].cast("int")).alias("indices"),
        F.transform(entries, lambda e: e["value"]).alias("values"),
    )


def sparse_means(assigned: DataFrame, features: str = "features", cluster: str = "idx", d2: str = "d2") -> DataFrame:
    """``(cluster, n, cost, center)``; a row counts and pays under column -1, next to its entries."""
    own = F.array(F.struct(F.lit(-1).alias("col_id"), F.col(d2).alias("value")))
    stored = F.arrays_zip(F.col(f"{features}.indices").alias("col_id"), F.col(f"{features}.values").alias("value"))
    rows = assigned.select(
        F.col(cluster).alias("cluster"), F.col(f"{features}.size").alias("size"),
        F.explode(F.concat(own, stored.cast("array<struct<col_id:int,value:double>>"))).alias("e"),
    )
    sums = rows.groupBy("cluster", "e.col_id").agg(F.sum("e.value").alias("value"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    entry = F.when(F.col("col_id") >= 0, F.struct("col_id", "value"))
    gathered = sums.groupBy("cluster").agg(
        F.max(F.when(F.col("col_id") < 0, F.col("n"))).alias("n"), F.max(F.when(F.col("col_id") < 0, F.col("value"))).alias("cost"),
        F.max("size").alias("size"), F.array_sort(F.collect_list(entry)).alias("entries"),
    )
    shares = F.transform("entries", lambda e: F.struct(e["col_id"].alias("col_id"), (e["value"] / F.col("n")).alias("value")))
    return gathered.select("cluster", "n", "cost", sparse_vector(F.col("size"), shares).alias("center"))


def long_centers(centers: DataFrame, value: str = "value") -> DataFrame:
    """``(cluster, col_id, value)`` of sparse centres."""
    pairs = F.arrays_zip(F.col("center.indices").alias("col_id"), F.col("center.values").alias("value"))
    return centers.select("cluster", F.inline(pairs)).select("cluster", "col_id", F.col("value").alias(value))


def sparse_shift(old: DataFrame, new: DataFrame) -> float:
    """Frobenius norm of the change over all centres and columns."""
    both = long_centers(old, "a").join(long_centers(new, "b"), ["cluster", "col_id"], "full")
    gap = F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0))
    return float(both.agg(F.sqrt(F.coalesce(F.sum(gap * gap), F.lit(0.0)))).first()[0])


def fit_sparse(points: DataFrame, start: DataFrame, config: FitConfig = FitConfig(), features: str = "features") -> KMeansModel:
    """Refine sparse starting centres ``(cluster, center)``; a cluster without points keeps its centre."""
    centers, log, converged = cut_lineage(start.select("cluster", "center")), [], False
    for number in range(1, config.max_iter + 1):
        started = time.perf_counter()
        search = CenterSearch(points.sparkSession, centers, "cluster")
        means = cut_lineage(sparse_means(search.nearest(points, features), features))
        search.release()
        new = cut_lineage(keep_empty(centers, means))
        cost = float(means.agg(F.coalesce(F.sum("cost"), F.lit(0.0))).first()[0])
        shift = sparse_shift(centers, new)
        log.append(LogRow("lloyd", number, cost, None, None, shift, time.perf_counter() - started))
        centers = new
        if shift < config.tol:
            converged = True
            break
    return KMeansModel(centers, log, converged)

"""Cluster means: partial sums inside tasks, a small shuffle, no group of points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.functions import kernels
from cellwise.session import center_budget, ship_package

PARTIAL_SCHEMA = "cluster int, segment int, n bigint, cost double, sums array<double>"
# Elements per partial-sum row; bounds the width of the rows that are shuffled.
SEGMENT = 64
# Upstream tasks whose rows meet at the first level of merging.
FAN_IN = 512
_WAVES = 8


def partial_sums(assigned: DataFrame, features: str, cluster: str, d2: str | None = None) -> DataFrame:
    """Per task and cluster: count, cost and vector sum, cut into segments."""
    ship_package(assigned.sparkSession)
    budget = center_budget(assigned.sparkSession)

    def sum_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial, dim = kernels.PartialSums(budget), None
        for batch in batches:
            if not batch.num_rows:
                continue
            points = kernels.decode_points(batch.column(0), dim)
            dim = kernels.points_dim(points)
            clusters = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            partial.add(points, clusters, batch.column(2).to_numpy(zero_copy_only=False))
            if partial.is_full():
                yield from partial.drain(min(SEGMENT, dim))
        if dim is not None:
            yield from partial.drain(min(SEGMENT, dim))

    cost = F.col(d2) if d2 else F.lit(0.0)
    columns = assigned.select(F.col(features), F.col(cluster), cost.alias("d2"))
    return columns.mapInArrow(sum_points, PARTIAL_SCHEMA)


def assigned_partial_sums(points: DataFrame, centers: np.ndarray, features: str) -> tuple[DataFrame, Broadcast]:
    """:func:`partial_sums` with the nearest-centre search in the same pass.

    For centres that fit one broadcast block: each batch of points is assigned
    and summed at once, and only sums leave the Python worker.
    """
    spark = points.sparkSession
    ship_package(spark)
    budget = center_budget(spark)
    shared = spark.sparkContext.broadcast(centers)
    segment = min(SEGMENT, centers.shape[1])

    def assign_and_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        partial = kernels.PartialSums(max(budget, 2 * matrix.nbytes))
        for batch in batches:
            if batch.num_rows:
                block = kernels.decode_points(batch.column(0), matrix.shape[1])
                d2, clusters = kernels.nearest(block, matrix)
                partial.add(block, clusters, d2)
        yield from partial.drain(segment)

    return points.select(features).mapInArrow(assign_and_sum, PARTIAL_SCHEMA), shared


def merge_sums(partials: DataFrame) -> DataFrame:
    """Merge partial sums: one row per cluster and segment.

    A hot cluster contributes one row per upstream task and segment, however many points it has.
    On clusters wide enough to run ``FAN_IN`` tasks in a few waves, rows of up to ``FAN_IN`` tasks meet
    first and what is left of them at a second level: up to ``FAN_IN`` squared tasks, a key
    gathers no more rows at the end than the square root of their number.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = kernels.MergedSums()
        for batch in batches:
            merged.add(batch)
        yield from merged.drain()

    if _WAVES * partials.sparkSession.sparkContext.defaultParallelism > FAN_IN:
        lane = F.floor(F.spark_partition_id() / FAN_IN)
        near = partials.withColumn("lane", lane).repartition("cluster", "segment", "lane").drop("lane")
        partials = near.mapInArrow(add_up, PARTIAL_SCHEMA)
    return partials.repartition("cluster", "segment").mapInArrow(add_up, PARTIAL_SCHEMA)


def cluster_means(
    assigned: DataFrame,
    dim: int,
    features: str = "features",
    cluster: str = "cluster",
    d2: str | None = None,
) -> DataFrame:
    """``(cluster, n, cost, center)`` for any number of clusters.

    A cluster's segments are gathered into one row: at most ``dim / SEGMENT``
    entries, none of them points.
    """
    segment = min(SEGMENT, dim)
    merged = merge_sums(partial_sums(assigned, features, cluster, d2))
    gathered = merged.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.sum("cost").alias("cost"),
        F.collect_list(F.struct("segment", "sums")).alias("parts"),
    )
    by_segment = F.map_from_entries("parts")
    zeros = F.array_repeat(F.lit(0.0), segment)
    whole = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit((dim - 1) // segment)),
            lambda s: F.coalesce(F.try_element_at(by_segment, s), zeros),
        )
    )
    center = F.transform(F.slice(whole, 1, dim), lambda x: x / F.col("n"))
    return gathered.select("cluster", "n", "cost", center.alias("center"))


def cluster_means_sql(assigned: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """``(cluster, dim, mean)`` by exploding vectors; the cross-check of the fast path."""
    entries = assigned.select(cluster, F.posexplode(features).alias("dim", "value"))
    return entries.groupBy(F.col(cluster).alias("cluster"), "dim").agg(F.avg("value").alias("mean"))


def collect_sums(merged: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums ``k x dim``, counts and total cost on the driver (sized like the centres)."""
    found = merged.toArrow()
    width = min(SEGMENT, dim)
    n_segments = -(-dim // width)
    cluster, segment, n, cost = (found[c].to_numpy() for c in ("cluster", "segment", "n", "cost"))
    sums = np.zeros((k, n_segments, width))
    if found.num_rows:
        sums[cluster, segment] = found["sums"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    counts = np.bincount(cluster, weights=n, minlength=k).astype(np.int64)
    return sums.reshape(k, -1)[:, :dim], counts, float(cost.sum())


def keep_empty(old: DataFrame, means: DataFrame) -> DataFrame:
    """New centres ``(cluster, center)``; a cluster without points keeps its old centre."""
    fresh = means.select("cluster", F.col("center").alias("_new"))
    return old.join(fresh, "cluster", "left").select(
        "cluster", F.coalesce("_new", "center").alias("center")
    )


def center_shift(old: np.ndarray, new: np.ndarray) -> float:
    """Frobenius norm of the change over all centres and dimensions."""
    return float(np.sqrt(((new - old) ** 2).sum()))


def center_shift_sql(old: DataFrame, new: DataFrame) -> float:
    """:func:`center_shift` for centres held in DataFrames ``(cluster, center)``."""
    both = old.join(new.select("cluster", F.col("center").alias("_new")), "cluster")
    squares = F.aggregate(
        F.zip_with("center", "_new", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
    )
    return float(both.agg(F.sqrt(F.coalesce(F.sum(squares), F.lit(0.0)))).first()[0])


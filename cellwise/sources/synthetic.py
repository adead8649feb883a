"""Isotropic Gaussian blobs around random centres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.uniform import keyed_normal, keyed_uniform


def blob_coordinate(
    key: Column, blob: Column, dim: int, seed: int, std: float, box: float, rng: str
) -> Column:
    """One coordinate: the blob's centre (uniform in the box) plus normal noise."""
    center = (keyed_uniform(blob, seed, f"center/{dim}", rng) * 2.0 - 1.0) * F.lit(box)
    return center + keyed_normal(key, seed, f"noise/{dim}", rng) * F.lit(std)


def add_blobs(
    ids: DataFrame,
    key: str,
    n_features: int = 2,
    centers: int = 4,
    seed: int = 42,
    std: float = 1.0,
    box: float = 10.0,
    rng: str = "xxhash64",
) -> DataFrame:
    """Give every id a blob label and a point of that blob: ``(key, features, label)``.

    Coordinates depend on ``(seed, key)`` alone and are computed in the JVM, so any
    number of points can be made in parallel and made again after a failure.
    """
    label = F.pmod(F.col(key), F.lit(centers)).cast("int")
    coordinates = [
        blob_coordinate(F.col(key), label, d, seed, std, box, rng) for d in range(n_features)
    ]
    return ids.select(key, F.array(*coordinates).alias("features"), label.alias("label"))


def blobs(
    spark: SparkSession, n: int = 500, n_features: int = 2, centers: int = 4, seed: int = 42,
    std: float = 1.0, partitions: int | None = None,
) -> DataFrame:
    """``n`` synthetic points ``(point_id, features, label)``."""
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return add_blobs(ids.withColumnRenamed("id", "point_id"), "point_id", n_features, centers, seed, std)

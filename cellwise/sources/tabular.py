"""Tabular inputs: reading, named subsets, fractions and the ordinal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellwise.functions.uniform import keyed_uniform
from cellwise.operators.order_stats import values_at


def load_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, file_format: str = "parquet",
    **options,
) -> DataFrame:
    """Read a table; text formats need a schema, so that no pass is spent on guessing it."""
    if schema is None and file_format in ("csv", "json"):
        raise ValueError(f"reading {file_format} needs an explicit schema")
    reader = spark.read.format(file_format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def spread_small(df: DataFrame, max_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """Deal the rows of a few small files out to all cores.

    A small file is read by one task per row group, which leaves cores idle when
    the work per row is heavy.  Its size is checked first: input over
    ``max_bytes``, or already in as many files as cores, is left as it is, since
    shuffling it would cost more than it gains.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > 4 * cores:
        return df  # plenty of tasks; do not even list the files
    files = df.inputFiles()
    if not 0 < len(files) < cores:
        return df
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    return df.repartition(cores) if size <= max_bytes else df


def load_points(
    spark: SparkSession, path: str, key: str, vector: str, *keep: str, as_double: bool = True
) -> DataFrame:
    """Read stored vectors as points ``(point_id, *keep, features)``.

    Column expressions need ``array<double>``.  The Arrow operators compute in double
    precision from ``array<float>`` as well: with ``as_double=False`` such vectors are
    cached and sent to the workers at half the size.
    """
    features = F.col(vector).cast("array<double>") if as_double else F.col(vector)
    return load_table(spark, path).select(
        F.col(key).alias("point_id"), *keep, features.alias("features")
    )


def subset_sa(
    df: DataFrame,
    abnormal: Column,
    key: str,
    anomaly_ratio: float = 0.01,
    seed: int = 42,
    rng: str = "xxhash64",
) -> DataFrame:
    """All normal rows and as many abnormal ones as make up ``anomaly_ratio`` (in expectation).

    One aggregate counts both kinds; the subset itself is a single filter.
    """
    row = df.agg(F.count_if(~abnormal), F.count_if(abnormal)).first()
    p = keep_probability(row[0], row[1], anomaly_ratio)
    return df.where(~abnormal | (keyed_uniform(key, seed, 0, rng) < F.lit(p)))


def keep_probability(n_normal: int, n_abnormal: int, anomaly_ratio: float) -> float:
    """Probability with which an abnormal row stays."""
    if not n_abnormal:
        return 0.0
    return min(1.0, anomaly_ratio / (1.0 - anomaly_ratio) * n_normal / n_abnormal)


def subset_sf(df: DataFrame, flag: Column) -> DataFrame:
    """Rows whose flag is positive."""
    return df.where(flag > 0)


def split_ordinal(df: DataFrame, key: str, n_train: int, output: str = "split") -> DataFrame:
    """Mark the first ``n_train`` rows in key order ``train``, the rest ``test``.

    The key at the boundary is found by counting in two passes over the keys, so the rows
    are not sorted.
    """
    if n_train <= 0:
        return df.withColumn(output, F.lit("test"))
    boundary = values_at(df, key, lambda rows: [n_train - 1] if rows > n_train else [])
    if not boundary:
        return df.withColumn(output, F.lit("train"))
    return df.withColumn(
        output, F.when(F.col(key) <= F.lit(boundary[0]), F.lit("train")).otherwise(F.lit("test"))
    )

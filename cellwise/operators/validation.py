"""External validation of clusters against labels: purity, NMI, ARI.

All measures come from the contingency table (clusters x labels), the only step
that touches the points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.operators.checks import require_unique


def attach_labels(assigned: DataFrame, labels: DataFrame, key: str = "point_id") -> DataFrame:
    """Join single labels to assigned points; a point with two labels is refused."""
    require_unique(labels, key)
    return assigned.join(labels, key)


def contingency(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """``(cluster, label, n)`` for the pairs that occur."""
    return df.groupBy(F.col(cluster).alias("cluster"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _margin(table: DataFrame, by: str) -> DataFrame:
    return table.groupBy(by).agg(F.sum("n").alias("m"))


def purity(table: DataFrame) -> DataFrame:
    """Share of points that carry the most frequent label of their cluster."""
    largest = table.groupBy("cluster").agg(F.max("n").alias("top"), F.sum("n").alias("size"))
    return largest.agg((F.sum("top") / F.sum("size")).alias("purity"))


def _pairs(n: Column) -> Column:
    n = n.cast("double")
    return n * (n - F.lit(1.0)) / F.lit(2.0)


def _plogp(share: Column) -> Column:
    return F.when(share > 0, share * F.ln(share)).otherwise(F.lit(0.0))


def _total(table: DataFrame) -> float:
    total = table.agg(F.sum("n")).first()[0]
    if not total:
        raise ValueError("there are no labelled points")
    return float(total)


def nmi(table: DataFrame) -> DataFrame:
    """Mutual information over the mean of both entropies; two trivial partitions give 1."""
    n = F.lit(_total(table))

    def entropy(frame: DataFrame, column: str) -> DataFrame:
        return frame.agg((-F.sum(_plogp(F.col(column) / n))).alias("h"))

    parts = (
        entropy(_margin(table, "cluster"), "m").select(F.lit("c").alias("part"), "h")
        .unionByName(entropy(_margin(table, "label"), "m").select(F.lit("l").alias("part"), "h"))
        .unionByName(entropy(table, "n").select(F.lit("j").alias("part"), "h"))
    )
    named = parts.agg(
        *[F.max(F.when(F.col("part") == p, F.col("h"))).alias(p) for p in ("c", "l", "j")]
    )
    mutual = F.greatest(F.lit(0.0), F.col("c") + F.col("l") - F.col("j"))
    mean = (F.col("c") + F.col("l")) / 2.0
    return named.select(F.when(mean > 0, mutual / mean).otherwise(F.lit(1.0)).alias("nmi"))


def ari(table: DataFrame) -> DataFrame:
    """Rand index corrected for chance; equal partitions give 1."""
    all_pairs = _pairs(F.lit(_total(table)))
    sums = (
        table.agg(F.sum(_pairs(F.col("n"))).alias("v")).select(F.lit("j").alias("part"), "v")
        .unionByName(
            _margin(table, "cluster").agg(F.sum(_pairs(F.col("m"))).alias("v"))
            .select(F.lit("c").alias("part"), "v")
        )
        .unionByName(
            _margin(table, "label").agg(F.sum(_pairs(F.col("m"))).alias("v"))
            .select(F.lit("l").alias("part"), "v")
        )
    )
    named = sums.agg(
        *[F.max(F.when(F.col("part") == p, F.col("v"))).alias(p) for p in ("j", "c", "l")]
    )
    expected = F.try_divide(F.col("c") * F.col("l"), all_pairs)
    best = (F.col("c") + F.col("l")) / 2.0
    score = F.try_divide(F.col("j") - expected, best - expected)
    return named.select(F.coalesce(score, F.lit(1.0)).alias("ari"))


def cluster_overlay(points: DataFrame, centers: DataFrame, key: str = "point_id") -> DataFrame:
    """Points and centres as one table ``(kind, id, cluster, label, features)``."""
    center_rows = centers.select(
        F.lit("center").alias("kind"),
        F.col("cluster").cast("bigint").alias("id"),
        "cluster",
        F.lit(None).cast(points.schema["label"].dataType).alias("label"),
        F.col("center").alias("features"),
    )
    point_rows = points.select(
        F.lit("point").alias("kind"), F.col(key).alias("id"), "cluster", "label", "features"
    )
    return point_rows.unionByName(center_rows)

"""Input checks for points."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validate_points(points: DataFrame, key: str = "point_id", features: str = "features") -> int:
    """Check ``array<double>`` vectors in one aggregate and return their length.

    Raises ``ValueError`` on NULL ids or vectors, NULL/NaN/infinite elements, or
    different lengths.  Clustering itself checks vectors as it reads them; this is
    for finding out before a long run.
    """
    if isinstance(points.schema[features].dataType, VectorUDT):
        raise ValueError("validate_points expects array features; ML vectors are checked when read")
    vector = F.col(features)
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    row = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(key).isNull()).alias("null_ids"),
        F.count_if(vector.isNull()).alias("null_vectors"),
        F.count_if(bad).alias("bad_vectors"),
        F.min(F.size(vector)).alias("shortest"),
        F.max(F.size(vector)).alias("longest"),
    ).first()
    if row["n"] == 0:
        raise ValueError("there are no points")
    for name in ("null_ids", "null_vectors", "bad_vectors"):
        if row[name]:
            raise ValueError(f"{row[name]} rows have {name.replace('_', ' ')}")
    if row["shortest"] != row["longest"]:
        raise ValueError(
            f"feature vectors differ in length: {row['shortest']} to {row['longest']} elements"
        )
    return int(row["longest"])


def require_unique(df: DataFrame, key: str = "point_id") -> None:
    """Raise ``ValueError`` when a key occurs twice (one shuffle of keys only)."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{key} is not unique: {repeated[0][0]!r} occurs {repeated[0][1]} times")

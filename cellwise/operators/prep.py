"""Prepare mixed tables: numeric coercion, dropping, scaling, assembling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType, StringType

from cellwise.functions.scalar import missing_as_null, to_number


def _others(df: DataFrame, keep: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keep]


def coerce_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as double; text that is no number, and other types, become NULL.

    Columns in ``keep`` (ids) pass unchanged.  The decision is made from the
    schema, since dates and nested values cannot be cast to a number.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.name in keep:
            columns.append(column)
            continue
        if isinstance(field.dataType, StringType):
            column = to_number(column)
        elif isinstance(field.dataType, (FloatType, DoubleType)):
            column = missing_as_null(column.cast("double"))
        elif isinstance(field.dataType, (NumericType, BooleanType)):
            column = column.cast("double")
        else:
            column = F.lit(None).cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns without any value; one aggregate counts all of them."""
    candidates = _others(df, keep)
    if not candidates:
        return df
    filled = df.agg(*[F.count(c).alias(c) for c in candidates]).first()
    return df.select(*[c for c in df.columns if c in keep or filled[c] > 0])


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a missing value (NULL or NaN) in any column."""
    return df.na.drop("any")


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Only columns of a numeric type, as double; chosen from the schema."""
    return df.select(
        *[
            F.col(f.name) if f.name in keep else F.col(f.name).cast("double").alias(f.name)
            for f in df.schema.fields
            if f.name in keep or isinstance(f.dataType, NumericType)
        ]
    )


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x - mean) / std`` per column with the population deviation; constant gives 0.

    One aggregate yields two numbers per column, which then sit in the projection
    as literals: no join, no second shuffle.
    """
    if not columns:
        return df
    stats = []
    for i, c in enumerate(columns):
        stats += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = df.agg(*stats).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean, std = row[f"m{i}"], row[f"s{i}"]
        if mean is None:  # no value at all: nothing to scale
            continue
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(std if std else 1.0)
    return df.withColumns(scaled)


def assemble_features(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), output: str = "features"
) -> DataFrame:
    """Columns to one ``array<double>`` in the given order."""
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*keep, vector.alias(output))


def prepare_points(df: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """Mixed table to standardised points ``(key, *keep, features)``.

    Coerce, drop empty columns, then rows with gaps, then scale and assemble.
    The order matters: a text column must go before its NULLs would drop all rows.
    """
    fixed = [key, *keep]
    numeric = drop_null_rows(drop_empty_columns(coerce_numeric(df, fixed), fixed))
    columns = _others(numeric, fixed)
    return assemble_features(standardize(numeric, columns), columns, fixed)

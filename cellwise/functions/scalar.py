"""Column expressions used across operators; all stay inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a plain number when text is coerced.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"^[+-]?(?i:inf|infinity)$"


def squared_distance(left: Column | str, right: Column | str) -> Column:
    """Squared Euclidean distance of two ``array<double>`` columns."""
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)


def squared_norm(vector: Column | str) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)


def vector_literal(values) -> Column:
    """A fixed ``array<double>`` column."""
    return F.lit([float(v) for v in values]).cast("array<double>")


def sampling_probability(d2: Column | str, oversampling: float, cost: Column | float) -> Column:
    """``min(1, d2 * l / cost)``; a cost of zero gives probability zero.

    With cost zero every point already sits on a candidate, so there is nothing
    left to sample.
    """
    d2 = F.col(d2) if isinstance(d2, str) else d2
    cost = cost if isinstance(cost, Column) else F.lit(float(cost))
    return F.coalesce(
        F.least(F.lit(1.0), F.try_divide(d2 * F.lit(float(oversampling)), cost)), F.lit(0.0)
    )


def planned_rounds_column(psi: Column | str, alpha: Column | float = 1.0) -> Column:
    """Column form of :func:`planned_rounds`."""
    psi = F.col(psi) if isinstance(psi, str) else psi
    alpha = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    rounds = F.bround(alpha * F.ln(psi), 0).cast("int")
    return F.when(psi > 0, F.greatest(F.lit(0), rounds)).otherwise(F.lit(0))


def planned_rounds(psi: float, alpha: float = 1.0) -> int:
    """Number of seeding rounds ``alpha * ln(psi)``, rounded half to even, never negative."""
    return max(0, round(alpha * math.log(psi))) if psi > 0 else 0


def to_number(column: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    text = F.trim(column)
    plain = text.rlike(NUMBER_PATTERN) | text.rlike(INFINITY_PATTERN)
    return F.when(plain, text.try_cast("double"))


def missing_as_null(column: Column) -> Column:
    """NaN means missing in numeric input, so it becomes NULL."""
    return F.when(~F.isnan(column), column)


def megabytes(n_bytes: Column | float) -> Column | float:
    """Bytes to MB with one decimal."""
    if isinstance(n_bytes, Column):
        return F.round(n_bytes / F.lit(1048576.0), 1)
    return round(n_bytes / 1048576.0, 1)

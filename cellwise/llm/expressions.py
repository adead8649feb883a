"""Helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row.

    The optimizer may put a column's expression wherever it is used, also into functions
    that run once an element; a bound variable stays one.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))

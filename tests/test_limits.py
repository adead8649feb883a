"""Values at the limits of their types, and wrong input."""

from __future__ import annotations

import math

import pytest

from cellwise import fit_centers
from cellwise.operators.order_stats import value_at_rank
from cellwise.operators.summarize import histogram, integer_histogram
from conftest import DATA, make_points


@pytest.mark.parametrize("values", [[1.0, 2.0, math.inf], [-math.inf, 0.0, 1.0, 2.0], [math.nan, 1.0, 2.0], [5e-324, 1e308, -1e308, 1e-300], [math.inf, math.inf, -math.inf]])
def test_ranks_of_any_doubles(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    for rank, want in enumerate(ordered):
        got = value_at_rank(frame, "x", rank)
        assert got == want or math.isnan(got) and math.isnan(want)


def test_histogram_refuses_infinity(spark):
    for bad in (math.inf, -math.inf, math.nan):
        with pytest.raises(ValueError, match="finite"):
            histogram(spark.createDataFrame([(1.0,), (bad,)], "x double"), "x")
    with pytest.raises(ValueError, match="can't hold"):
        integer_histogram(spark.createDataFrame([(1,), (-1,)], "x bigint"), "x")


@pytest.mark.parametrize("budget", [None, 8])
def test_start_clusters_must_be_numbered(spark, small_blocks, budget):
    if budget:
        small_blocks(budget)
    start = spark.createDataFrame([(5, [0.0, 0.0]), (9, [1.0, 1.0])], "cluster int, center array<double>")
    with pytest.raises(ValueError, match="numbered"):
        fit_centers(make_points(spark, [[0, 0], [1, 1]]), start)

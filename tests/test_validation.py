import math

import pytest

from cellwise.operators import validation


def table(spark, pairs):
    return validation.contingency(spark.createDataFrame(pairs, "cluster int, label int"))


def scores(spark, pairs):
    t = table(spark, pairs)
    return tuple(f(t).first()[0] for f in (validation.purity, validation.nmi, validation.ari))


def test_perfect_and_trivial_partitions(spark):
    perfect = [(i % 3, (i + 1) % 3) for i in range(30)]
    assert scores(spark, perfect) == pytest.approx((1.0, 1.0, 1.0))
    assert scores(spark, [(0, 0)] * 5) == (1.0, 1.0, 1.0)
    assert scores(spark, [(0, i % 2) for i in range(10)]) == pytest.approx((0.5, 0.0, 0.0))


def test_worked_example(spark):
    pairs = [(0, 0)] * 4 + [(0, 1)] * 1 + [(1, 1)] * 3 + [(1, 0)] * 2
    purity, nmi, ari = scores(spark, pairs)
    assert purity == pytest.approx(0.7)
    # entropies and pair counts by hand
    h_c = math.log(2)
    h_l = -(0.6 * math.log(0.6) + 0.4 * math.log(0.4))
    h_j = -sum(p * math.log(p) for p in (0.4, 0.1, 0.3, 0.2))
    assert nmi == pytest.approx((h_c + h_l - h_j) / ((h_c + h_l) / 2))
    joint, rows, cols, total = 6 + 0 + 3 + 1, 10 + 10, 15 + 6, 45
    expected = rows * cols / total
    assert ari == pytest.approx((joint - expected) / ((rows + cols) / 2 - expected))


def test_labels_join_once_per_point(spark):
    assigned = spark.createDataFrame([(1, 0), (2, 1)], "point_id bigint, cluster int")
    labels = spark.createDataFrame([(1, 5), (2, 6)], "point_id bigint, label int")
    assert validation.attach_labels(assigned, labels).count() == 2
    with pytest.raises(ValueError, match="not unique"):
        validation.attach_labels(assigned, labels.unionByName(labels))


def test_no_points_are_refused(spark):
    with pytest.raises(ValueError, match="no labelled points"):
        validation.nmi(table(spark, []))


def test_overlay_holds_points_and_centres(spark):
    points = spark.createDataFrame([(7, 1, 3, [1.0])], "point_id bigint, cluster int, label int, features array<double>")
    centers = spark.createDataFrame([(1, [2.0])], "cluster int, center array<double>")
    got = sorted(tuple(r) for r in validation.cluster_overlay(points, centers).collect())
    assert got == [("center", 1, 1, None, [2.0]), ("point", 7, 1, 3, [1.0])]

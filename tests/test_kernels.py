"""Kernels against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellwise.functions import kernels


def brute(points, centers):
    d2 = ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    return d2.min(axis=1), d2.argmin(axis=1)


def sparse_array(matrix):
    rows = []
    for row in matrix:
        ids = np.flatnonzero(row)
        rows.append({"type": 0, "size": len(row), "indices": ids.tolist(), "values": row[ids].tolist()})
    kind = pa.struct(
        [("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())),
         ("values", pa.list_(pa.float64()))]
    )
    return pa.array(rows, kind)


@settings(max_examples=60, deadline=None)
@given(
    seed=st.integers(0, 10_000), n=st.integers(1, 40), m=st.integers(1, 12), d=st.integers(1, 9),
    offset=st.sampled_from([0.0, 1e3, 1e7]),
)
def test_nearest_equals_brute_force_even_with_repeats(seed, n, m, d, offset):
    rng = np.random.default_rng(seed)
    # few distinct coordinates make exact ties and repeated centres common
    points = rng.integers(-2, 3, (n, d)) + offset
    centers = rng.integers(-2, 3, (m, d)) + offset
    d2, index = kernels.nearest(points.astype(float), centers.astype(float))
    want_d2, want_index = brute(points, centers)
    assert np.array_equal(index, want_index)
    assert np.array_equal(d2, want_d2)


def test_a_point_has_distance_zero_to_itself():
    points = np.random.default_rng(0).normal(size=(50, 64)) + 1e4
    d2, index = kernels.nearest(points, points)
    assert (d2 == 0).all()
    assert np.array_equal(index, np.arange(50))


def test_row_blocks_do_not_change_the_result(monkeypatch):
    rng = np.random.default_rng(1)
    points, centers = rng.normal(size=(500, 5)), rng.normal(size=(30, 5))
    whole = kernels.nearest(points, centers)
    monkeypatch.setattr(kernels, "_BLOCK_CELLS", 64)
    parts = kernels.nearest(points, centers)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


@pytest.mark.parametrize("block", [1 << 21, 50])
def test_sparse_equals_dense(monkeypatch, block):
    monkeypatch.setattr(kernels, "_BLOCK_CELLS", block)
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(60, 40)) * (rng.random((60, 40)) < 0.1)
    matrix[7] = 0.0  # a row without entries
    sparse = kernels.decode_points(sparse_array(matrix))
    assert isinstance(sparse, kernels.SparseRows)
    assert np.array_equal(sparse.to_dense(), matrix)
    centers = rng.normal(size=(9, 40))
    d2, index = kernels.nearest(sparse, centers)
    want_d2, want_index = kernels.nearest(matrix, centers)
    assert np.array_equal(index, want_index)
    np.testing.assert_allclose(d2, want_d2, rtol=1e-10, atol=1e-12)
    np.testing.assert_allclose(kernels.distances(sparse, centers), kernels.distances(matrix, centers))
    own, _ = kernels.nearest(sparse, matrix)
    assert (own == 0).all()


def test_sparse_ties_go_to_the_lowest_index():
    matrix = np.zeros((3, 6))
    matrix[:, 0] = 1.0
    # both centres share nothing with the points and have length one up to rounding
    centers = np.zeros((2, 6))
    centers[0, 1:] = 1 / np.sqrt(5)
    centers[1, 5] = 1.0
    _, index = kernels.nearest(kernels.decode_points(sparse_array(matrix)), centers)
    assert index.tolist() == [0, 0, 0]


def test_mixed_dense_and_sparse_vectors():
    rows = [
        {"type": 0, "size": 3, "indices": [1], "values": [5.0]},
        {"type": 1, "size": None, "indices": None, "values": [1.0, 2.0, 3.0]},
        {"type": 0, "size": 3, "indices": [], "values": []},
    ]
    decoded = kernels.decode_points(pa.array(rows, sparse_array(np.zeros((1, 3))).type))
    assert decoded.to_dense().tolist() == [[0, 5, 0], [1, 2, 3], [0, 0, 0]]
    only_dense = kernels.decode_points(pa.array(rows[1:2], sparse_array(np.zeros((1, 3))).type))
    assert only_dense.tolist() == [[1, 2, 3]]


def test_sliced_batches_decode_their_own_rows():
    column = pa.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]])
    assert kernels.decode_points(column.slice(1)).tolist() == [[3, 4], [5, 6]]
    matrix = np.array([[0.0, 1], [2, 0], [0, 3]])
    assert kernels.decode_points(sparse_array(matrix).slice(1)).to_dense().tolist() == [[2, 0], [0, 3]]


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([[1.0, 2.0], None], "is NULL"),
        ([[1.0, None]], "NULL element"),
        ([[1.0, 2.0], [1.0]], "differ in length"),
        ([[1.0, float("nan")]], "NaN"),
        ([[1.0, float("inf")]], "infinite"),
    ],
)
def test_bad_vectors_are_refused(rows, message):
    with pytest.raises(ValueError, match=message):
        kernels.decode_points(pa.array(rows, pa.list_(pa.float64())))


@pytest.mark.parametrize("groups", [1, 5, 32, 33, 80])
def test_group_sums_by_product_and_by_sorting(groups):
    rng = np.random.default_rng(5)
    group = np.concatenate([np.arange(groups), rng.integers(0, groups, 500)])
    points = rng.normal(size=(len(group), 7))
    got = kernels._sum_by_group(points, group, groups)
    want = np.array([points[group == g].sum(axis=0) for g in range(groups)])
    np.testing.assert_allclose(got, want, atol=1e-12)


@pytest.mark.parametrize("sparse", [False, True])
@pytest.mark.parametrize("max_bytes", [1 << 20, 1])
def test_partial_sums_merge_to_the_true_sums(sparse, max_bytes):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(200, 150)) * (rng.random((200, 150)) < 0.3)
    clusters = rng.integers(0, 7, 200)
    cost = rng.random(200)
    partial, merged = kernels.PartialSums(max_bytes), kernels.MergedSums()
    for lo in range(0, 200, 50):
        part = matrix[lo : lo + 50]
        rows = kernels.decode_points(sparse_array(part)) if sparse else part
        partial.add(rows, clusters[lo : lo + 50], cost[lo : lo + 50])
        if partial.is_full():
            for batch in partial.drain(64):
                merged.add(batch)
    for batch in partial.drain(64):
        merged.add(batch)
    (batch,) = merged.drain()
    sums, counts, total = np.zeros((7, 192)), np.zeros(7, dtype=int), 0.0
    for row in batch.to_pylist():
        lo = row["segment"] * 64
        sums[row["cluster"], lo : lo + 64] += row["sums"]
        counts[row["cluster"]] += row["n"]
        total += row["cost"]
    for c in range(7):
        np.testing.assert_allclose(sums[c, :150], matrix[clusters == c].sum(axis=0), atol=1e-12)
    assert counts.tolist() == np.bincount(clusters, minlength=7).tolist()
    assert total == pytest.approx(cost.sum())


@pytest.mark.parametrize("block", [1 << 18, 7])
def test_sparse_centres_equal_dense_ones(monkeypatch, block):
    monkeypatch.setattr(kernels, "_BLOCK_CELLS", block)
    rng = np.random.default_rng(6)
    matrix = np.where(rng.random((60, 30)) < 0.2, rng.uniform(0.1, 1, (60, 30)), 0.0)
    matrix[5] = 0.0
    points, centers = kernels._to_sparse(matrix), np.vstack([matrix[:9], matrix[3:6]])
    thin = kernels._to_sparse(centers)
    assert np.array_equal(thin.to_dense(), centers) and np.array_equal(kernels.stack([thin, centers]).to_dense(), np.vstack([centers, centers]))
    for rows in (points, matrix):
        d2, index = kernels.nearest(rows, centers)
        got, at = kernels.nearest(rows, thin)
        np.testing.assert_allclose(got, d2, atol=1e-10)
        assert np.array_equal(at, index)  # of equal ones the first
        np.testing.assert_allclose(kernels.distances(rows, thin), kernels.distances(rows, centers), atol=1e-10)
    empty = kernels._to_sparse(np.zeros((2, 30)))
    assert kernels.nearest(points, empty)[1].tolist() == [0] * 60
    assert isinstance(kernels.lean(thin), kernels.SparseRows) and isinstance(kernels.lean(kernels._to_sparse(np.ones((2, 3)))), np.ndarray)

"""NumPy kernels that run inside Spark tasks, one Arrow batch at a time.

A batch of points is either *dense* (``array<double>`` or dense ML vectors, an
``n x d`` matrix) or *sparse* (ML sparse vectors, compressed rows).  Batches are
decoded from Arrow buffers without creating a Python object per row, and a NULL,
NaN or wrong-length vector fails the task instead of skewing a result silently.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_EPS = float(np.finfo(np.float64).eps)
# Doubles per block of rows; blocks of this size stay in the processor's cache.
_BLOCK_CELLS = 1 << 18
# Up to this many clusters a product with their indicators sums faster than sorting.
_INDICATOR_CLUSTERS = 32


@dataclass
class SparseRows:
    """Rows in compressed form: row ``i`` is ``indices[indptr[i]:indptr[i+1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    dim: int

    def __len__(self) -> int:
        return len(self.indptr) - 1

    def row_ids(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.indptr))

    def slice(self, start: int, stop: int) -> "SparseRows":
        lo, hi = self.indptr[start], self.indptr[stop]
        return SparseRows(
            self.indptr[start : stop + 1] - lo, self.indices[lo:hi], self.values[lo:hi], self.dim
        )

    def take(self, rows: np.ndarray) -> "SparseRows":
        lengths = np.diff(self.indptr)[rows]
        indptr = np.r_[0, np.cumsum(lengths)]
        cells = np.arange(indptr[-1]) + np.repeat(self.indptr[rows] - indptr[:-1], lengths)
        return SparseRows(indptr, self.indices[cells], self.values[cells], self.dim)

    def sum_by_row(self, per_entry: np.ndarray) -> np.ndarray:
        """Sum entries (first axis) of each row; rows without entries give zero."""
        out = np.zeros((len(self),) + per_entry.shape[1:])
        filled = np.diff(self.indptr) > 0
        if filled.any():
            out[filled] = np.add.reduceat(per_entry, self.indptr[:-1][filled], axis=0)
        return out

    def squared_norms(self) -> np.ndarray:
        return self.sum_by_row(self.values * self.values)

    def to_dense(self) -> np.ndarray:
        dense = np.zeros((len(self), self.dim))
        dense[self.row_ids(), self.indices] = self.values
        return dense


def _flat_list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from zero) and values of an Arrow list column."""
    offsets = column.offsets.to_numpy()
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("a feature vector contains a NULL element")
    return offsets - offsets[0], flat.to_numpy(zero_copy_only=False)


def _dense_rows(column: pa.Array, dim: int | None) -> np.ndarray:
    offsets, flat = _flat_list(column)
    if dim is None:
        dim = int(offsets[1]) if len(column) else 0
    if (np.diff(offsets) != dim).any():
        raise ValueError(f"feature vectors differ in length: expected {dim} elements in every row")
    matrix = flat.astype(np.float64, copy=False).reshape(len(column), dim)
    if not np.isfinite(matrix).all():
        raise ValueError("a feature vector contains NaN or an infinite value")
    return matrix


def decode_points(column: pa.Array, dim: int | None = None) -> np.ndarray | SparseRows:
    """Decode a batch of feature vectors, checking it against ``dim`` when given."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("a feature vector is NULL")
    if not pa.types.is_struct(column.type):
        return _dense_rows(column, dim)
    dense_row = column.field("type").to_numpy(zero_copy_only=False) == 1
    if dense_row.all():
        return _dense_rows(column.field("values"), dim)
    return _sparse_rows(column, dense_row, dim)


def _sparse_rows(column: pa.StructArray, dense_row: np.ndarray, dim: int | None) -> SparseRows:
    indptr, values = _flat_list(column.field("values"))
    widths = np.diff(indptr)
    if dense_row.any():
        # a dense row stores no indices: its entries are numbered 0, 1, 2, ...
        sizes = np.where(
            dense_row, widths, column.field("size").fill_null(0).to_numpy(zero_copy_only=False)
        )
        indices = np.arange(len(values)) - np.repeat(indptr[:-1], widths)
        stored = column.field("indices").flatten().to_numpy(zero_copy_only=False)
        indices[np.repeat(~dense_row, widths)] = stored
    else:
        sizes = column.field("size").to_numpy(zero_copy_only=False)
        indices = column.field("indices").flatten().to_numpy(zero_copy_only=False)
    dim = int(sizes[0]) if dim is None else dim
    if (sizes != dim).any():
        raise ValueError(f"feature vectors differ in length: expected {dim} elements in every row")
    if not np.isfinite(values).all():
        raise ValueError("a feature vector contains NaN or an infinite value")
    return SparseRows(indptr, indices, values, dim)


def _to_sparse(matrix: np.ndarray) -> SparseRows:
    row, col = np.nonzero(matrix)
    indptr = np.r_[0, np.cumsum(np.bincount(row, minlength=len(matrix)))]
    return SparseRows(indptr, col.astype(np.int32), matrix[row, col], matrix.shape[1])


def lean(points: np.ndarray | SparseRows) -> np.ndarray | SparseRows:
    """Sparse rows as a matrix if that takes no more memory."""
    if isinstance(points, np.ndarray):
        return np.ascontiguousarray(points)
    stored = points.indices.nbytes + points.values.nbytes
    return points.to_dense() if 8 * len(points) * points.dim <= stored else points


def stack(parts: list[np.ndarray | SparseRows]) -> np.ndarray | SparseRows:
    """All rows in order; sparse if one of the parts is."""
    if all(isinstance(p, np.ndarray) for p in parts):
        return np.vstack(parts)
    whole = [_to_sparse(p) if isinstance(p, np.ndarray) else p for p in parts]
    indptr = np.r_[0, np.cumsum(np.concatenate([np.diff(p.indptr) for p in whole]))]
    return SparseRows(indptr, np.concatenate([p.indices for p in whole]), np.concatenate([p.values for p in whole]), whole[0].dim)


def points_dim(points: np.ndarray | SparseRows) -> int:
    return points.dim if isinstance(points, SparseRows) else points.shape[1]


def densify(points: np.ndarray | SparseRows) -> np.ndarray:
    return points.to_dense() if isinstance(points, SparseRows) else points


def take(points: np.ndarray | SparseRows, rows: np.ndarray) -> np.ndarray | SparseRows:
    """The rows at these positions."""
    return points.take(rows) if isinstance(points, SparseRows) else points[rows]


def squared_norms(points: np.ndarray | SparseRows) -> np.ndarray:
    return points.squared_norms() if isinstance(points, SparseRows) else np.einsum("ij,ij->i", points, points)


def _exact(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances row by row from differences (no cancellation)."""
    diff = points - centers
    return np.einsum("ij,ij->i", diff, diff)


def _nearest_dense(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre per row, equal to comparing exact distances.

    A matrix product ranks all centres fast but loses digits when vectors are
    close.  Its rounding error is bounded, so only centres within that bound of
    the best are compared again from differences; ties go to the lowest index.
    """
    m, d = centers.shape
    if m == 1:
        return _exact(points, centers[0]), np.zeros(len(points), dtype=np.int64)
    center_norms = np.einsum("ij,ij->i", centers, centers)
    point_norms = np.einsum("ij,ij->i", points, points)
    approx = center_norms - 2.0 * (points @ centers.T)
    best = approx.argmin(axis=1)
    rows = np.arange(len(points))
    slack = 16.0 * (d + 4) * _EPS * (point_norms + center_norms.max())
    close = approx <= (approx[rows, best] + slack)[:, None]
    contested = np.flatnonzero(np.count_nonzero(close, axis=1) > 1)
    d2 = _exact(points, centers[best])
    if len(contested):
        pair_row, pair_center = np.nonzero(close[contested])
        pair_d2 = np.full((len(contested), m), np.inf)
        step = max(1, _BLOCK_CELLS // max(d, 1))
        for lo in range(0, len(pair_row), step):
            r, c = pair_row[lo : lo + step], pair_center[lo : lo + step]
            pair_d2[r, c] = _exact(points[contested[r]], centers[c])
        best[contested] = pair_d2.argmin(axis=1)
        d2[contested] = pair_d2.min(axis=1)
    return d2, best


class SparseSide(NamedTuple):
    """What blocks of sparse rows need of the centres: one row a column, and squared norms."""

    columns: np.ndarray
    norms: np.ndarray


def _sparse_side(centers: np.ndarray) -> SparseSide:
    return SparseSide(np.ascontiguousarray(centers.T), np.einsum("ij,ij->i", centers, centers))


class StoredSide(NamedTuple):
    """Sparse centres by column: entries of ``columns[i]`` stand at ``starts[i]:starts[i + 1]``."""

    columns: np.ndarray
    starts: np.ndarray
    numbers: np.ndarray
    values: np.ndarray
    norms: np.ndarray


def _stored_side(centers: SparseRows) -> StoredSide:
    order = np.argsort(centers.indices, kind="stable")
    columns, starts = np.unique(centers.indices[order], return_index=True)
    return StoredSide(columns, np.r_[starts, len(order)], centers.row_ids()[order], centers.values[order], centers.squared_norms())


def _stored_products(points: SparseRows, side: StoredSide) -> np.ndarray:
    """Dot products from the entries that both have; memory is that of the stored entries."""
    n, m = len(points), len(side.norms)
    out = np.zeros(n * m)
    if len(side.columns):
        at = np.minimum(np.searchsorted(side.columns, points.indices), len(side.columns) - 1)
        met = np.flatnonzero(side.columns[at] == points.indices)
        at, row, value = at[met], points.row_ids()[met], points.values[met]
        first, lengths = side.starts[at], side.starts[at + 1] - side.starts[at]
        ends, lo = np.cumsum(lengths), 0
        while lo < len(met):
            done = ends[lo] - lengths[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, done + _BLOCK_CELLS, side="right")))
            times = lengths[lo:hi]
            cells = np.arange(ends[hi - 1] - done) + np.repeat(first[lo:hi] - (ends[lo:hi] - times - done), times)
            pair = np.repeat(row[lo:hi], times) * m + side.numbers[cells]
            out += np.bincount(pair, weights=np.repeat(value[lo:hi], times) * side.values[cells], minlength=n * m)
            lo = hi
    return out.reshape(n, m)


def _side(centers: np.ndarray | SparseRows) -> SparseSide | StoredSide:
    return _stored_side(centers) if isinstance(centers, SparseRows) else _sparse_side(centers)


def _sparse_products(points: SparseRows, side: SparseSide | StoredSide) -> np.ndarray:
    """Dot products of every sparse row with every centre."""
    if isinstance(side, StoredSide):
        return _stored_products(points, side)
    return points.sum_by_row(side.columns[points.indices] * points.values[:, None])


def _nearest_sparse(points: SparseRows, side: SparseSide | StoredSide) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre by expanding the square, touching only stored entries.

    Distances closer than the rounding error of the expansion count as equal, and
    the lowest index wins.
    """
    d2, noise = _distances_sparse(points, side)
    smallest = d2.min(axis=1)
    return smallest, (d2 <= smallest[:, None] + noise).argmax(axis=1)


def _distances_sparse(points: SparseRows, side: SparseSide | StoredSide) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances and their rounding error; below the error they are zero.

    So a point that is itself a centre has distance zero to it.  Distances are rounded to
    38 binary digits of the sum of both norms: centres without a column in common with a
    point, equally far from it, stay so in whatever block or round each is compared.
    """
    point_norms = points.squared_norms()[:, None]
    d2 = point_norms - 2.0 * _sparse_products(points, side) + side.norms
    longest = int(np.diff(points.indptr).max(initial=0))
    noise = 4.0 * (longest + 4) * _EPS * (point_norms + side.norms)
    d2[d2 < noise] = 0.0
    step = np.ldexp(1.0, np.frexp(point_norms + side.norms)[1] - 38)
    return np.rint(d2 / step) * step, noise


def _row_step(points: np.ndarray | SparseRows, m: int) -> int:
    if isinstance(points, SparseRows):
        width = max(1, len(points.values) // max(1, len(points)))
        return max(1, _BLOCK_CELLS // (m * width))
    return max(1, _BLOCK_CELLS // max(m, points.shape[1]))


def _row_blocks(points: np.ndarray | SparseRows, m: int):
    step = _row_step(points, m)
    for lo in range(0, len(points), step):
        hi = min(len(points), lo + step)
        yield lo, hi, points.slice(lo, hi) if isinstance(points, SparseRows) else points[lo:hi]


def _nearest_in_parts(points: np.ndarray, centers: SparseRows) -> tuple[np.ndarray, np.ndarray]:
    """Nearest sparse centre of dense rows; a part of the centres is made dense at a time."""
    d2, index = np.full(len(points), np.inf), np.zeros(len(points), dtype=np.int64)
    step = max(1, _BLOCK_CELLS // max(1, centers.dim))
    for first in range(0, len(centers), step):
        found, at = nearest(points, centers.slice(first, min(len(centers), first + step)).to_dense())
        closer = found < d2
        d2[closer], index[closer] = found[closer], at[closer] + first
    return d2, index


def nearest(points: np.ndarray | SparseRows, centers: np.ndarray | SparseRows) -> tuple[np.ndarray, np.ndarray]:
    """``(squared distance, index)`` of the nearest centre of every row."""
    sparse = isinstance(points, SparseRows)
    if not sparse and isinstance(centers, SparseRows):
        return _nearest_in_parts(points, centers)
    d2 = np.empty(len(points))
    index = np.empty(len(points), dtype=np.int64)
    side = _side(centers) if sparse else centers
    for lo, hi, block in _row_blocks(points, len(centers)):
        d2[lo:hi], index[lo:hi] = _nearest_sparse(block, side) if sparse else _nearest_dense(block, side)
    return d2, index


def distances(points: np.ndarray | SparseRows, centers: np.ndarray | SparseRows) -> np.ndarray:
    """Squared distances of every row to every centre, ``n x m``."""
    out = np.empty((len(points), len(centers)))
    side = _side(centers) if isinstance(points, SparseRows) else None
    for lo, hi, block in _row_blocks(points, len(centers)):
        if isinstance(block, SparseRows):
            out[lo:hi], _ = _distances_sparse(block, side)
        else:
            for j in range(len(centers)):
                out[lo:hi, j] = _exact(block, densify(take(centers, np.array([j])))[0])
    return out


def _sum_by_group(points: np.ndarray, group: np.ndarray, n_groups: int) -> np.ndarray:
    """Vector sums of groups ``0..n_groups-1``, each with at least one row."""
    if n_groups > _INDICATOR_CLUSTERS:
        order = np.argsort(group, kind="stable")
        starts = np.searchsorted(group[order], np.arange(n_groups))
        return np.add.reduceat(points[order], starts, axis=0)
    total = np.zeros((n_groups, points.shape[1]))
    for lo, hi, block in _row_blocks(points, n_groups):
        indicator = np.zeros((n_groups, hi - lo))
        indicator[group[lo:hi], np.arange(hi - lo)] = 1.0
        total += indicator @ block
    return total


def sums_batch(clusters, segments, n, cost, sums: np.ndarray) -> pa.RecordBatch:
    """Arrow rows ``(cluster, segment, n, cost, sums)``."""
    offsets = np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(clusters, pa.int32()),
            pa.array(segments, pa.int32()),
            pa.array(n, pa.int64()),
            pa.array(cost, pa.float64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums.reshape(-1))),
        ],
        names=["cluster", "segment", "n", "cost", "sums"],
    )


class MergedSums:
    """Adds up partial-sum rows that belong together; one row per (cluster, segment).

    Rows wait until they outnumber the keys seen, then all are sorted by key and added up at
    once, so the cost a row does not depend on the number of keys.
    """

    _WAITING = 4096

    def __init__(self):
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n_waiting = 0
        self.n_keys = 0

    def add(self, batch: pa.RecordBatch) -> None:
        if not batch.num_rows:
            return
        cluster, segment, n, cost = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        key = (cluster.astype(np.int64) << 32) | segment.astype(np.int64)
        self.waiting.append((key, n, cost, _dense_rows(batch.column(4), None)))
        self.n_waiting += batch.num_rows
        if self.n_waiting > max(self._WAITING, 2 * self.n_keys):
            self._fold()

    def _fold(self) -> None:
        key, n, cost, sums = (np.concatenate(part) for part in zip(*self.waiting, strict=True))
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        added = (np.add.reduceat(part[order], starts, axis=0) for part in (n, cost, sums))
        self.waiting = [(key[starts], *added)]
        self.n_waiting = self.n_keys = len(starts)

    def drain(self):
        if self.waiting:
            self._fold()
            key, n, cost, sums = self.waiting[0]
            yield sums_batch(key >> 32, key & 0xFFFFFFFF, n, cost, sums)
        self.__init__()


class PartialSums:
    """Running vector sums per cluster inside one task, bounded in memory.

    When the clusters seen so far exceed ``max_bytes`` their sums are handed
    over for merging and the accumulator starts afresh.
    """

    def __init__(self, max_bytes: int):
        self.max_bytes = max_bytes
        self.slots: dict[int, int] = {}
        self.sums = np.zeros((0, 0))
        self.counts = np.zeros(0, dtype=np.int64)
        self.costs = np.zeros(0)

    def _slot_of(self, clusters: np.ndarray, dim: int) -> np.ndarray:
        fresh = [c for c in clusters.tolist() if c not in self.slots]
        for c in fresh:
            self.slots[c] = len(self.slots)
        grow = len(self.slots) - len(self.counts)
        if grow > 0:
            # double the room so that growing costs amortised constant time
            grow = max(grow, len(self.counts))
            self.sums = np.vstack([self.sums.reshape(-1, dim), np.zeros((grow, dim))])
            self.counts = np.concatenate([self.counts, np.zeros(grow, dtype=np.int64)])
            self.costs = np.concatenate([self.costs, np.zeros(grow)])
        return np.array([self.slots[c] for c in clusters.tolist()], dtype=np.int64)

    def add(self, points: np.ndarray | SparseRows, clusters: np.ndarray, d2: np.ndarray) -> None:
        dim = points_dim(points)
        present, inverse = np.unique(clusters, return_inverse=True)
        slots = self._slot_of(present, dim)
        row_slots = slots[inverse]
        self.counts += np.bincount(row_slots, minlength=len(self.counts))
        self.costs += np.bincount(row_slots, weights=d2, minlength=len(self.costs))
        if isinstance(points, SparseRows):
            cells = np.repeat(row_slots, np.diff(points.indptr)) * dim + points.indices
            np.add.at(self.sums.reshape(-1), cells, points.values)
        else:
            self.sums[slots] += _sum_by_group(points, inverse, len(present))

    def is_full(self) -> bool:
        return self.sums.nbytes >= self.max_bytes

    def drain(self, segment: int):
        """Yield Arrow batches ``(cluster, segment, n, cost, sums)`` and reset.

        Long vectors are cut to segments of ``segment`` elements, so that merging
        handles short fixed-width rows whatever the dimension.  Count and cost
        travel with segment zero only.
        """
        if self.slots:
            dim = self.sums.shape[1]
            clusters = np.fromiter(self.slots.keys(), dtype=np.int64, count=len(self.slots))
            used = len(clusters)
            for number, lo in enumerate(range(0, dim, segment)):
                part = np.zeros((used, segment))
                width = min(segment, dim - lo)
                part[:, :width] = self.sums[:used, lo : lo + width]
                keep = np.ones(used, bool) if number == 0 else part.any(axis=1)
                if not keep.any():
                    continue
                n = self.counts[:used] if number == 0 else np.zeros(used, dtype=np.int64)
                cost = self.costs[:used] if number == 0 else np.zeros(used)
                numbers = np.full(int(keep.sum()), number, dtype=np.int32)
                yield sums_batch(clusters[keep], numbers, n[keep], cost[keep], part[keep])
        self.__init__(self.max_bytes)

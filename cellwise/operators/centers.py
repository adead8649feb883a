"""Centres as matrices, in blocks of checked size, and as an index in the shared folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StructType

from cellwise.functions import kernels
from cellwise.operators.indexing import with_consecutive_index
from cellwise.session import ensure_checkpoint_dir, ship_package

# A block is skipped only if its bound exceeds the best distance by this share of the squared
# norms, far above the rounding errors of bounds and distances.
_MARGIN = 1e-9
# What a stored entry of a sparse vector takes, and what the vector takes besides.
_ENTRY_BYTES, _VECTOR_BYTES = 12, 8
# Largest block of sparse centres: a task holds it in several orders at once.
_SPARSE_BLOCK_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class CenterBlock:
    """Centres ``first, first + 1, ...`` as the rows of ``matrix``."""

    first: int
    matrix: np.ndarray | kernels.SparseRows


def to_array(vector) -> np.ndarray:
    """One collected vector (array, ML vector, or sparse struct) as float64."""
    if hasattr(vector, "toArray"):
        return vector.toArray()
    if isinstance(vector, Row):
        dense = np.zeros(vector["size"])
        dense[list(vector["indices"])] = vector["values"]
        return dense
    return np.asarray(vector, dtype=np.float64)


def as_matrix(vectors) -> np.ndarray:
    """Stack collected vectors into a float64 matrix."""
    return np.vstack([to_array(v) for v in vectors]).astype(np.float64)


def vector_length(df: DataFrame, column: str) -> int:
    first = df.select(column).first()
    if first is None:
        raise ValueError("there are no centres")
    return len(to_array(first[0]))


def is_sparse(frame: DataFrame, column: str) -> bool:
    """Whether vectors are structs as :func:`cellwise.sources.sparse.sparse_rows` builds them."""
    kind = frame.schema[column].dataType
    return isinstance(kind, StructType) and {"size", "indices", "values"} <= set(kind.names)


def stored_bytes(entries: int, dim: int) -> int:
    """What a sparse vector of ``entries`` stored values takes, made dense if that is less."""
    return max(1, min(8 * dim, _ENTRY_BYTES * entries + _VECTOR_BYTES))


def center_size(centers: DataFrame, column: str) -> tuple[int, int]:
    """Length of the centres, and most bytes that one of them takes."""
    if not is_sparse(centers, column):
        dim = vector_length(centers, column)
        return dim, 8 * max(1, dim)
    longest, dim = centers.agg(F.max(F.size(f"{column}.values")), F.max(f"{column}.size")).first()
    if dim is None:
        raise ValueError("there are no centres")
    return dim, stored_bytes(longest, dim)


def collect_centers(centers: DataFrame, index_col: str = "idx", center_col: str = "center") -> np.ndarray | kernels.SparseRows:
    """Centres that fit the budget, in index order; sparse ones keep to their stored entries."""
    if not is_sparse(centers, center_col):
        return as_matrix(r[1] for r in sorted(centers.select(index_col, center_col).collect(), key=lambda r: r[0]))
    found = centers.select(index_col, center_col).toArrow()
    found = found.take(pc.sort_indices(found, sort_keys=[(index_col, "ascending")]))
    return kernels.lean(kernels.decode_points(found[center_col]))


def as_dense(df: DataFrame, column: str) -> Column:
    """Any kind of vector as ``array<double>``; for centres, not for wide points."""
    ship_package(df.sparkSession)

    @arrow_udf("array<double>")
    def dense_of(features: pa.Array) -> pa.Array:
        if not len(features):
            return pa.array([], pa.list_(pa.float64()))
        matrix = kernels.densify(kernels.decode_points(features))
        offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))

    return dense_of(F.col(column))


def center_blocks(
    centers: np.ndarray | DataFrame,
    max_bytes: int,
    index_col: str = "idx",
    center_col: str = "center",
) -> Iterator[CenterBlock]:
    """Yield centres in index order, at most ``max_bytes`` of float64 at a time.

    A DataFrame must number its centres ``first, first + 1, ...`` without gaps.
    """
    if isinstance(centers, np.ndarray):
        rows = max(1, max_bytes // (8 * max(1, centers.shape[1])))
        for lo in range(0, len(centers), rows):
            yield CenterBlock(lo, np.ascontiguousarray(centers[lo : lo + rows], dtype=np.float64))
        return
    # centres are read three times below; keep them so that they are computed once
    centers = centers.select(index_col, center_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        span = centers.agg(F.min(index_col), F.max(index_col), F.count(F.lit(1))).first()
        first, last, n = span[0], span[1], span[2]
        if not n:
            raise ValueError("there are no centres")
        if last - first + 1 != n:
            raise ValueError(f"centre indexes must run from {first} to {last} without gaps or repeats")
        rows = max(1, max_bytes // (8 * max(1, vector_length(centers, center_col))))
        for lo in range(first, last + 1, rows):
            part = centers.where(F.col(index_col).between(lo, min(last, lo + rows - 1)))
            found = sorted(part.collect(), key=lambda r: r[0])
            yield CenterBlock(lo, as_matrix(r[1] for r in found))
    finally:
        centers.unpersist()


def rows_per_block(max_bytes: int, dim: int) -> int:
    return max(1, max_bytes // (8 * max(1, dim)))


def numbering(centers: DataFrame, index_col: str) -> tuple[int, int]:
    """First index and number of centres; they must be numbered without gaps."""
    first, last, n = centers.agg(F.min(index_col), F.max(index_col), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("there are no centres")
    if last - first + 1 != n:
        raise ValueError(f"centre indexes must run from {first} to {last} without gaps or repeats")
    return first, n


def matrix_frame(spark: SparkSession, matrix: np.ndarray) -> DataFrame:
    """A matrix as ``(idx, center)`` rows, handed over as Arrow columns."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int64) * matrix.shape[1]
    vectors = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix, np.float64).reshape(-1)))
    return spark.createDataFrame(pa.table({"idx": pa.array(np.arange(len(matrix)), pa.int32()), "center": vectors}))


@dataclass(frozen=True)
class IndexedBlock:
    """A block of an index and the range of the norms of its centres."""

    number: int
    low: float
    high: float


@dataclass(frozen=True)
class CenterIndex:
    """Centres of any number as blocks of files that every task streams for itself.

    Only the ranges of norms, two numbers a block, travel with a plan.
    """

    path: str
    dim: int
    blocks: tuple[IndexedBlock, ...]
    sparse: bool = False

    def read(self, number: int) -> tuple[np.ndarray, np.ndarray | kernels.SparseRows]:
        """Indexes (ascending) and matrix of one block."""
        system, folder = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", self.path))
        table = pq.read_table(f"{folder}/block={number}", columns=["idx", "center"], filesystem=system, partitioning=None)
        index = table["idx"].to_numpy().astype(np.int64)
        order = np.argsort(index, kind="stable")
        if self.sparse:
            return index[order], kernels.take(kernels.decode_points(table["center"], self.dim), order)
        vectors = table["center"].combine_chunks().flatten().to_numpy().reshape(-1, self.dim)
        return index[order], vectors[order]


def build_index(
    centers: DataFrame, max_bytes: int, index_col: str = "idx", center_col: str = "center", by_norm: bool = True
) -> CenterIndex:
    """Write centres in blocks of at most ``max_bytes``, by norm or by index.

    Blocks by norm can be skipped in a search; blocks by index keep the order of the centres.
    Sparse centres are written as they are, others as rows of float64.
    """
    spark = centers.sparkSession
    sparse = is_sparse(centers, center_col)
    dim, row_bytes = center_size(centers, center_col)
    first, _ = numbering(centers, index_col)
    rows = max(1, (min(max_bytes, _SPARSE_BLOCK_BYTES) if sparse else max_bytes) // row_bytes)
    vector = F.col(center_col) if sparse else as_dense(centers, center_col)
    table = centers.select(F.col(index_col).cast("bigint").alias("idx"), vector.alias("center"))
    norm = F.sqrt(F.aggregate("center.values" if sparse else "center", F.lit(0.0), lambda s, x: s + x * x))
    table = table.withColumn("norm", norm)
    placed = with_consecutive_index(table, "norm", index_col="place") if by_norm else table.withColumn("place", F.col("idx") - first)
    path = f"{ensure_checkpoint_dir(spark)}/centers-{uuid.uuid4().hex}"
    blocked = placed.withColumn("block", F.floor(F.col("place") / rows).cast("int")).drop("place")
    blocked.repartition("block").sortWithinPartitions("block", "idx").write.partitionBy("block").parquet(path)
    ranges = spark.read.parquet(path).groupBy("block").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    found = sorted(ranges.collect(), key=lambda r: r["block"])  # one row a block
    return CenterIndex(path, dim, tuple(IndexedBlock(r["block"], r["low"], r["high"]) for r in found), sparse)


def search_blocks(
    points: np.ndarray | kernels.SparseRows,
    blocks: tuple[IndexedBlock, ...],
    read: Callable[[int], tuple[np.ndarray, np.ndarray | kernels.SparseRows]],
) -> tuple[np.ndarray, np.ndarray, int]:
    """``(squared distance, index)`` of the nearest centre of every row, and the pairs of row and centre compared.

    By the triangle inequality a point is at least as far from a block as its norm is from the
    block's range of norms.  Blocks are visited from the nearest range on; a row takes part only
    while the bound does not exclude the block, and a block that no row needs is not read.
    Of equal distances the lowest index wins, whatever the order of the blocks.
    """
    n = len(points)
    best, index, compared = np.full(n, np.inf), np.full(n, -1, dtype=np.int64), 0
    if not n:
        return best, index, compared
    square = kernels.squared_norms(points)
    norm = np.sqrt(square)
    middle = float(np.median(norm))
    for block in sorted(blocks, key=lambda b: max(b.low - middle, middle - b.high, 0.0)):
        gap = np.maximum(np.maximum(block.low - norm, norm - block.high), 0.0)
        excluded = gap * gap > best + _MARGIN * (square + block.high * block.high)
        wanted = np.flatnonzero(~excluded)
        if not len(wanted):
            continue
        numbers, matrix = read(block.number)
        d2, at = kernels.nearest(kernels.take(points, wanted), matrix)
        found, old, kept = numbers[at], best[wanted], index[wanted]
        better = (kept < 0) | (d2 < old) | ((d2 == old) & (found < kept))
        best[wanted] = np.where(better, d2, old)
        index[wanted] = np.where(better, found, kept)
        compared += len(wanted) * len(numbers)
    return best, index, compared

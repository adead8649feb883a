"""Nearest-centre operators: points stay partitioned, only centres travel.

Every operator takes centres either as a NumPy matrix or as a DataFrame
``(idx, center)``.  Centres within the session budget are broadcast; more of them
are written as an index of blocks, which the tasks stream one block at a time in a
single lazy pass over the points.  Both give the same nearest centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cellwise.functions import kernels
from cellwise.functions.scalar import sampling_probability, squared_distance, vector_literal
from cellwise.operators.centers import (
    CenterBlock,
    CenterIndex,
    as_dense,
    as_matrix,
    build_index,
    center_blocks,
    center_size,
    collect_centers,
    matrix_frame,
    numbering,
    rows_per_block,
    search_blocks,
    to_array,
)
from cellwise.session import center_budget, ship_package

NEAREST_TYPE = "struct<d2:double,idx:int>"
# Largest batch of distances that a task hands over at once.
_SLICE_BATCH_BYTES = 16 * 1024 * 1024
# Largest block of centres for slices of distances.
_SLICE_BLOCK_BYTES = 4 * 1024 * 1024


def _broadcast(spark: SparkSession, block: CenterBlock) -> Broadcast:
    ship_package(spark)
    return spark.sparkContext.broadcast((block.first, block.matrix))


def nearest_udf(shared: Broadcast):
    """Arrow UDF ``features -> (d2, idx)`` against one broadcast block."""

    @arrow_udf(NEAREST_TYPE)
    def nearest_of(features: pa.Array) -> pa.Array:
        first, matrix = shared.value
        points = kernels.decode_points(features, kernels.points_dim(matrix))
        d2, index = kernels.nearest(points, matrix)
        return pa.StructArray.from_arrays(
            [pa.array(d2), pa.array((index + first).astype(np.int32))], ["d2", "idx"]
        )

    return nearest_of


def _indexed_udf(index: CenterIndex):
    """Arrow UDF ``features -> (d2, idx)`` that streams the blocks of an index."""

    @arrow_udf(NEAREST_TYPE)
    def nearest_of(features: pa.Array) -> pa.Array:
        points = kernels.decode_points(features, index.dim)
        d2, found, _ = search_blocks(points, index.blocks, index.read)
        return pa.StructArray.from_arrays([pa.array(d2), pa.array(found.astype(np.int32))], ["d2", "idx"])

    return nearest_of


def _kept(frame: DataFrame) -> list[Column]:
    return [F.col(c) for c in frame.columns if c not in ("d2", "idx")]


def _with_found(points: DataFrame, near: Column) -> DataFrame:
    return points.withColumn("_near", near).select(*_kept(points), F.col("_near.d2"), F.col("_near.idx"))


def _with_closer(state: DataFrame, near: Column) -> DataFrame:
    closer = F.col("_near.d2") < F.col("d2")
    return state.withColumn("_near", near).select(
        *_kept(state),
        F.when(closer, F.col("_near.d2")).otherwise(F.col("d2")).alias("d2"),
        F.when(closer, F.col("_near.idx")).otherwise(F.col("idx")).alias("idx"),
    )


def with_nearest(points: DataFrame, block: CenterBlock, features: str = "features") -> DataFrame:
    """Add ``d2`` and ``idx`` of the nearest centre within one block (lazy)."""
    return _with_found(points, nearest_udf(_broadcast(points.sparkSession, block))(F.col(features)))


def update_nearest(state: DataFrame, block: CenterBlock, features: str = "features") -> DataFrame:
    """Compare each point with new centres only and keep the closer one (lazy).

    The old centre is replaced only by a strictly closer one, so on equal
    distance the lower index stays.
    """
    return _with_closer(state, nearest_udf(_broadcast(state.sparkSession, block))(F.col(features)))


class CenterSearch:
    """Centres prepared once for any number of lazy searches.

    Jobs run here, over the centres alone: they are checked, then broadcast if they fit the
    session budget and written as an index otherwise.  The searches themselves run no job, so
    they work on streams too.
    """

    def __init__(
        self, spark: SparkSession, centers: np.ndarray | DataFrame, index_col: str = "idx", center_col: str = "center"
    ):
        budget = center_budget(spark)
        self.index: CenterIndex | None = None
        self._shared: Broadcast | None = None
        ship_package(spark)
        if isinstance(centers, np.ndarray):
            if not len(centers):
                raise ValueError("there are no centres")
            if len(centers) <= rows_per_block(budget, centers.shape[1]):
                self._shared = _broadcast(spark, CenterBlock(0, np.ascontiguousarray(centers, dtype=np.float64)))
            else:
                self.index = build_index(matrix_frame(spark, centers), budget)
            return
        centers = centers.select(index_col, center_col).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first, n = numbering(centers, index_col)
            if n <= max(1, budget // center_size(centers, center_col)[1]):
                self._shared = _broadcast(spark, CenterBlock(first, collect_centers(centers, index_col, center_col)))
            else:
                self.index = build_index(centers, budget, index_col, center_col)
        finally:
            centers.unpersist()

    def column(self, features: str = "features") -> Column:
        """``struct<d2, idx>`` of the nearest centre."""
        find = nearest_udf(self._shared) if self._shared is not None else _indexed_udf(self.index)
        return find(F.col(features))

    def nearest(self, points: DataFrame, features: str = "features") -> DataFrame:
        """Add ``d2`` and ``idx`` of the nearest centre (lazy)."""
        return _with_found(points, self.column(features))

    def update(self, state: DataFrame, features: str = "features") -> DataFrame:
        """:func:`update_nearest` with all of these centres (lazy)."""
        return _with_closer(state, self.column(features))

    def release(self) -> None:
        """Free the executors' copies of broadcast centres; later searches fetch them again."""
        if self._shared is not None:
            self._shared.unpersist()


def nearest_center(
    points: DataFrame,
    centers: np.ndarray | DataFrame | CenterSearch,
    features: str = "features",
    index_col: str = "idx",
    center_col: str = "center",
) -> DataFrame:
    """Add the squared distance ``d2`` to, and index ``idx`` of, the nearest centre.

    One lazy pass over the points for any number of centres.  Prepare a :class:`CenterSearch`
    to search the same centres more than once, or to free their broadcast.
    """
    if not isinstance(centers, CenterSearch):
        centers = CenterSearch(points.sparkSession, centers, index_col, center_col)
    return centers.nearest(points, features)


def nearest_center_sql(points: DataFrame, centers: np.ndarray, features: str = "features") -> DataFrame:
    """:func:`nearest_center` as plain column expressions, for few short centres.

    Stays inside the JVM; the centres become literals of the plan, so their number is
    limited to what a plan can carry.  For more, call :func:`nearest_center`.
    """
    pairs = F.array(*[center_distance_struct(features, i, c) for i, c in enumerate(centers)])
    return points.withColumn("_near", F.array_min(pairs)).select(
        *points.columns, F.col("_near.d2"), F.col("_near.idx")
    )


def center_distance_struct(features: str, index: int, center: np.ndarray) -> Column:
    d2 = squared_distance(F.col(features), vector_literal(center))
    return F.struct(d2.alias("d2"), F.lit(index).alias("idx"))


def all_distances(
    points: DataFrame, centers: np.ndarray | DataFrame, features: str = "features", output: str = "distances"
) -> DataFrame:
    """Add the vector of squared distances to every centre, in centre order.

    One row per point: the distances stay together in a vector instead of
    becoming one row per pair.  Centres over the budget are sent in several
    blocks whose vectors are concatenated.  For more centres than a row should
    hold, take :func:`distance_slices`.
    """
    spark = points.sparkSession
    columns = []
    for block in center_blocks(centers, center_budget(spark)):
        shared = _broadcast(spark, block)
        columns.append(_distances_udf(shared)(F.col(features)))
    return points.withColumn(output, columns[0] if len(columns) == 1 else F.concat(*columns))


def _distances_udf(shared: Broadcast):
    @arrow_udf("array<double>")
    def distances_of(features: pa.Array) -> pa.Array:
        _, matrix = shared.value
        points = kernels.decode_points(features, matrix.shape[1])
        table = kernels.distances(points, matrix)
        offsets = np.arange(len(table) + 1, dtype=np.int32) * matrix.shape[0]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.reshape(-1)))

    return distances_of


def distance_slices(
    points: DataFrame, centers: np.ndarray | DataFrame, key: str = "point_id", features: str = "features"
) -> DataFrame:
    """Distances to any number of centres in slices ``(key, first, distances)``.

    ``distances[j]`` is the squared distance to the centre ``first + j``.  A slice covers one block
    of centres; rows leave a task in batches within the session budget, so that neither a row nor
    a batch grows with the number of centres.
    """
    spark = points.sparkSession
    ship_package(spark)
    budget = center_budget(spark)
    frame = matrix_frame(spark, centers) if isinstance(centers, np.ndarray) else centers
    index = build_index(frame, min(budget, _SLICE_BLOCK_BYTES), by_norm=False)
    kind = points.schema[key].dataType.simpleString()

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = kernels.decode_points(batch.column(1), index.dim)
            for block in index.blocks:
                numbers, matrix = index.read(block.number)
                width = len(numbers)
                step = max(1, min(budget, _SLICE_BATCH_BYTES) // (8 * width))
                for lo in range(0, len(whole), step):
                    rows = np.arange(lo, min(len(whole), lo + step))
                    table = kernels.distances(kernels.take(whole, rows), matrix)
                    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(lo, len(rows)),
                            pa.array(np.full(len(rows), numbers[0]), pa.int64()),
                            pa.ListArray.from_arrays(offsets, pa.array(table.reshape(-1))),
                        ],
                        names=[key, "first", "distances"],
                    )

    schema = f"`{key}` {kind}, first bigint, distances array<double>"
    return points.select(key, features).mapInArrow(slices, schema)


def min_distances(points: DataFrame, distances: str = "distances", output: str = "d2") -> DataFrame:
    """Smallest entry of a distance vector computed before."""
    return points.withColumn(output, F.array_min(distances))


def argmin_distance(points: DataFrame, distances: str = "distances", output: str = "idx") -> DataFrame:
    """Position of the smallest distance, the first one on ties."""
    position = F.array_position(F.col(distances), F.array_min(distances)) - 1
    return points.withColumn(output, position.cast("int"))


def probabilities(
    points: DataFrame,
    oversampling: float,
    centers: np.ndarray | DataFrame | None = None,
    cost: float | None = None,
    features: str = "features",
) -> DataFrame:
    """Add the sampling probability ``p = min(1, d2 * l / cost)``.

    ``d2`` is computed from ``centers`` unless the column is there already, and
    ``cost`` is its sum unless given.
    """
    if "d2" not in points.columns:
        if centers is None:
            raise ValueError("give centres, or points that carry d2")
        points = nearest_center(points, centers, features)
    cost = total_cost(points) if cost is None else cost
    return points.withColumn("p", sampling_probability("d2", oversampling, cost))


def total_cost(state: DataFrame, d2: str = "d2") -> float:
    """Sum of minimum squared distances; zero for an empty input."""
    return float(state.agg(F.coalesce(F.sum(d2), F.lit(0.0))).first()[0])


def inertia(points: DataFrame, centers: np.ndarray | DataFrame, features: str = "features") -> float:
    """Sum over all points of the squared distance to the nearest given centre."""
    return total_cost(nearest_center(points, centers, features))


def classify(
    points: DataFrame,
    centers: np.ndarray | DataFrame | CenterSearch,
    features: str = "features",
    output: str = "cluster",
) -> DataFrame:
    """Lazily add the index of the nearest centre to every point.

    A stateless projection for any number of centres, so it works on streaming DataFrames as well.
    """
    if not isinstance(centers, CenterSearch):
        centers = CenterSearch(points.sparkSession, centers)
    kept = [c for c in points.columns if c != output]
    return points.select(*kept, centers.column(features)["idx"].alias(output))

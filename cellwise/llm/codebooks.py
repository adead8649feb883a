"""Vector codes by product quantisation, with integer k-means under norm-of-sum bounds.

Vectors are cut into parts, each part has a codebook of its own, and a vector's code names
the nearest entry for each part.  A vector keeps, for each part and entry, a lower bound of
the distance and the round in which it was computed (its stamp).  The codebooks of all rounds
are kept too, so the bound is lowered by the distance between the entry then and the entry
now, its true net displacement: shorter than the way that it went round by round.  Only
entries whose lowered bound does not exceed the distance to the present entry are measured
again, exactly, in integers.  Bounds are rounded down and distances up where they are not exact.

The state of a round is a table in the shared folder; the one before is removed once it is written.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.session import center_budget, cut_lineage, ensure_checkpoint_dir, ship_package

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 28  # of an integer component; beyond, sums of squares could pass 63 bits
ROWS = 2048  # vectors that a task compares at once
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12

STATE = "bounds binary, stamps binary, steps binary, nearest binary"


@dataclass
class Codebooks:
    """``history[r]``: integers by part, entry and position after ``r`` rounds; ``measured``: distances computed by round."""

    history: list[np.ndarray]
    measured: list[int] = field(default_factory=list)

    @property
    def final(self) -> np.ndarray:
        return self.history[-1]

    def sha256(self) -> str:
        """Of all final integers by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.final.reshape(-1).tolist())).encode()).hexdigest()

    def displacements(self) -> np.ndarray:
        """How far each entry is now from where it was in each round, rounded up."""
        moved = np.stack(self.history) - self.final
        return np.sqrt((moved**2).sum(axis=-1)) * _UP


def components(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def is_whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _cut(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """Vectors by part and position."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (np.diff(column.offsets.to_numpy()) != parts * width).any():
        raise ValueError(f"vectors differ in length: expected {parts * width} components in every row")
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"a component passes {LARGEST} after scaling")
    return flat.reshape(len(column), parts, width)


def _first_state(x: np.ndarray, book: np.ndarray):
    """Distances to all entries; bounds in steps of a 255th of the largest."""
    d2 = np.stack([((x - book[:, j]) ** 2).sum(axis=-1) for j in range(book.shape[1])], axis=-1)
    far = np.sqrt(d2) * _DOWN
    steps = (far.max(axis=-1, initial=0) / 255).astype(np.float32)
    bounds = np.floor(far / np.where(steps > 0, steps, 1)[..., None].astype(np.float64))
    nearest = d2.argmin(axis=-1)
    return np.minimum(bounds, 255).astype(np.uint8), np.zeros(d2.shape, np.uint8), steps, nearest, d2.min(axis=-1), d2.size


def _next_state(x, book, displaced, now, bounds, stamps, steps, nearest):
    """The state of the next round, from that of an earlier one and the net displacements of all entries since then."""
    n, parts, entries = bounds.shape
    part = np.arange(parts)
    best2 = ((x - book[part, nearest]) ** 2).sum(axis=-1)
    lower = bounds * steps.astype(np.float64)[..., None]
    lower -= displaced[stamps, part[None, :, None], np.arange(entries)]
    again = lower <= (np.sqrt(best2) * _UP)[..., None]
    again[np.arange(n)[:, None], part, nearest] = False
    row, p, entry = np.nonzero(again)
    d2 = ((x[row, p] - book[p, entry]) ** 2).sum(axis=-1)
    everything = np.full(bounds.shape, np.iinfo(np.int64).max)
    everything[row, p, entry] = d2
    everything[np.arange(n)[:, None], part, nearest] = best2
    step = np.where(steps > 0, steps, np.inf).astype(np.float64)[row, p]
    bounds, stamps = bounds.copy(), stamps.copy()
    bounds[row, p, entry] = np.minimum(np.floor(np.sqrt(d2) * _DOWN / step), 255)
    stamps[row, p, entry] = now
    return bounds, stamps, steps, everything.argmin(axis=-1), everything.min(axis=-1), len(d2) + best2.size


def _rows(array: np.ndarray) -> pa.Array:
    """One binary value a vector."""
    flat = np.ascontiguousarray(array).reshape(len(array), -1).view(np.uint8)
    return pa.array([r.tobytes() for r in flat], pa.binary())


def _matrix(column: pa.Array, kind, shape) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), kind).reshape(len(column), *shape)


def _assigned(output, shared, batches):
    """Batches of at most ``ROWS`` vectors with their next state, as ``output(batch, state)``."""
    books, displaced = shared.value
    parts, entries, width = books.final.shape
    for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
        x = _cut(batch.column("x"), parts, width)
        if "bounds" not in batch.schema.names:
            state = _first_state(x, books.final)
        else:
            held = [_matrix(batch.column(c), k, s) for c, k, s in (("bounds", np.uint8, (parts, entries)), ("stamps", np.uint8, (parts, entries)), ("steps", np.float32, (parts,)), ("nearest", np.uint8, (parts,)))]
            state = _next_state(x, books.final, displaced, len(books.history) - 1, *held)
        yield output(batch, state)


def _state_batch(batch, state):
    bounds, stamps, steps, nearest, _, _ = state
    kept = [batch.column("id"), batch.column("label"), batch.column("x").cast(pa.list_(pa.int32()))]
    return pa.record_batch([*kept, _rows(bounds), _rows(stamps), _rows(steps), _rows(nearest.astype(np.uint8))], names=["id", "label", "x", "bounds", "stamps", "steps", "nearest"])


def _code_batch(batch, state):
    nearest, d2 = state[3], state[4]
    codes = pa.array([r.tobytes().hex() for r in nearest.astype(np.uint8)], pa.string())
    return pa.record_batch([batch.column("id"), batch.column("label"), codes, pa.array(d2.sum(axis=1), pa.int64())], names=["id", "label", "code", "error"])


def _sums(shape, now, batches):
    """Sums and numbers of the parts of each entry and the distances measured, one row a task."""
    parts, entries, width = shape
    total, count, measured = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64), 0
    for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
        x = _cut(batch.column("x"), parts, width)
        cell = _matrix(batch.column("nearest"), np.uint8, (parts,)) + np.arange(parts) * entries
        np.add.at(total, cell, x)
        count += np.bincount(cell.reshape(-1), minlength=len(count))
        measured += sum(int((np.frombuffer(s.as_buffer(), np.uint8) == now).sum()) for s in batch.column("stamps"))
    yield pa.record_batch({"v": pa.array([np.concatenate([total.reshape(-1), count, [measured]])], pa.list_(pa.int64()))})


def _moved(book: np.ndarray, state: DataFrame, now: int) -> tuple[np.ndarray, int]:
    """The codebooks after a round, and the distances measured in it; the driver gets one number a component."""
    sums = state.select("x", "nearest", "stamps").mapInArrow(partial(_sums, book.shape, now), "v array<bigint>")
    rows = sums.select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    values = np.zeros(book.size + book.shape[0] * book.shape[1] + 1, np.int64)
    values[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
    total, count = values[: book.size].reshape(book.shape), values[book.size : -1].reshape(book.shape[:2])
    used = count > 0
    new = book.copy()
    new[used] = total[used] // count[used][:, None]
    return new, int(values[-1])


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _first_books(clean: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The first vectors by id, null last and equal ids by their components, as entries."""
    first = clean.orderBy(F.asc_nulls_last("id"), "x").limit(entries).select("x").collect()
    if not first:
        return None
    lengths = {len(r[0]) for r in first}
    if len(lengths) > 1 or min(lengths) % parts:
        raise ValueError(f"vectors must have one length, divisible by {parts}")
    matrix = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, -1)
    return Codebooks([np.ascontiguousarray(matrix.transpose(1, 0, 2))])


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """``id, label, code, error`` of each whole vector, and the codebooks.

    ``code``: two hex digits a part; ``error``: squared distances summed over the parts.
    Vectors that are null or hold a null or non-finite component are left out.  Equal
    distances go to the lower entry; an entry without parts stays; fewer vectors than
    ``entries`` make fewer entries.  Null ids come last, repeated rows count each.  Vectors
    of other lengths than the first, and components beyond ``LARGEST`` after scaling, are an error.
    No whole vector: no rows and no codebooks.
    """
    if not 0 < entries <= 256 or not 0 <= rounds < 256:
        raise ValueError("entries and rounds must fit a byte")
    spark = vectors.sparkSession
    ship_package(spark)
    whole = vectors.where(is_whole(F.col(vector_col)))
    clean = whole.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), components(F.col(vector_col), scale).alias("x"))
    books = _first_books(clean, parts, entries)
    kept = ", ".join(f"{c} {clean.schema[c].dataType.simpleString()}" for c in ("id", "label"))
    if books is None:
        return spark.createDataFrame([], f"{kept}, code string, error bigint"), None
    state, path = clean, None
    for now in range(rounds):
        shared = spark.sparkContext.broadcast((books, books.displacements()))
        old, path = path, f"{ensure_checkpoint_dir(spark)}/codes-{uuid.uuid4().hex}"
        following = state.mapInArrow(partial(_assigned, _state_batch, shared), f"{kept}, x array<int>, {STATE}")
        following.write.option("compression", "zstd").parquet(path)
        if old:
            _remove(spark, old)
        state = spark.read.parquet(path)
        book, measured = _moved(books.final, state, now)
        books = Codebooks([*books.history, book], [*books.measured, measured])
        shared.unpersist()
    shared = spark.sparkContext.broadcast((books, books.displacements()))
    codes = cut_lineage(state.mapInArrow(partial(_assigned, _code_batch, shared), f"{kept}, code string, error bigint"))
    if path:
        _remove(spark, path)
    return codes, books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Add ``label_error``, the errors of all rows of a label summed; rows of a null label go together."""
    sums = cut_lineage(codes.groupBy(F.col("label").alias("_l")).agg(F.sum("error").alias("label_error")))
    width = sums.agg(F.sum(F.lit(64) + F.coalesce(F.octet_length(F.col("_l").cast("string")), F.lit(0)))).first()[0] or 0
    if width <= center_budget(codes.sparkSession):
        sums = F.broadcast(sums)
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_l"))).drop("_l")

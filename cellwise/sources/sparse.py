"""Sparse matrices: term weights of documents, label matrices, storage.

Long form ``(row_id, col_id, value)`` serves statistics; one sparse vector per row
serves clustering.  Rows without entries exist only in the list of rows.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.operators.indexing import with_consecutive_index
from cellwise.sources.profile import PROFILE_SCHEMA, dataset_profile, megabytes_at, write_dictionaries
from cellwise.session import center_budget, cut_lineage, ship_package

# Fixed value: what separates terms.
TERM_SEPARATOR = r"[^\p{L}\p{N}]+"
# What a row of a broadcast vocabulary takes besides its term.
_ROW_BYTES = 64
# A document frequency as it is sent to all tasks: hash of the term and frequency.
_KEY_BYTES = 16
# Text that a task of the term matrix takes on the average, and rows of it that are counted at once.
_TASK_BYTES = 32 * 1024 * 1024
_COUNTED_ROWS = 1000


def _terms(documents: DataFrame, text: str, *keep: Column) -> DataFrame:
    """One row per occurrence: ``(*keep, term)``."""
    raw = F.explode(F.split(F.col(text), TERM_SEPARATOR)).alias("raw")
    return documents.select(*keep, raw).where("raw <> ''").withColumn("term", F.lower("raw")).drop("raw")


def vocabulary(documents: DataFrame, text: str = "text") -> DataFrame:
    """Distinct terms, also those that occur everywhere and so carry no weight."""
    return _terms(documents, text).distinct()


def term_counts(documents: DataFrame, row: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row_id, term, tf)`` over whole texts.

    A row's terms sit in one task, so the map-side combine already merges repeats
    and the shuffle carries distinct pairs only.
    """
    occurrences = _terms(documents, text, F.col(row).alias("row_id"))
    return occurrences.groupBy("row_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def _rows_with_term(documents: DataFrame, text: str) -> DataFrame:
    """``(term, df)``: texts that contain each term, from one scan and one shuffle of terms."""
    distinct = F.array_distinct(F.transform(F.split(F.col(text), TERM_SEPARATOR), F.lower))
    return documents.select(F.explode(distinct).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("df"))


def rows_per_term(documents: DataFrame, text: str = "text", n_rows: int | None = None) -> DataFrame:
    """``(term, n)``: rows of :func:`term_matrix` with an entry for each term of the vocabulary.

    A term has an entry in every text that contains it, or in none if all do, so the matrix
    is not needed.  One text a row.
    """
    n_rows = documents.count() if n_rows is None else n_rows
    counts = _rows_with_term(documents, text)
    return counts.select("term", F.when(F.col("df") < n_rows, F.col("df")).otherwise(0).cast("bigint").alias("n"))


def _lowered(text: str) -> Column:
    """The terms of a text in order, empty ones between them."""
    return F.transform(F.split(F.col(text), TERM_SEPARATOR), F.lower)


def _least_power(sizes: dict[int, int], room: int) -> int:
    """The least power such that it and all greater ones fit into ``room`` bytes together."""
    least = max(sizes, default=0) + 1
    for p in sorted(sizes, reverse=True):
        if sizes[p] > room:
            break
        room, least = room - sizes[p], p
    return least


def _key(term: Column) -> Column:
    """The number that stands for a term; :func:`_keys` gives the same one."""
    return F.xxhash64(term)


def _keys(terms: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, 42) for t in terms.cast(pa.large_binary()).to_pylist()], np.uint64).view(np.int64)


def _common_terms(df: DataFrame) -> tuple[Broadcast, DataFrame | None]:
    """Frequencies that go to all tasks, and those of the rarer terms that repeat, if any, as ``(rare, df)``.

    Terms stand as their keys: the greatest frequencies as far as the budget allows, cut at a power
    of two, so that the driver sees one row a power besides them.  Terms that share a key,
    hardly ever any, go to all tasks as they are.
    """
    spark = df.sparkSession
    keyed = df.select(_key(F.col("term")).alias("key"), "df")
    shared = [r[0] for r in keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key").collect()]
    alike = df.where(_key(F.col("term")).isin(shared)).toArrow() if shared else pa.table({"term": pa.array([], pa.string()), "df": pa.array([], pa.int64())})
    repeated = keyed.where("df > 1")
    if shared:
        repeated = repeated.where(~F.col("key").isin(shared))
    power = F.length(F.bin("df"))
    sizes = {r[0]: r[1] * _KEY_BYTES for r in repeated.groupBy(power.alias("power")).count().collect()}
    least = _least_power(sizes, center_budget(spark))
    found = repeated.where(power >= least).toArrow()
    common = _Frequencies(found["key"].to_numpy(), found["df"].to_numpy(), alike["term"].combine_chunks().cast(pa.large_string()), alike["df"].to_numpy())
    rarer = repeated.where(power < least).withColumnRenamed("key", "rare") if any(p < least for p in sizes) else None
    return spark.sparkContext.broadcast(common), rarer


class _Frequencies:
    """Document frequencies by key; of terms that share a key, by term."""

    def __init__(self, key: np.ndarray, df: np.ndarray, alike: pa.Array | None = None, alike_df: np.ndarray | None = None):
        order = np.argsort(key)
        self.key, self.alike, self.alike_df = key[order], alike, alike_df
        self.df = df[order].astype(np.min_scalar_type(df.max(initial=0)))  # each task has a copy

    def look_up(self, terms: pa.Array, keys: np.ndarray, df: np.ndarray) -> np.ndarray:
        """Put the frequencies of known terms into ``df``; whether each is known."""
        known = np.zeros(len(keys), bool)
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
            known = self.key[at] == keys
            df[known] = self.df[at[known]]
        if self.alike is not None and len(self.alike):
            at = pc.index_in(terms, value_set=self.alike)
            found = at.is_valid().to_numpy(zero_copy_only=False)
            df[found] = self.alike_df[at.drop_null().to_numpy(zero_copy_only=False)]
            known |= found
        return known


def _uncommon(common: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(row_id, rare)``: keys of the terms of texts that are not among the common ones, once a batch and row."""
    for batch in batches:
        for at in range(0, batch.num_rows, _COUNTED_ROWS):
            part = batch.slice(at, _COUNTED_ROWS)
            row, terms, code, _ = _counted(part.column(1), np.arange(part.num_rows))
            keys = _keys(terms)
            kept = ~common.value.look_up(terms, keys, np.ones(len(terms), np.int64))[code]
            yield pa.record_batch({"row_id": part.column(0).take(pa.array(row[kept])), "rare": keys[code[kept]]})


def _counted(lists: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Rows, distinct terms, and numbers of terms with counts: one triple for a term of a row, by row; empty terms are left out."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    encoded = pc.dictionary_encode(lists.flatten().cast(pa.large_string()))
    terms, codes = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)
    width = len(terms) + 1
    key, counts = np.unique(np.repeat(rows, lengths) * width + codes, return_counts=True)
    row, code = key // width, key % width
    filled = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)
    kept = filled[code] if len(code) else np.zeros(0, bool)
    return row[kept], terms, code[kept], counts[kept]


class _Pending:
    """Texts of a stream sorted by row: counts of its terms, and frequencies of the rarer ones.

    The last row of a part waits, since the next part may go on with it.
    """

    def __init__(self, kind: pa.DataType):
        text = pa.large_string()
        self.row, self.held = pa.array([], kind), (pa.array([], text), np.zeros(0, np.int64))
        self.rare = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, part: pa.RecordBatch) -> tuple:
        """Rows before the last one: ids, row numbers, terms, their numbers, counts, and keys of rare terms with frequencies."""
        ids = pa.concat_arrays([self.row, part.column("row_id")])
        first = len(self.row)
        codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        number = np.cumsum(np.r_[0, codes[1:] != codes[:-1]])  # sorted by row, so equal ones stand together
        row, terms, code, tf = _counted(part.column("terms"), number[first:])
        held, n = self.held
        if len(held):
            place = pc.index_in(held, value_set=terms)
            fresh = pc.is_null(place).to_numpy(zero_copy_only=False)
            own = place.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            own[fresh] = len(terms) + np.arange(np.count_nonzero(fresh))
            terms = pa.concat_arrays([terms, held.filter(pa.array(fresh))])
            width = len(terms) + 1
            key, at = np.unique(np.r_[np.zeros(len(own), np.int64), row] * width + np.r_[own, code], return_inverse=True)
            tf = np.bincount(at, weights=np.r_[n, tf], minlength=len(key)).astype(np.int64)
            row, code = key // width, key % width
        known = pc.is_valid(part.column("rare")).to_numpy(zero_copy_only=False)
        rare, df = (np.r_[old, part.column(c).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)] for old, c in zip(self.rare, ("rare", "df"), strict=True))
        whole, last = row < number[-1], number[-1]
        waiting = np.r_[np.full(len(self.rare[0]), last == 0), number[first:][known] == last]
        self.row, self.held = ids.slice(len(ids) - 1), (terms.take(pa.array(code[~whole])), tf[~whole])
        self.rare = (rare[waiting], df[waiting])
        starts = pa.array(np.flatnonzero(np.r_[True, number[1:] != number[:-1]]))
        return ids.take(starts), row[whole], terms, code[whole], tf[whole], (rare, df)

    def last(self) -> tuple:
        terms, tf = self.held
        return self.row, np.zeros(len(tf), np.int64), terms, np.arange(len(tf)), tf, self.rare


def _weighted(common: Broadcast, n_rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(row_id, term, value)`` of texts sorted by row, between them rows with the frequencies of rarer terms."""
    def entries(ids, row, terms, code, tf, rare):
        df = np.ones(len(terms), np.int64)  # a term without frequency stands in one text
        keys = _keys(terms)
        for known in (_Frequencies(*rare), common.value):
            known.look_up(terms, keys, df)
        w = (1.0 + np.log(tf)) * np.log(float(n_rows) / df[code])
        positive = w > 0
        row, code, w = row[positive], code[positive], w[positive]
        if len(w):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            norm = np.sqrt(np.add.reduceat(w * w, starts))
            w = w / np.repeat(norm, np.diff(np.r_[starts, len(w)]))
        return pa.record_batch({"row_id": ids.take(pa.array(row)), "term": terms.take(pa.array(code)).cast(pa.string()), "value": pa.array(w)})

    pending = None
    for batch in batches:
        pending = pending or _Pending(batch.column("row_id").type)
        for at in range(0, batch.num_rows, _COUNTED_ROWS):
            yield entries(*pending.add(batch.slice(at, _COUNTED_ROWS)))
    if pending is not None and len(pending.row):
        yield entries(*pending.last())


def term_matrix(
    documents: DataFrame, row: str = "doc_id", text: str = "text", n_rows: int | None = None
) -> DataFrame:
    """Cosine-normalised log TF-IDF ``(row_id, term, value)`` with ``value > 0``.

    Weight ``(1 + ln tf) * ln(N / df)``, each row scaled to length one; texts of one row are joined.  The
    document frequencies are written first, and those of the most common terms sent to all tasks
    as far as the budget allows.  Rarer terms that repeat are joined by term, and what is found goes to
    the row.  Then texts and these frequencies are dealt by row and sorted: a task counts and
    weighs one part of its texts after the other, so its memory doesn't grow with the input.
    """
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.select(F.col(row).alias("row_id"), F.col(text).alias("text"))
    n_rows = documents.count() if n_rows is None else n_rows
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    df = cut_lineage(_rows_with_term(documents, text))
    common, rarer = _common_terms(df)
    kind = rows.schema["row_id"].dataType
    none = F.lit(None).cast("bigint")
    dealt = rows.select("row_id", "text", none.alias("rare"), none.alias("df"))
    if rarer is not None:
        split = rows.select("row_id", _lowered("text").alias("terms"))
        pairs = split.mapInArrow(partial(_uncommon, common), f"row_id {kind.simpleString()}, rare bigint")
        found = pairs.join(rarer.hint("merge"), "rare")
        dealt = dealt.unionByName(found.select("row_id", F.lit(None).cast("string").alias("text"), "rare", "df"))
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(size / _TASK_BYTES))
    ordered = dealt.repartition(parts, "row_id").sortWithinPartitions("row_id")
    split = ordered.select("row_id", _lowered("text").alias("terms"), "rare", "df")
    return split.mapInArrow(partial(_weighted, common, n_rows), f"row_id {kind.simpleString()}, term string, value double")


def index_columns(entries: DataFrame, column: str = "term") -> DataFrame:
    """Dictionary ``(term, col_id)``, numbered from 0 in term order."""
    return with_consecutive_index(entries.select(column).distinct(), column, 0, "col_id").select(
        column, F.col("col_id").cast("int").alias("col_id")
    )


def with_column_ids(entries: DataFrame, dictionary: DataFrame, column: str = "term") -> DataFrame:
    """Long form ``(row_id, col_id, value)`` from entries keyed by term; ``entries`` are read up to three times.

    A dictionary within the budget is sent to all tasks.  Of a larger one, the columns with the most
    entries are, so that only entries of rarer columns are dealt by column.
    """
    size = F.sum(F.octet_length(F.col(column).cast("string")) + F.lit(_ROW_BYTES))
    room, whole = center_budget(entries.sparkSession), dictionary.agg(F.coalesce(size, F.lit(0))).first()[0]
    if whole <= room:
        return entries.join(F.broadcast(dictionary), column).select("row_id", "col_id", "value")
    counted = cut_lineage(dictionary.join(entries.groupBy(column).agg(F.count(F.lit(1)).alias("n")), column))
    power = F.length(F.bin("n"))
    least = _least_power({r[0]: r[1] for r in counted.groupBy(power).agg(size).collect()}, room)
    common = F.broadcast(counted.where(power >= least).select(column, "col_id"))
    rarer = counted.where(power < least).select(column, "col_id")
    known = entries.join(common, column)
    # both joins read all columns of the common ones, so that they share one broadcast
    others = entries.join(common, column, "left").where("col_id is null").drop("col_id").join(rarer.hint("merge"), column)
    return known.select("row_id", "col_id", "value").unionByName(others.select("row_id", "col_id", "value"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of a row that follow each other as one row of arrays."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = pc.dictionary_encode(batch.column(0), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        offsets = pa.array(np.r_[starts, len(codes)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, batch.column(i)) for i in (1, 2)]
        yield pa.record_batch({"row_id": batch.column(0).take(pa.array(starts)), "cols": lists[0], "vals": lists[1]})


def sparse_rows(rows: DataFrame, entries: DataFrame, n_features: int) -> DataFrame:
    """One sparse vector per row ``(row_id, features)``; rows without entries are zero.

    ``features`` is a struct laid out like an ML sparse vector.  Entries of a row that stand
    together are put together before they are dealt by row.  A row gathers its own entries, at most
    ``n_features`` of them.
    """
    ship_package(entries.sparkSession)
    entries = entries.select("row_id", "col_id", "value")
    kind, col, value = (f.dataType.simpleString() for f in entries.schema)
    runs = entries.mapInArrow(_runs, f"row_id {kind}, cols array<{col}>, vals array<{value}>")
    parts = F.collect_list(F.struct("cols", "vals"))
    pairs = F.arrays_zip(F.flatten(parts["cols"]).alias("col_id"), F.flatten(parts["vals"]).alias("value"))
    gathered = runs.groupBy("row_id").agg(F.array_sort(pairs).alias("e"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(n_features).alias("size"),
        F.coalesce(F.col("e.col_id"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("e.value"), F.array().cast("array<double>")).alias("values"),
    )
    return rows.select("row_id").join(gathered, "row_id", "left").select(
        "row_id", vector.alias("features")
    )


def label_entries(labels: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """Multilabel matrix ``(row_id, category_id)`` from 0/1 columns, one row per set cell."""
    cells = F.array(
        *[F.struct(F.lit(i).alias("category_id"), F.col(c).alias("set")) for i, c in enumerate(columns)]
    )
    return (
        labels.select(F.col(row).alias("row_id"), F.inline(cells))
        .where("set <> 0")
        .select("row_id", "category_id")
    )


def write_sparse(entries: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store a matrix in long form, sorted by row within files so row ranges can be skipped."""
    entries.sortWithinPartitions("row_id").write.mode(mode).parquet(path)


def load_sparse(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_libsvm(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """Rows ``(label, features)`` from libsvm text; the width is given, not guessed."""
    return spark.read.format("libsvm").option("numFeatures", str(n_features)).load(path)


def _stored_profile(spark: SparkSession, x_path: str, y_path: str, profile_path: str) -> DataFrame | None:
    try:
        spark.read.parquet(x_path)
        spark.read.parquet(y_path)
        stored = spark.read.schema(PROFILE_SCHEMA).json(profile_path)
        return stored if stored.head(1) else None
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def ingest_sparse(
    x: DataFrame,
    y: DataFrame,
    out_dir: str,
    n_samples: int,
    n_features: int,
    n_categories: int,
    force: bool = False,
    keys: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Write both matrices, their dictionaries and their profile once; return the profile.

    ``keys`` may declare all ``rows``, ``columns`` and ``categories``, for
    :func:`cellwise.sources.profile.verification` to compare with.

    When everything is there already, the stored profile is returned and nothing
    is computed, unless ``force``.  An old profile is emptied first and the new one
    written last, so a run that died half-way is recognised and repeated.  Reading the source and writing are
    one job, hence ``download_time_s`` is zero and ``save_time_s`` covers both.
    """
    spark = x.sparkSession
    x_path, y_path = f"{out_dir}/x", f"{out_dir}/y"
    profile_path = f"{out_dir}/profile"
    stored = None if force else _stored_profile(spark, x_path, y_path, profile_path)
    if stored is not None:
        return stored
    spark.createDataFrame([], PROFILE_SCHEMA).write.mode("overwrite").json(profile_path)
    started = time.perf_counter()
    write_sparse(x, x_path, "overwrite")
    write_sparse(y, y_path, "overwrite")
    saved = time.perf_counter()
    stored_x, stored_y = load_sparse(spark, x_path), load_sparse(spark, y_path)
    write_dictionaries(stored_x, stored_y, out_dir, keys or {})
    counts = dataset_profile(
        stored_x, stored_y, n_samples, n_features, n_categories
    )
    profile = counts.select(
        "n_samples", "n_features", "n_categories", "x_nnz", "y_nnz",
        F.lit(x_path).alias("x_path"),
        F.lit(y_path).alias("y_path"),
        F.lit(megabytes_at(spark, x_path)).alias("x_size_mb"),
        F.lit(megabytes_at(spark, y_path)).alias("y_size_mb"),
        F.lit(0.0).alias("download_time_s"),
        F.lit(round(saved - started, 1)).alias("save_time_s"),
    )
    profile.coalesce(1).write.mode("overwrite").json(profile_path)
    return spark.read.schema(PROFILE_SCHEMA).json(profile_path)

"""Matrices as bucketed tables: counted and joined by row without a shuffle, pruned to the buckets of given rows.

A matrix in long form is dealt by the hash of its row once, when it is written.  Tables with equal
bucket counts then join and group by row in place, and a filter on row ids reads only the
buckets that can hold them; within a bucket rows are sorted, so file statistics skip the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.session import ensure_checkpoint_dir


def write_bucketed(
    entries: DataFrame, table: str, buckets: int | None = None, key: str = "row_id",
    path: str | None = None, mode: str = "errorifexists", dealt: bool = False,
) -> DataFrame:
    """Store ``entries`` as a catalogue table in ``buckets`` buckets by ``key``, and return it.

    ``buckets`` defaults to the shuffle partitions of the session; tables that are to be joined in
    place need equal numbers.  Each bucket is written by one task as one file.  ``path`` puts the files
    outside the warehouse; ``dealt`` rows already lie in ``buckets`` partitions by ``key``.  A null key has a bucket like any other value; an empty table has no files.
    """
    if buckets is None:
        buckets = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if buckets < 1:
        raise ValueError("a bucketed table needs at least one bucket")
    rows = entries if dealt else entries.repartition(buckets, key)
    writer = rows.write.bucketBy(buckets, key).sortBy(key).mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return entries.sparkSession.table(table)


def rows_of(matrix: DataFrame, ids: Iterable, key: str = "row_id") -> DataFrame:
    """Entries of the given rows; reads their buckets only.  Null ids match nothing."""
    return matrix.where(F.col(key).isin([i for i in ids if i is not None]))


class BucketedMatrix:
    """Rows and entries of a matrix in equal buckets, in the shared folder of the session.

    A context that takes its tables out of the catalogue at its end.  Files stay until
    the folder is cleaned, like all tables there.
    """

    def __init__(self, rows: DataFrame, entries: DataFrame, buckets: int | None = None, key: str = "row_id"):
        spark: SparkSession = rows.sparkSession
        name = f"matrix_{uuid.uuid4().hex}"
        folder = f"{ensure_checkpoint_dir(spark)}/{name}"
        self._spark, self._tables = spark, [f"{name}_rows", f"{name}_entries"]
        self.rows = write_bucketed(rows, self._tables[0], buckets, key, f"{folder}/rows")
        self.entries = write_bucketed(entries, self._tables[1], buckets, key, f"{folder}/entries")

    def __enter__(self) -> "BucketedMatrix":
        return self

    def __exit__(self, *problem) -> None:
        self.release()

    def release(self) -> None:
        for table in self._tables:
            self._spark.sql(f"drop table if exists {table}")

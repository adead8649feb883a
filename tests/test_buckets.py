"""Bucketed matrices: plans without a shuffle, pruned buckets, results of the plain way."""

import pytest

from cellwise.operators import summarize
from cellwise.session import ensure_checkpoint_dir
from cellwise.sources.buckets import BucketedMatrix, rows_of, write_bucketed


@pytest.fixture
def rows(spark):
    return spark.range(200).select("id").withColumnRenamed("id", "row_id")


@pytest.fixture
def entries(spark):
    # row 7 holds a third of all entries, every fifth row none
    return spark.sql(
        "select if(i % 3 = 0, 7L, i % 200) as row_id, cast(i % 31 as int) as col_id, i / 2.0D as value"
        " from (select id as i from range(3000)) where i % 3 = 0 or i % 200 % 5 > 0"
    )


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def content(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_counts_without_shuffle(spark, rows, entries):
    with BucketedMatrix(rows, entries, 6) as matrix:
        found = summarize.nnz_per_row(matrix.rows, matrix.entries)
        assert "hashpartitioning" not in plan(found)
        assert "hashpartitioning" in plan(summarize.nnz_per_row(rows, entries))
        assert content(found) == content(summarize.nnz_per_row(rows, entries))
        threshold = "spark.sql.autoBroadcastJoinThreshold"
        spark.conf.set(threshold, "-1")
        try:
            merged = summarize.nnz_per_row(matrix.rows, matrix.entries)
            assert "Exchange" not in plan(merged)
            assert content(merged) == content(found)
        finally:
            spark.conf.unset(threshold)
        names = list(matrix._tables)
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_rows_read_their_buckets_only(spark, rows, entries):
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    with BucketedMatrix(rows, entries, 16) as matrix:
        some = rows_of(matrix.entries, [7])
        spark.conf.set(auto, "false")  # else the plan does not print the buckets it selects
        try:
            assert "SelectedBucketsCount: 1 out of 16" in plan(rows_of(matrix.entries, [7]))
        finally:
            spark.conf.unset(auto)
        assert content(some) == content(entries.where("row_id = 7"))
        assert content(rows_of(matrix.entries, [7, 11, None])) == content(entries.where("row_id in (7, 11)"))
        assert rows_of(matrix.entries, []).count() == 0 and rows_of(matrix.entries, [-5]).count() == 0


def test_odd_tables(spark, rows, entries):
    with BucketedMatrix(rows, entries.limit(0), 4) as matrix:
        assert summarize.nnz_per_row(matrix.rows, matrix.entries).agg({"nnz": "sum"}).first()[0] == 0
    odd = spark.createDataFrame([(None, 1, 1.0), (3, 1, None), (3, 1, None), (3, 2, 2.0)], "row_id bigint, col_id int, value double")
    with BucketedMatrix(rows, odd, 4) as matrix:
        assert content(matrix.entries) == content(odd)
    with pytest.raises(ValueError, match="bucket"):
        write_bucketed(entries, "never", 0)


def test_modes(spark, entries):
    path = f"{ensure_checkpoint_dir(spark)}/bucketed-modes"
    first = write_bucketed(entries, "modes", 4, path=path)
    with pytest.raises(Exception, match="already exists"):
        write_bucketed(entries, "modes", 4, path=path)
    assert content(write_bucketed(entries.limit(5), "modes", 2, path=path, mode="overwrite")) == content(entries.limit(5))
    assert first.columns == entries.columns
    spark.sql("drop table modes")

"""Every registered query against its SQL equivalent, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as contract
from cellwise.catalog import corpus, dense, tables

QUERIES = {**dense.QUERIES, **tables.QUERIES, **corpus.QUERIES}
ORACLE = {**dense.ORACLE, **tables.ORACLE, **corpus.ORACLE}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def canonical(rows):
    def cell(value):
        if isinstance(value, bool) or value is None or isinstance(value, str):
            return str(value)
        value = float(value)
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"

    return sorted(tuple(cell(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    got = [tuple(row[c] for c in columns) for row in frame.collect()]
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert canonical(got) == canonical(want)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["point_id", "label", "cluster"]
    assert frame.count() == 500
    assert frame.select("cluster").distinct().count() == 10

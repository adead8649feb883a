import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.operators import prep
from cellwise.sources import tabular
from cellwise.sources.synthetic import blobs


def test_text_becomes_numbers_or_null(spark):
    texts = ["12", " 12 ", "-1.5", "+.5", "3.", "1e3", "1E-2", "inf", "-Infinity", "1d", "1_000", "0x10", "abc",
             "", "NaN", None, "1 2", "--1"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = [r["t"] for r in prep.coerce_numeric(frame, ["id"]).orderBy("id").collect()]
    inf = float("inf")
    assert got == [12.0, 12.0, -1.5, 0.5, 3.0, 1000.0, 0.01, inf, -inf] + [None] * 9


def test_other_types_are_decided_from_the_schema(spark):
    frame = spark.sql(
        "select 1 as i, cast(2.5 as decimal(5,2)) as d, true as b, cast('nan' as double) as n,"
        " current_timestamp() as ts, array(1) as a, cast(3 as float) as f, date'2024-01-01' as day"
    )
    row = prep.coerce_numeric(frame).first()
    assert tuple(row) == (1.0, 2.5, 1.0, None, None, None, 3.0, None)


def test_order_of_dropping_matters(spark):
    frame = spark.createDataFrame(
        [(1, "tcp", "5", 1.0), (2, "udp", "x", 2.0), (3, "tcp", "7", float("nan"))],
        "id int, kind string, a string, b double",
    )
    numeric = prep.coerce_numeric(frame, ["id"])
    kept = prep.drop_empty_columns(numeric, ["id"])
    assert kept.columns == ["id", "a", "b"]
    assert [r["id"] for r in prep.drop_null_rows(kept).collect()] == [1]
    assert prep.drop_null_rows(numeric).count() == 0


def test_drop_empty_columns_without_candidates(spark):
    assert prep.drop_empty_columns(spark.range(2), ["id"]).columns == ["id"]


def test_select_numeric_uses_types_only(spark):
    frame = spark.createDataFrame([(1, "2", 3, 4.5)], "id bigint, text string, i int, d double")
    got = prep.select_numeric(frame, ["id"])
    assert got.dtypes == [("id", "bigint"), ("i", "double"), ("d", "double")]


def test_standardize_uses_the_population_deviation(spark):
    values = np.random.default_rng(0).normal(5, 3, 200)
    frame = spark.createDataFrame([(float(v), 7.0, None) for v in values], "x double, c double, e double")
    got = prep.standardize(frame.repartition(5), ["x", "c", "e"]).collect()
    want = (values - values.mean()) / values.std()
    np.testing.assert_allclose(sorted(r["x"] for r in got), np.sort(want), atol=1e-12)
    assert {r["c"] for r in got} == {0.0} and {r["e"] for r in got} == {None}


def test_prepared_points_have_mean_zero_and_deviation_one(spark):
    frame = spark.range(100).select(
        F.col("id").alias("k"), F.lit("tcp").alias("kind"), (F.col("id") * 2).cast("string").alias("a"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("b"), F.lit(1).alias("constant"),
    )
    points = prep.prepare_points(frame, "k")
    matrix = np.array([r["features"] for r in points.orderBy("k").collect()])
    assert points.columns == ["k", "features"] and matrix.shape == (90, 3)
    np.testing.assert_allclose(matrix.mean(axis=0), 0, atol=1e-12)
    np.testing.assert_allclose(matrix.std(axis=0), [1, 1, 0], atol=1e-12)


def test_subset_sa_thins_only_abnormal_rows(spark):
    frame = spark.range(20_000).withColumn("bad", F.col("id") % 5 != 0)  # 80 % abnormal
    kept = tabular.subset_sa(frame, F.col("bad"), "id")
    row = kept.agg(F.count_if(~F.col("bad")), F.count_if("bad")).first()
    assert row[0] == 4000
    assert row[1] / (row[0] + row[1]) == pytest.approx(0.01, abs=0.004)
    assert tabular.keep_probability(10, 0, 0.01) == 0.0
    assert tabular.keep_probability(1_000_000, 1, 0.01) == 1.0


def test_subset_sf_and_ordinal_split(spark):
    frame = spark.range(100).withColumn("logged_in", (F.col("id") % 4 == 0).cast("int"))
    assert tabular.subset_sf(frame, F.col("logged_in")).count() == 25
    ids = frame.select((F.col("id") * 17 % 1000 + 2286).alias("row_id")).repartition(6)
    ordered = sorted(r[0] for r in ids.collect())
    for n in (0, 1, 37, 100, 500):
        split = tabular.split_ordinal(ids, "row_id", n)
        assert sorted(r[0] for r in split.where("split = 'train'").collect()) == ordered[:n]
        assert split.count() == 100


def test_text_formats_need_a_schema(spark, tmp_path):
    with pytest.raises(ValueError, match="schema"):
        tabular.load_table(spark, str(tmp_path), file_format="csv")
    (tmp_path / "a.csv").write_text("1,tcp\n2,udp\n")
    got = tabular.load_table(spark, str(tmp_path / "a.csv"), "id bigint, kind string", "csv")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "tcp"), (2, "udp")]


def test_only_small_inputs_are_spread(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(1000).coalesce(1).write.parquet(path)
    frame = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert tabular.spread_small(frame).rdd.getNumPartitions() == cores
    assert tabular.spread_small(frame).count() == 1000
    assert tabular.spread_small(frame, max_bytes=10) is frame
    many = spark.range(1000).repartition(5 * cores)
    assert tabular.spread_small(many) is many


def test_blobs_are_the_same_for_any_partitioning(spark):
    def rows(frame):
        return sorted((r[0], tuple(r[1]), r[2]) for r in frame.collect())

    assert rows(blobs(spark, 500, partitions=1)) == rows(blobs(spark, 500, partitions=7))
    sizes = {r["label"]: r["count"] for r in blobs(spark, 500).groupBy("label").count().collect()}
    assert sizes == {0: 125, 1: 125, 2: 125, 3: 125}

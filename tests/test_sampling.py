import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.functions.uniform import keyed_normal, keyed_uniform
from cellwise.operators import order_stats
from cellwise.operators.indexing import with_consecutive_index
from cellwise.operators.order_stats import median, value_at_rank
from cellwise.operators.sampling import (
    sample_by_probability,
    sample_exact,
    sample_fraction,
    seed_point,
)


def ids(frame, column="id"):
    return sorted(r[0] for r in frame.select(column).collect())


@pytest.mark.parametrize("rng", ["xxhash64", "md5"])
def test_uniforms_are_uniform_and_do_not_depend_on_partitions(spark, rng):
    base = spark.range(20_000)
    u = keyed_uniform("id", 42, 3, rng)
    row = base.select(u.alias("u")).agg(F.min("u"), F.max("u"), F.avg("u"), F.stddev("u")).first()
    assert 0 <= row[0] and row[1] < 1
    assert row[2] == pytest.approx(0.5, abs=0.01) and row[3] == pytest.approx(12**-0.5, abs=0.01)
    kept = [ids(sample_fraction(base.repartition(n), "id", 0.1, 42, 3, rng)) for n in (1, 5, 20)]
    assert kept[0] == kept[1] == kept[2]
    assert 1800 < len(kept[0]) < 2200
    assert kept[0] != ids(sample_fraction(base, "id", 0.1, 42, 4, rng))


def test_md5_uniform_follows_its_definition(spark):
    got = {r[0]: r[1] for r in spark.range(50).select("id", keyed_uniform("id", 7, 2, "md5")).collect()}
    for i, value in got.items():
        assert value == int(hashlib.md5(f"7:2:{i}".encode()).hexdigest()[:13], 16) / 2**52


def test_normals_have_unit_variance(spark):
    row = spark.range(20_000).select(keyed_normal("id", 1).alias("x")).agg(F.avg("x"), F.stddev("x")).first()
    assert row[0] == pytest.approx(0, abs=0.03) and row[1] == pytest.approx(1, abs=0.03)


def test_unknown_generator_is_refused():
    with pytest.raises(ValueError, match="unknown rng"):
        keyed_uniform(F.lit(1), 1, rng="other")


def test_rows_keep_their_own_probability(spark):
    frame = spark.range(1000).withColumn("p", F.when(F.col("id") < 500, 1.0).otherwise(0.0))
    assert ids(sample_by_probability(frame, "id", "p", 1)) == list(range(500))


@pytest.mark.parametrize("n", [0, 1, 17, 999, 1000, 5000])
def test_exact_sample_takes_the_smallest_uniforms(spark, n):
    frame = spark.range(1000).repartition(7)
    u = {r[0]: r[1] for r in frame.select("id", keyed_uniform("id", 5)).collect()}
    want = sorted(sorted(u, key=u.get)[:n])
    assert ids(sample_exact(frame, "id", n, 5)) == want


def test_exact_sample_breaks_equal_uniforms_by_key(spark):
    # every uniform occurs twice, since the key is hashed without its second half
    frame = spark.range(40).withColumn("half", F.col("id") % 20)
    picked = sample_exact(frame, "half", 7, 5)
    assert picked.count() == 7


def test_seed_point_is_one_row_for_any_partitioning(spark):
    picks = {seed_point(spark.range(300).repartition(n), "id", 9).first()[0] for n in (1, 5, 20)}
    assert len(picks) == 1
    assert seed_point(spark.range(0), "id", 9).count() == 0


@pytest.mark.parametrize(
    "values",
    [
        [3],
        [5] * 50,
        list(range(2000)),
        [0] * 700 + list(range(1300)),  # a third of all rows share one value
        [-(2**63), 2**63 - 1, 0, 5, 2**62],
        [2**60 + i for i in range(100)],
    ],
)
def test_ranks_of_integers(spark, values):
    rng = np.random.default_rng(0)
    shuffled = [values[i] for i in rng.permutation(len(values))]
    frame = spark.createDataFrame([(v,) for v in shuffled], "v bigint")
    ordered = sorted(values)
    for rank in {0, len(values) // 3, len(values) // 2, len(values) - 1}:
        assert value_at_rank(frame, "v", rank) == ordered[rank]


def test_ranks_of_doubles_and_median(spark):
    rng = np.random.default_rng(1)
    for values in (
        rng.normal(size=501), rng.normal(size=500) ** 15, np.array([1.0, 2.0]), np.array([1e308, -1e308, 0, 1]),
        np.repeat([0.1, 0.2], [300, 2]),
    ):
        frame = spark.createDataFrame([(float(v),) for v in values], "v double")
        assert median(frame, "v") == pytest.approx(np.median(values), rel=1e-15)
        assert value_at_rank(frame, "v", 1) == np.sort(values)[1]


def test_ranks_skip_nulls_and_refuse_bad_ranks(spark):
    frame = spark.createDataFrame([(None,), (2.0,), (1.0,)], "v double")
    assert value_at_rank(frame, "v", 0) == 1.0
    assert median(frame, "v") == 1.5
    assert median(frame.where("v is null"), "v") is None
    with pytest.raises(ValueError, match="outside"):
        value_at_rank(frame, "v", 2)


def test_consecutive_index_follows_key_order(spark):
    words = [f"w{i * 7919 % 1000:03d}" for i in range(1000)]
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(9)
    got = with_consecutive_index(frame, "word", 10).collect()
    assert [r["word"] for r in sorted(got, key=lambda r: r["idx"])] == sorted(words)
    assert sorted(r["idx"] for r in got) == list(range(10, 1010))
    assert with_consecutive_index(frame.limit(0), "word").count() == 0


@pytest.mark.parametrize("collected", [0, 50_000])
def test_ranks_take_two_passes_over_the_values(spark, monkeypatch, collected):
    monkeypatch.setattr(order_stats, "_COLLECTED", collected)
    passes = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    values = np.random.default_rng(4).lognormal(size=20_000)
    values[::3] = 1.25  # one value holds a third of the rows
    frame = spark.createDataFrame([(float(x),) for x in values], "v double").mapInArrow(watched, "v double")
    assert value_at_rank(frame, "v", 14_321) == np.sort(values)[14_321]
    assert passes.value == 2 * len(values)
    assert median(frame, "v") == np.median(values)
    assert passes.value == 4 * len(values)


def test_ranks_stay_exact_if_the_sketch_misses(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "_ACCURACY", 2)
    values = np.random.default_rng(5).normal(size=3000)
    frame = spark.createDataFrame([(float(x),) for x in values], "v double").repartition(7)
    for rank in (0, 1, 700, 1999, 2999):
        assert value_at_rank(frame, "v", rank) == np.sort(values)[rank]

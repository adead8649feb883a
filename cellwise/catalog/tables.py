"""Queries over mixed tables: subsets, samples and preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwise.catalog.dense import SEED, u_sql
from cellwise.operators import prep
from cellwise.operators.sampling import sample_fraction
from cellwise.sources import tabular

# Rows the official ordinal split gives to training, of all rows.
TRAIN_ROWS, ALL_ROWS = 23_149, 804_414


def _table(spark, sf, name):
    return tabular.load_table(spark, f"{sf}/{name}.parquet")


def q_subset_sa(spark, sf):
    events = _table(spark, sf, "events")
    kept = tabular.subset_sa(events, F.col("event_type") == "error", "event_id", 0.01, SEED, "md5")
    return kept.select("event_id", "event_type")


def q_subset_sf(spark, sf):
    flagged = _table(spark, sf, "events").withColumn(
        "logged_in", F.col("event_type").isin("purchase", "signup").cast("int")
    )
    return tabular.subset_sf(flagged, F.col("logged_in")).select("event_id", "event_type")


def q_sample_fraction(spark, sf):
    return sample_fraction(_table(spark, sf, "events"), "event_id", 0.1, SEED, 0, "md5").select("event_id")


def q_split_ordinal(spark, sf):
    orders = _table(spark, sf, "orders").select("o_orderkey")
    n_train = orders.count() * TRAIN_ROWS // ALL_ROWS
    return tabular.split_ordinal(orders, "o_orderkey", n_train)


def q_coerce_numeric(spark, sf):
    return prep.coerce_numeric(_table(spark, sf, "part"), ["p_partkey"])


def q_drop_empty_columns(spark, sf):
    return prep.drop_empty_columns(prep.coerce_numeric(_table(spark, sf, "part"), ["p_partkey"]), ["p_partkey"])


def _gappy_events(spark, sf):
    """Events whose value reads ``n/a`` for every seventh id."""
    value = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return _table(spark, sf, "events").withColumn("value", value)


def q_drop_null_rows(spark, sf):
    numeric = prep.drop_empty_columns(prep.coerce_numeric(_gappy_events(spark, sf), ["event_id"]))
    return prep.drop_null_rows(numeric)


def q_select_numeric(spark, sf):
    return prep.select_numeric(_table(spark, sf, "part"))


def q_standardize(spark, sf):
    part = _table(spark, sf, "part").select(
        "p_partkey", "p_size", "p_retailprice", F.lit(7.0).alias("constant")
    )
    columns = ["p_size", "p_retailprice", "constant"]
    scaled = prep.standardize(part, columns)
    return scaled.select("p_partkey", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in columns])


def q_assemble_features(spark, sf):
    vectors = prep.assemble_features(_table(spark, sf, "part"), ["p_size", "p_retailprice"], ["p_partkey"])
    return vectors.select("p_partkey", F.posexplode("features").alias("dim", "value"))


def q_prepare_points(spark, sf):
    ready = prep.prepare_points(_gappy_events(spark, sf), "event_id")
    return ready.select(
        "event_id",
        F.size("features").alias("dimension"),
        F.round(F.get("features", F.lit(0)), 6).alias("user_id"),
        F.round(F.get("features", F.lit(1)), 6).alias("value"),
    )


NUMBER_SQL = (
    r"case when regexp_full_match(trim({c}), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')"
    " then try_cast(trim({c}) as double) end as {c}"
)
GAPPY = (
    "g as (select event_id, user_id::double as user_id, case when event_id % 7 <> 0 then value end as value"
    " from events), k as (select * from g where value is not null)"
)


def _scaled(column: str, table: str) -> str:
    return (
        f"round(({column} - (select avg({column}) from {table}))/(select case when stddev_pop({column}) = 0"
        f" then 1 else stddev_pop({column}) end from {table}), 6) + 0.0::double as {column}"
    )


ORACLE = {
    "subset_sa": "with p as (select 0.01/(1-0.01)*count(*) filter (where event_type <> 'error')"
    "/count(*) filter (where event_type = 'error') as p from events)"
    f" select event_id, event_type from events, p where event_type <> 'error' or {u_sql(0, 'event_id')} < p",
    "subset_sf": "select event_id, event_type from events where event_type in ('purchase', 'signup')",
    "sample_fraction": f"select event_id from events where {u_sql(0, 'event_id')} < 0.1",
    "split_ordinal": "select o_orderkey, case when row_number() over (order by o_orderkey) <="
    f" (select count(*) * {TRAIN_ROWS} // {ALL_ROWS} from orders) then 'train' else 'test' end as split from orders",
    "coerce_numeric": "select p_partkey, "
    + ", ".join(NUMBER_SQL.format(c=c) for c in ("p_name", "p_brand", "p_type"))
    + ", p_size::double as p_size, p_retailprice from part",
    "drop_empty_columns": "select p_partkey, p_size::double as p_size, p_retailprice from part",
    "drop_null_rows": f"with {GAPPY} select event_id, user_id, value from k",
    "select_numeric": "select p_partkey::double as p_partkey, p_size::double as p_size, p_retailprice from part",
    "standardize": f"select p_partkey, {_scaled('p_size', 'part')}, {_scaled('p_retailprice', 'part')},"
    " 0.0::double as constant from part",
    "assemble_features": "select p_partkey, 0::int as dim, p_size::double as value from part"
    " union all select p_partkey, 1::int, p_retailprice from part",
    "prepare_points": f"with {GAPPY} select event_id, 2::int as dimension, {_scaled('user_id', 'k')},"
    f" {_scaled('value', 'k')} from k",
}

QUERIES = {
    name[2:]: function for name, function in list(globals().items()) if name.startswith("q_")
}

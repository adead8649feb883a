"""Queries over the sparse corpus: term weights, labels, profile and statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.catalog.dense import OVERSAMPLING, SEED, u_sql
from cellwise.operators import nearest, summarize
from cellwise.operators.indexing import with_consecutive_index
from cellwise.operators.sampling import sample_exact
from cellwise.plans.config import FitConfig, SeedConfig
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.seeding import seed_candidates
from cellwise.plans.sparse_lloyd import long_centers
from cellwise.session import cut_lineage, ensure_checkpoint_dir, small_batches
from cellwise.sources import profile, sparse
from cellwise.sources.buckets import BucketedMatrix
from cellwise.sources.tabular import load_table, spread_small

LABEL_COLUMNS = ["quality", "toxic"]
SAMPLE_SIZE = 500_000


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, f"{sf}/documents.parquet")


def spread_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to split into terms, the heaviest work per row here."""
    return spread_small(documents(spark, sf).select("doc_id", "text"))


def rows(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(F.col("doc_id").alias("row_id"))


def terms(spark: SparkSession, sf: str) -> DataFrame:
    whole = documents(spark, sf)
    return sparse.term_matrix(spread_documents(spark, sf), n_rows=whole.count())


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return sparse.vocabulary(spread_documents(spark, sf))


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return sparse.label_entries(load_table(spark, f"{sf}/labels.parquet"), "doc_id", LABEL_COLUMNS)


def _new_folder(spark: SparkSession) -> str:
    """A folder all executors share, for a stored copy of the matrices."""
    return f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"


def q_load_sparse(spark, sf):
    """Store the term matrix and read it back."""
    path = f"{_new_folder(spark)}/x"
    sparse.write_sparse(terms(spark, sf), path)
    return sparse.load_sparse(spark, path).groupBy("row_id").agg(
        F.count(F.lit(1)).alias("nnz"), F.round(F.sum(F.col("value") * F.col("value")), 6).alias("sum_squares")
    )


def _dimensions(spark, sf):
    return rows(spark, sf).count(), vocabulary(spark, sf).count(), len(LABEL_COLUMNS)


def q_dataset_profile(spark, sf):
    return profile.dataset_profile(terms(spark, sf), labels(spark, sf), *_dimensions(spark, sf))


def q_verify_profile(spark, sf):
    """Ingest both matrices with their dictionaries, then check what was stored."""
    folder = _new_folder(spark)
    keys = {
        "rows": rows(spark, sf), "columns": cut_lineage(vocabulary(spark, sf).select("term")),
        "categories": spark.range(len(LABEL_COLUMNS)).select(F.col("id").cast("int")),
    }
    dims = keys["rows"].count(), keys["columns"].count(), len(LABEL_COLUMNS)
    sparse.ingest_sparse(terms(spark, sf), labels(spark, sf), folder, *dims, keys=keys)
    return profile.verification(spark, folder)


def q_nnz_per_row(spark, sf):
    return summarize.nnz_per_row(rows(spark, sf), terms(spark, sf))


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.select("n", *[F.round(c, 6).alias(c) for c in frame.columns if c != "n"])


def q_nnz_summary(spark, sf):
    return _rounded(summarize.summary(q_nnz_per_row(spark, sf), "nnz"))


def q_nnz_histogram(spark, sf):
    return _rounded_bins(summarize.histogram(q_nnz_per_row(spark, sf), "nnz"))


def _values(spark, sf):
    return terms(spark, sf).select(F.round("value", 6).alias("value"))


def _rounded_bins(bins: DataFrame) -> DataFrame:
    return bins.select("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n")


def q_histogram_100(spark, sf):
    return _rounded_bins(summarize.histogram(_values(spark, sf), "value"))


def q_value_summary(spark, sf):
    return _rounded(summarize.summary(_values(spark, sf), "value"))


def q_sample_values(spark, sf):
    key = F.concat_ws(":", F.col("row_id").cast("string"), "term")
    entries = cut_lineage(terms(spark, sf))  # read by the search and for the result
    drawn = sample_exact(entries, key, SAMPLE_SIZE, 42, "md5")
    return drawn.select("row_id", "term", F.round("value", 6).alias("value"))


def q_labels_per_row(spark, sf):
    return summarize.counts_with_zeros(rows(spark, sf), labels(spark, sf), "row_id", "n_labels")


def q_bucketed_labels_per_row(spark, sf):
    """Labels a row from bucketed tables: one shuffle to write them, none to count and join."""
    with BucketedMatrix(rows(spark, sf), labels(spark, sf)) as matrix:
        return cut_lineage(summarize.counts_with_zeros(matrix.rows, matrix.entries, "row_id", "n_labels"))


def q_label_summary(spark, sf):
    return _rounded(summarize.summary(q_labels_per_row(spark, sf), "n_labels"))


def q_labels_histogram(spark, sf):
    return summarize.integer_histogram(q_labels_per_row(spark, sf), "n_labels")


def q_rows_per_category(spark, sf):
    return sparse.rows_per_term(spread_documents(spark, sf), n_rows=documents(spark, sf).count())


def q_category_summary(spark, sf):
    return _rounded(summarize.summary(q_rows_per_category(spark, sf), "n", with_mean=False))


def q_top_categories(spark, sf):
    return summarize.top_ranked(q_rows_per_category(spark, sf), "n", "term")


def q_column_ids(spark, sf):
    return sparse.index_columns(terms(spark, sf))


def _matrix(spark, sf):
    """Term matrix, its dictionary, and one sparse vector a document."""
    entries = cut_lineage(terms(spark, sf))  # read by the dictionary, the centres and the points
    dictionary = sparse.index_columns(entries)
    width = dictionary.count()
    long = sparse.with_column_ids(entries, dictionary)
    return entries, dictionary, width, sparse.sparse_rows(rows(spark, sf), long, width)


def _language_centers(spark, sf, entries, dictionary, width):
    """The first document of each language: ``(cluster, center)``."""
    firsts = documents(spark, sf).groupBy("lang").agg(F.min("doc_id").alias("row_id"))
    numbered = with_consecutive_index(firsts, "lang").select("row_id", "idx")
    # the few rows are chosen before their entries are joined with the dictionary
    own = cut_lineage(entries.join(F.broadcast(numbered.select("row_id")), "row_id"))
    long = own.join(dictionary.join(F.broadcast(own.select("term").distinct()), "term"), "term").select("row_id", "col_id", "value")
    chosen = sparse.sparse_rows(numbered, long, width)
    return chosen.join(numbered, "row_id").select(F.col("idx").cast("int").alias("cluster"), F.col("features").alias("center"))


def q_sparse_nearest(spark, sf):
    """Nearest of the first documents of each language, by sparse distances."""
    entries, dictionary, width, data = _matrix(spark, sf)
    near = nearest.nearest_center(data, _language_centers(spark, sf, entries, dictionary, width), index_col="cluster")
    return near.select(
        F.col("row_id").alias("doc_id"), F.col("idx").alias("cluster"), F.round("d2", 6).alias("d2")
    )


def q_sparse_seed_candidates(spark, sf):
    """Two rounds of seeding over all documents, each a sparse vector."""
    with small_batches(spark):
        _, _, _, data = _matrix(spark, sf)
        data = cut_lineage(data.withColumnRenamed("row_id", "point_id"))  # read in every round
        seeding = seed_candidates(data, SeedConfig(OVERSAMPLING, 2, seed=SEED, rng="md5", storage=None))
    seeding.release()
    return seeding.candidates.select("idx", F.col("point_id").alias("doc_id"), "round", "weight")


def q_sparse_lloyd_1(spark, sf):
    """One Lloyd iteration over all documents from the first one of each language."""
    entries, dictionary, width, data = _matrix(spark, sf)
    model = fit_centers(data, _language_centers(spark, sf, entries, dictionary, width), FitConfig(1, 0.0))
    found = long_centers(model.centers_frame(spark)).join(dictionary, "col_id")
    return found.select("cluster", "term", F.round("value", 9).alias("value"))


T = (
    "tok as (select doc_id as row_id, lower(raw) as term from (select doc_id,"
    r" unnest(string_split_regex(text, '[^\p{L}\p{N}]+')) as raw from documents) where raw <> ''),"
    " tf as (select row_id, term, count(*) as tf from tok group by all),"
    " df as (select term, count(*) as df from tf group by all),"
    " wt as (select row_id, term, (1 + ln(tf))*ln((select count(*) from documents)::double/df) as w"
    " from tf join df using (term)),"
    " t as (select row_id, term, w/sqrt(sum(w*w) over (partition by row_id)) as value from wt where w > 0),"
    " r as (select doc_id as row_id from documents)"
)
Y = (
    "y as (select doc_id as row_id, 0::int as category_id from labels where quality <> 0"
    " union all select doc_id, 1::int from labels where toxic <> 0)"
)
NNZ = "nnz as (select row_id, coalesce(n, 0) as nnz from r left join (select row_id, count(*) as n from t group by all) using (row_id))"
CAT = "cat as (select term, coalesce(n, 0) as n from df left join (select term, count(*) as n from t group by all) using (term))"
LAB = (
    "lab as (select doc_id as row_id, coalesce(n, 0) as n_labels from documents left join"
    " (select row_id, count(*) as n from y group by all) on row_id = doc_id)"
)
VALUES = "v as (select round(value, 6) as value from t)"
PROFILE = (
    "p as (select (select count(*) from documents) as n_samples, (select count(*) from df) as n_features,"
    " 2::bigint as n_categories, (select count(*) from t) as x_nnz, (select count(*) from y) as y_nnz)"
)


def _summary(column: str, table: str, mean: bool = True) -> str:
    average = f", round(avg({column}), 6) as mean" if mean else ""
    return (
        f"select count({column}) as n, min({column})::double as min, max({column})::double as max{average},"
        f" round(median({column}), 6)::double as median from {table}"
    )


def _histogram(column: str, table: str) -> str:
    return (
        f"lim as (select min({column})::double as lo, max({column})::double as hi from {table}),"
        " edges as (select i, case when i = 100 then hi else lo + i*((hi - lo)/100) end as edge"
        " from lim, (select unnest(range(101)) as i)),"
        " bins as (select a.i::int as bin, a.edge as lower, b.edge as upper from edges a join edges b on b.i = a.i + 1)"
        f" select bin, round(lower, 6) as lower, round(upper, 6) as upper, count({column}) as n from bins"
        f" left join {table} on {column} >= lower and ({column} < upper or bin = 99) group by all"
    )


# Documents and their nearest of the first documents of each language.
NEAR = (
    "f as (select (row_number() over (order by lang) - 1)::int as cluster, row_id from"
    " (select lang, min(doc_id) as row_id from documents group by lang)),"
    " n as (select r.row_id, coalesce(sum(value*value), 0) as s from r left join t using (row_id) group by all),"
    " dots as (select f.cluster, t.row_id, sum(t.value*c.value) as dot from t join t c using (term)"
    " join f on f.row_id = c.row_id group by all),"
    " pairs as (select n.row_id as doc_id, f.cluster, greatest(0.0, n.s - 2*coalesce(dot, 0) + cn.s) as d2"
    " from n cross join f join n cn on cn.row_id = f.row_id left join dots on dots.cluster = f.cluster"
    " and dots.row_id = n.row_id),"
    " a as materialized (select doc_id, arg_min(cluster, (round(d2, 9), cluster)) as cluster, min(d2) as d2 from pairs group by doc_id)"
)


def _stored(ctes: str) -> str:
    """The term matrix computed once."""
    return ctes.replace(" t as (", " t as materialized (")


def _sparse_seeding_sql(rounds: int) -> str:
    """CTEs ``st0..stN`` (state) and ``candN`` over the long form; distances by dot products, equal to nine digits."""
    near = (
        "(select n.row_id, w.idx, round(greatest(0.0, n.s - 2*coalesce(dot, 0) + cn.s), 12) as d2 from n cross join {new} w"
        " join n cn on cn.row_id = w.row_id left join (select w.idx, t.row_id, sum(t.value*c.value) as dot from {new} w"
        " join t c on c.row_id = w.row_id join t on t.term = c.term group by all) d on d.idx = w.idx and d.row_id = n.row_id)"
    )
    ctes = [
        "n as materialized (select r.row_id, coalesce(sum(value*value), 0) as s from r left join t using (row_id) group by all)",
        f"new0 as materialized (select 0::int as idx, row_id, 0::int as round from r order by {u_sql(0, 'row_id')}, row_id limit 1)",
        "cand0 as (select * from new0)",
        "st0 as materialized (select row_id, d2, idx from " + near.format(new="new0") + ")",
    ]
    for t in range(1, rounds + 1):
        p = t - 1
        ctes += [
            f"cost{t} as (select sum(d2) as cost from st{p})",
            f"new{t} as materialized (select ((select count(*) from cand{p}) - 1 + row_number() over (order by row_id))::int as idx, row_id, {t}::int as round"
            f" from st{p}, cost{t} where {u_sql(t, 'row_id')} < least(1.0, d2*{OVERSAMPLING}/cost))",
            f"cand{t} as (select * from cand{p} union all select * from new{t})",
            f"near{t} as (select row_id, arg_min(idx, (round(d2, 9), idx)) as idx, min(d2) as d2 from " + near.format(new=f"new{t}") + " group by row_id)",
            f"st{t} as materialized (select s.row_id, case when round(n.d2, 9) < round(s.d2, 9) then n.d2 else s.d2 end as d2,"
            f" case when round(n.d2, 9) < round(s.d2, 9) then n.idx else s.idx end as idx from st{p} s left join near{t} n using (row_id))",
        ]
    return ", ".join(ctes)


KEY_UNIFORM = u_sql(0, "row_id||':'||term")
ORACLE = {
    "load_sparse": f"with {T} select row_id, count(*) as nnz, round(sum(value*value), 6) as sum_squares from t group by all",
    "dataset_profile": f"with {T}, {Y}, {PROFILE} select *, round(100.0*x_nnz/(n_samples*n_features), 3) as x_density_pct,"
    " round(100.0*y_nnz/(n_samples*n_categories), 3) as y_density_pct from p",
    "verify_profile": f"with {T}, {Y}, {PROFILE}, u as (unpivot p on columns(*) into name \"check\" value expected)"
    ' select "check", expected, expected as actual, true as ok from u union all'
    " select unnest(['x_rows_changed', 'x_columns_changed', 'y_rows_changed', 'y_columns_changed']), 0::bigint, 0::bigint, true",
    "nnz_per_row": f"with {T}, {NNZ} select row_id, nnz from nnz",
    "nnz_summary": f"with {T}, {NNZ} " + _summary("nnz", "nnz"),
    "nnz_histogram": f"with {T}, {NNZ}, " + _histogram("nnz", "nnz"),
    "histogram_100": f"with {T}, {VALUES}, " + _histogram("value", "v"),
    "value_summary": f"with {T}, {VALUES} " + _summary("value", "v"),
    "sample_values": f"with {T} select row_id, term, round(value, 6) as value from t"
    f" order by {KEY_UNIFORM}, row_id||':'||term limit {SAMPLE_SIZE}",
    "labels_per_row": f"with {Y}, {LAB} select row_id, n_labels from lab",
    "label_summary": f"with {Y}, {LAB} " + _summary("n_labels", "lab"),
    "labels_histogram": f"with {Y}, {LAB} select value, count(n_labels) as n from"
    " (select unnest(range((select max(n_labels) from lab) + 1)) as value) left join lab on n_labels = value group by all",
    "rows_per_category": "with tok as (select distinct doc_id, lower(raw) as term from (select doc_id,"
    r" unnest(string_split_regex(text, '[^\p{L}\p{N}]+')) as raw from documents) where raw <> ''),"
    " df as (select term, count(*) as df from tok group by term)"
    " select term, case when df < (select count(*) from documents) then df else 0 end as n from df",
    "category_summary": f"with {T}, {CAT} " + _summary("n", "cat", False),
    "top_categories": f"with {T}, {CAT} select (row_number() over (order by n desc, term))::int as rank, term, n"
    " from cat order by n desc, term limit 15",
    "column_ids": f"with {T} select term, (row_number() over (order by term) - 1)::int as col_id"
    " from (select distinct term from t)",
    "sparse_nearest": f"with {T}, {NEAR} select doc_id, cluster, round(d2, 6) as d2 from a",
    "sparse_seed_candidates": f"with {_stored(T)}, {_sparse_seeding_sql(2)} select c.idx, c.row_id as doc_id, c.round,"
    " coalesce(n, 0)::double as weight from cand2 c left join (select idx, count(*) as n from st2 group by idx) using (idx)",
    "sparse_lloyd_1": f"with {_stored(T)}, {NEAR} select cluster, term, round(v/n, 9) as value from"
    " (select cluster, term, sum(value) as v from a join t on t.row_id = a.doc_id group by all)"
    " join (select cluster, count(*) as n from a group by cluster) using (cluster)",
}

ORACLE["bucketed_labels_per_row"] = ORACLE["labels_per_row"]

QUERIES = {
    name[2:]: function for name, function in list(globals().items()) if name.startswith("q_")
}

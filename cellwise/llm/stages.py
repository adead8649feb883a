"""Stages of the pipeline: each applies one operator to the documents that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.llm import contamination, jaccard, mixture, secrets, toxicity
from cellwise.session import cut_lineage, ensure_checkpoint_dir


def _with_row(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and the other columns as ``row``, so that none can clash with what an operator adds."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))


def _rows_of(marked: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, each text carried once."""
    return marked.select(*["text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below a half; null and empty texts are kept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic")
    scored = toxicity.score(_with_row(docs), model, keep=("row", "text"))
    return _rows_of(scored.where("score < 0.5"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: that with the smallest id, null last.

    Rows are judged by id and text, never by id alone: rows of one id and different texts stay
    if they are not linked, and so does a row of null id that has no partner.  Of rows of
    the smallest id of a component one is kept; of rows with equal id and text, the one whose
    columns have the smallest hash.  A text stands for itself by a 64-bit hash.  Documents without words are kept as they are.
    """
    marked = _with_row(docs).withColumn("mark", F.xxhash64("text"))
    keyed = marked.select(F.struct("doc_id", "mark").alias("key"), "text")
    classes = jaccard.set_classes(keyed, "key", "text").where("n > 0")
    counted = classes.groupBy("class", F.col("doc_id").alias("key")).agg(F.count("*").alias("times"))
    least = F.min(F.struct(F.col("key.doc_id").isNull().alias("none"), "key", "times")).alias("x")
    kept = cut_lineage(counted.groupBy("class").agg(least).select(F.col("x.key.doc_id").alias("id"), F.col("x.key.mark").alias("own"), "x.times"))
    has_words = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    found = marked.where(has_words).join(kept.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("own")))
    once = found.where("times = 1").select("text", "row")
    again = found.where("times > 1").groupBy("id", "own").agg(F.any_value("text").alias("text"), F.min_by("row", F.xxhash64("row")).alias("row")).select("text", "row")
    return _rows_of(once.unionByName(again).unionByName(marked.where(~has_words).select("text", "row")), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination.find_contamination(_with_row(docs), benchmark, keep=("row", "text"))
    return _rows_of(found.where(~contamination.is_contaminated()), docs)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text no rule finds a secret."""
    ledger = f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    secrets.update_ledger(docs, ledger)
    leaking = secrets.leaking_blobs(spark, ledger)
    marked = _with_row(docs).select(secrets.address("text").alias("blob"), "text", "row")
    return _rows_of(marked.join(leaking.hint("merge"), "blob", "left_anti"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources have the same share of the text, shuffled."""
    return mixture.mix(docs)

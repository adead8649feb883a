"""The training-data pipeline: toxicity, near duplicates, contamination, secrets, mixture."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellwise.llm import stages
from cellwise.session import cut_lineage

# Each stage gets what the one before it kept: (spark, docs, sf_dir) -> DataFrame.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.reject_toxic),
    ("near_duplicates", stages.drop_near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("secrets", stages.drop_secrets),
    ("mixture", stages.mix_sources),
]

# The stages fit a model and search components of a similarity graph: not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table ``documents``; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

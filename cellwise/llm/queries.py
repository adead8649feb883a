"""The registered queries of the numbered operators, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.llm import bpe, codebooks, contamination, htmltext, jaccard, lexical, mixture, quality, repeats, secrets, toxicity, urlfilter, warc
from cellwise.llm.oracle import ORACLE as ORACLE
from cellwise.session import ensure_checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 200 bytes that occur again."""
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    pages = _table(spark, sf_dir, "pages")
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_archive(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources with the same share of the text, in an order without sources."""
    return mixture.mix(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents, and the verdict of a decision list learnt from ``labels.quality``."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    rules = quality.learn_rules(docs, labels, "doc_id", "text", "quality")
    return quality.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of 13 benchmark words."""
    found = contamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contamination.is_contaminated().alias("contaminated"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page URLs against the rules and the list of the URLs seen on spam hosts."""
    pages = _table(spark, sf_dir, "pages")
    listed = pages.where(F.col("url").rlike("(?i)://([^/?#]*[.])?spam"))
    return urlfilter.filter_urls(pages, listed).drop("listed")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles are similar to 0.8 or more."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or scores of all documents, learnt from the labels that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()), "doc_id", "text", "toxic")
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, from a ledger that starts empty."""
    docs = _table(spark, sf_dir, "documents")
    ledger = f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    secrets.update_ledger(docs, ledger)
    found = secrets.findings(docs, ledger)

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE]))
    return found.select(
        "doc_id", *[F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return htmltext.main_text(_table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: eight parts, sixteen entries, six rounds."""
    codes, books = codebooks.compress(_table(spark, sf_dir, "embeddings"))
    known = F.lit(books.sha256() if books else None).cast("string")
    found = codebooks.with_label_errors(codes)
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", known.alias("codebooks_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in ids of the public vocabulary for many languages, and back."""
    import public_tokenizers

    shared = bpe.share(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), shared, public_tokenizers.PATTERN)
    return bpe.decode(encoded, shared).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical.search(lexical.build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_strings": op1_repeated_strings,
    "op2_warc": op2_warc,
    "op3_mixture": op3_mixture,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontaminate": op5_decontaminate,
    "op6_url_filter": op6_url_filter,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_secrets": op9_secrets,
    "op10_html_text": op10_html_text,
    "op11_vector_codes": op11_vector_codes,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_lexical_search": op13_lexical_search,
}

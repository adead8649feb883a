"""Toxicity by multiple-instance learning: a document is a bag of sentences.

Labels belong to documents.  Each sentence has a probability from its words and word
beginnings, a document's probability is the noisy-or of its sentences
(``1 - (1 - leak) prod(1 - p)``), and the weights are fitted to the documents' labels through
it.  Afterwards the sentences with a high probability of their own are the offending ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm import textgrid
from cellwise.session import cut_lineage, ship_package

SAMPLE_ROWS = 10_000  # labelled documents that the weights are fitted to; the only bound
TRAIN_TASKS = 8  # the sample is bounded, and so is the number of tasks that count its features
DIMENSIONS = 1 << 18
STEMS = (4, 5, 6)  # bytes of a word's beginning that make features of their own

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_NOT_LETTER = ~_LETTER
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[0x0A, 0x0D, *b".!?"]] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32 by feature, 1 MB
    bias: float
    leak: float  # logit


def features(data: np.ndarray, offsets: np.ndarray):
    """Sentences and their features: first and last byte and row of each; (sentence, feature) pairs."""
    low = textgrid.lower_ascii(data)
    first, last, owner = textgrid.spans(low, offsets, _SENTENCE_END)
    starts, ends, _ = textgrid.spans(low, offsets, _NOT_LETTER)
    sentence = np.searchsorted(first, starts, "right") - 1
    words = textgrid.span_hash(low, starts, ends)
    sums, scale = textgrid.prefix_hash(low)
    owners, hashes = [sentence], [words]
    for size in STEMS:
        at = np.flatnonzero(ends - starts > size)
        stem = (sums[starts[at] + size] - sums[starts[at]]) * scale[starts[at]] + np.uint64(size << 32)
        owners.append(sentence[at])
        hashes.append(textgrid.mix(stem))
    feature = (np.concatenate(hashes) % np.uint64(DIMENSIONS)).astype(np.int64)
    return first, last, owner, np.concatenate(owners), feature


def _counts(batches):
    """Documents with each feature, and how many of them have label 1; one row a feature and task."""
    docs, marked = np.zeros(DIMENSIONS, np.int64), np.zeros(DIMENSIONS, np.int64)
    for batch in batches:
        label = batch.column(2).to_numpy()
        for row, data, offsets in textgrid.blocks(batch.column(1)):
            _, _, owner, sentence, feature = features(data, offsets)
            pair = np.unique(owner[sentence] * DIMENSIONS + feature)
            docs += np.bincount(pair % DIMENSIONS, minlength=DIMENSIONS)
            marked += np.bincount(pair % DIMENSIONS, label[row + pair // DIMENSIONS], minlength=DIMENSIONS).astype(np.int64)
    seen = np.flatnonzero(docs)
    yield pa.record_batch({"feature": seen, "docs": docs[seen], "marked": marked[seen]})


def _bags(useful, batches):
    """The useful features of each document as (sentence, index) pairs, and its number of sentences."""
    known = useful.value
    for batch in batches:
        for row, data, offsets in textgrid.blocks(batch.column(1)):
            n = len(offsets) - 1
            _, _, owner, sentence, feature = features(data, offsets)
            index = np.minimum(np.searchsorted(known, feature), len(known) - 1)
            hit = known[index] == feature
            pair = np.unique(sentence[hit] * len(known) + index[hit])
            own = owner[pair // len(known)]
            base = np.searchsorted(owner, np.arange(n + 1))
            at = np.searchsorted(own, np.arange(n + 1))
            pair = np.stack([pair // len(known) - base[own], pair % len(known)], axis=1).astype(np.int32)
            bags = pa.array([pair[at[i] : at[i + 1]].tobytes() for i in range(n)], pa.binary())
            yield pa.record_batch({"doc_id": batch.column(0).slice(row, n), "toxic": batch.column(2).slice(row, n), "sentences": np.diff(base), "bag": bags})


def fit(sentences: np.ndarray, bags: list[np.ndarray], labels: np.ndarray, size: int, rounds: int = 150, rate: float = 0.5, evidence: float = 1.5):
    """Weights by adaptive gradient steps with an L1 penalty of ``evidence`` documents; bias; leak.

    A leak, one probability for all documents, takes up labels that no sentence
    explains, so that a long text is not suspect for its many sentences.
    """
    y, n = labels.astype(np.float64), len(bags)
    start = np.concatenate([[0], np.cumsum(sentences)])
    sentence = np.concatenate([b[:, 0] + start[i] for i, b in enumerate(bags)])
    feature = np.concatenate([b[:, 1] for b in bags])
    w, seen = np.zeros(size), np.full(size, 1e-8)
    of = np.repeat(np.arange(n), sentences)
    free, free_seen = np.array([-8.0, np.log(y.mean() / 10)]), np.full(2, 1e-8)  # bias, leak
    for _ in range(rounds):
        z = np.clip(free[0] + np.bincount(sentence, w[feature], minlength=start[-1]), -30, 30)
        p, leak = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-free[1]))
        none = (1 - leak) * np.exp(np.bincount(of, np.log1p(-p), minlength=n))
        pull = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0) / n
        step = pull[of] * p
        slope = np.bincount(feature, step[sentence], minlength=size)
        seen += slope**2
        pace = rate / np.sqrt(seen)
        w -= pace * slope
        w = np.sign(w) * np.maximum(np.abs(w) - pace * evidence / n, 0)
        slope = np.array([step.sum(), (pull * leak).sum()])
        free_seen += slope**2
        free -= 0.3 * rate * slope / np.sqrt(free_seen)
    return w, float(free[0]), float(free[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit to the ``sample_rows`` labelled ids that come first by hash; a repeated id counts once, its larger label.

    Features that are not twice as common in documents of label 1 are left out at
    once.  Without both labels, or without such a feature, the model scores 0.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic"))
    texts = cut_lineage(texts.coalesce(TRAIN_TASKS))
    size = texts.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    weights = np.zeros(DIMENSIONS, np.float32)
    none = Model(weights, -30.0, -30.0)
    if not size["n"] or not 0 < size["t"] < size["n"]:
        return none
    counts = texts.mapInArrow(_counts, "feature bigint, docs bigint, marked bigint").groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("marked").alias("marked"))
    useful = counts.where((F.col("marked") >= 2) & (F.col("marked") >= F.col("docs") * (2 * size["t"] / size["n"])))
    useful = np.sort(useful.select("feature").toArrow().column(0).to_numpy())
    if not len(useful):
        return none
    shared = spark.sparkContext.broadcast(useful)
    kind = docs.schema[id_col].dataType.simpleString()
    bags = texts.mapInArrow(partial(_bags, shared), f"doc_id {kind}, toxic int, sentences bigint, bag binary").toArrow().sort_by("doc_id").combine_chunks()
    pairs = [np.frombuffer(b.as_buffer(), np.int32).reshape(-1, 2) for b in bags.column("bag")]
    w, bias, leak = fit(bags.column("sentences").to_numpy(), pairs, bags.column("toxic").to_numpy(), len(useful))
    weights[useful] = w
    return Model(weights, bias, leak)


def _scores(shared, extra, batches):
    model = shared.value
    for batch in batches:
        for row, data, offsets in textgrid.blocks(batch.column(1)):
            n = len(offsets) - 1
            first, last, owner, sentence, feature = features(data, offsets)
            pair = np.unique(sentence * DIMENSIONS + feature)
            z = model.bias + np.bincount(pair // DIMENSIONS, model.weights[pair % DIMENSIONS], minlength=len(first))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            score = 1 - np.exp(np.bincount(owner, np.log1p(-p), minlength=n)) / (1 + np.exp(model.leak))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            bad = np.flatnonzero(p >= 0.5)
            base = chars[offsets[owner[bad]]]
            spots = [[] for _ in range(n)]
            for i, s, e, q in zip(owner[bad].tolist(), (chars[first[bad]] - base).tolist(), (chars[last[bad]] - base).tolist(), p[bad].tolist(), strict=True):
                spots[i].append({"start": s, "end": e, "score": q})
            kept = {k: batch.column(k).slice(row, n) for k in extra}
            yield pa.record_batch({**kept, "score": score, "offending": pa.array(spots, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, score, offending`` a row, and the columns of ``keep``.

    ``offending``: code-point spans of the sentences whose own probability is a half
    or more.  Null, empty and wordless texts score near 0: they have no sentence, or only
    sentences without a feature.  Repeated rows are scored alike, a null id is kept.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col, *[c for c in keep if c != id_col]]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    source = docs.select(id_col, text_col, *[c for c in names if c not in (id_col, text_col)])
    return source.mapInArrow(partial(_scores, shared, names), f"{kinds}, score double, offending array<struct<start:bigint,end:bigint,score:double>>")


def held_out(id_col: str = "doc_id"):
    """Whether a row's label may not be learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))

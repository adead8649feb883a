"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds documents in blocks of similar size.  A block has a Bloom filter of the
terms of each document, stored by slices: one bitmap over the documents for each bit.  A
term that occurs twice, or four times, is entered again under another hash.  The slices of
a term, joined by *and*, mark every document that holds the term (and some more), so the
weights of the marked terms sum up to a bound that no score passes.  A document is
scored exactly, from its terms and their numbers, unless its bound is below the worst of
the best scores found so far.

Scores are integers; ``w * (10^9 tf div (1000 tf + 8 m))`` summed over the terms of a query,
with ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))`` and ``m = 25 + 75 n N div L``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from cellwise.llm import textgrid
from cellwise.session import cut_lineage, local_frame, ship_package

BLOCK_DOCS = 1024  # documents of a block
BLOCK_TERMS = 1 << 16  # terms of a block; a longer document is a block alone
HASHES = 3
BITS = 8  # of a filter for each term that it may hold
LEVELS = (1, 2, 4)  # a term is entered once for each of these numbers that it reaches
QUERY_TERMS = 4096  # different terms of the queries that are searched for in one pass
SALTS = 32

_BREAK = np.ones(256, bool)
_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_STEPS = textgrid.mix(np.arange(1, 1 + HASHES * len(LEVELS), dtype=np.uint64)).reshape(len(LEVELS), HASHES)


def term_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, bounds by row, hashes of the different terms in ascending order, their numbers."""
    for row, data, offsets in textgrid.blocks(column):
        data = textgrid.lower_ascii(data)
        starts, ends, owner = textgrid.spans(data, offsets, _BREAK)
        hashes = textgrid.span_hash(data, starts, ends)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(hashes)))
        bounds = np.searchsorted(owner[first], np.arange(len(offsets)))
        yield row, bounds, hashes[first], counts


def _positions(hashes: np.ndarray, level: int) -> list[np.ndarray]:
    """Where a term of a level is entered, to be reduced to the bits of a filter."""
    return [textgrid.mix(hashes ^ step) for step in _STEPS[level]]


def _slices(bounds: np.ndarray, hashes: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps over the documents, one a bit."""
    n = len(bounds) - 1
    table = np.zeros((bits, n), bool)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    for level, least in enumerate(LEVELS):
        at = np.flatnonzero(counts >= least)
        for position in _positions(hashes[at], level):
            table[(position & np.uint64(bits - 1)).astype(np.int64), owner[at]] = True
    return np.packbits(table, axis=1)


class _Gathered:
    """Documents of one size class that wait for their block."""

    def __init__(self):
        self.ids, self.hashes, self.counts, self.terms = [], [], [], 0

    def block(self, size: int, kind: pa.DataType) -> pa.RecordBatch:
        bounds = np.concatenate([[0], np.cumsum([len(h) for h in self.hashes])])
        hashes, counts = np.concatenate(self.hashes), np.concatenate(self.counts)
        bits = BITS << size
        words = np.add.reduceat(counts, bounds[:-1], dtype=np.int64)
        most = np.maximum.reduceat(counts, bounds[:-1])
        lists = [pa.array([x], pa.list_(k)) for x, k in ((self.ids, kind), (words, pa.int64()), (most, pa.int64()), (bounds, pa.int64()))]
        packed = [pa.array([x.tobytes()], pa.binary()) for x in (hashes, counts.astype("<u4"), _slices(bounds, hashes, counts, bits))]
        scalars = [pa.array([x], pa.int64()) for x in (bits, len(self.ids), int(words.sum()))]
        return pa.record_batch([*lists, *packed, *scalars], names=_COLUMNS)


_COLUMNS = ["ids", "words", "most", "bounds", "hashes", "counts", "slices", "bits", "n_docs", "n_words"]


def _indexed(batches):
    waiting: dict[int, _Gathered] = {}
    kind = None
    for batch in batches:
        ids, kind = batch.column(0), batch.column(0).type
        for row, bounds, hashes, counts in term_counts(batch.column(1)):
            names = ids.slice(row, len(bounds) - 1).to_pylist()
            entries = np.concatenate([[0], np.cumsum(sum((counts >= k).astype(np.int64) for k in LEVELS))])
            entries = entries[bounds[1:]] - entries[bounds[:-1]]
            for i in np.flatnonzero(entries).tolist():
                size = int(entries[i] - 1).bit_length()
                into = waiting.setdefault(size, _Gathered())
                into.ids.append(names[i])
                into.hashes.append(hashes[bounds[i] : bounds[i + 1]].copy())  # a view would hold its whole block of texts
                into.counts.append(counts[bounds[i] : bounds[i + 1]].astype(np.uint32))
                into.terms += int(bounds[i + 1] - bounds[i])
                if len(into.ids) >= BLOCK_DOCS or into.terms >= BLOCK_TERMS:
                    yield waiting.pop(size).block(size, kind)
    for size, into in waiting.items():
        yield into.block(size, kind)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index, written to the shared folder: one row a block.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
    lower-cased, known by a 64-bit hash.  Documents without a term are not in it; null ids
    and repeated rows are kept; other columns are not read; an empty table gives an empty index.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"ids array<{kind}>, words array<bigint>, most array<bigint>, bounds array<bigint>, hashes binary, counts binary,"
        " slices binary, bits bigint, n_docs bigint, n_words bigint"
    )
    return cut_lineage(docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(_indexed, schema))


@dataclass(frozen=True)
class Queries:
    """Queries of one pass: their different terms, and by query the positions and weights among these."""

    hashes: np.ndarray  # ascending
    terms: list[np.ndarray]  # of each query, ascending
    repeats: list[np.ndarray]  # how often a query has each of its terms


def _queries(texts: list[str | None]) -> Queries:
    found = [(b, h, c) for _, b, h, c in term_counts(pa.array(texts, pa.string()))]
    each = [(h[s:e], c[s:e]) for b, h, c in found for s, e in zip(b[:-1], b[1:], strict=True)]
    hashes = np.unique(np.concatenate([h for h, _ in each])) if each else np.zeros(0, np.uint64)
    return Queries(hashes, [np.searchsorted(hashes, h) for h, _ in each], [c for _, c in each])


def _holding(shared, batches):
    """Documents that hold each of the terms, counted by task."""
    terms = shared.value.hashes
    total = np.zeros(len(terms) + 1, np.int64)
    for batch in batches:
        for packed in batch.column(0) if len(terms) else ():
            hashes = np.frombuffer(packed.as_buffer(), "<u8")
            at = np.searchsorted(terms, hashes)
            at[at == len(terms)] = 0
            total[: len(terms)] += np.bincount(at[terms[at] == hashes], minlength=len(terms))
    seen = np.flatnonzero(total)
    yield pa.record_batch({"term": seen, "df": total[seen]})


def _impact(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class _Block:
    """A row of the index: bounds of all its documents for the queries' terms, exact scores of some."""

    def __init__(self, batch: pa.RecordBatch, i: int, n_docs: int, n_words: int):
        self.ids = batch.column("ids")[i].values
        words, most, self.bounds = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("words", "most", "bounds"))
        self.hashes, self.counts = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in (("hashes", "<u8"), ("counts", "<u4")))
        self.m = 25 + (75 * words * n_docs) // n_words
        self.size = len(words)
        bits = batch.column("bits")[i].as_py()
        self.slices = np.frombuffer(batch.column("slices")[i].as_buffer(), np.uint8).reshape(bits, -1)
        reach = [np.minimum(most, k - 1) for k in LEVELS[1:]] + [most]
        top = [_impact(r, self.m) for r in reach]
        self.gains = [top[0], *[b - a for a, b in zip(top, top[1:], strict=False)]]  # what each level adds at most

    def marks(self, places: list[list[np.ndarray]]) -> list[np.ndarray]:
        """For each level, terms by documents: bytes 0 and 1."""
        found, mask = [], np.uint64(len(self.slices) - 1)
        for level in places:
            maps = self.slices[(level[0] & mask).astype(np.int64)]
            for more in level[1:]:
                maps = maps & self.slices[(more & mask).astype(np.int64)]
            found.append(maps & found[-1] if found else maps)
        return [np.unpackbits(maps, axis=1, count=self.size) for maps in found]

    def most_possible(self, marks: list[np.ndarray], terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Bounds of the scores of all documents: weighted sums of the slices of each level."""
        own = weights.astype(np.float64)
        return sum((own @ level[terms]).astype(np.int64) * gain for level, gain in zip(marks, self.gains, strict=True))

    def scores(self, docs: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of some documents."""
        lengths = self.bounds[docs + 1] - self.bounds[docs]
        owner = np.repeat(np.arange(len(docs)), lengths)
        at = np.arange(len(owner)) + np.repeat(self.bounds[docs] - (np.cumsum(lengths) - lengths), lengths)
        own = self.hashes[at]
        term = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
        hit = np.flatnonzero(hashes[term] == own)
        owner, term, counts = owner[hit], term[hit], self.counts[at[hit]].astype(np.int64)
        total = np.zeros(len(docs), np.int64)
        np.add.at(total, owner, weights[term] * _impact(counts, self.m[docs[owner]]))
        return total


def _order(entry):
    score, doc = entry
    return -score, doc is None, 0 if doc is None else doc


def _best(shared, kind, k: int, batches):
    """The ``k`` best documents of each query among those of a task."""
    queries, weights, n_docs, n_words = shared.value
    places = [_positions(queries.hashes, level) for level in range(len(LEVELS))]
    best: list[list] = [[] for _ in queries.terms]
    for batch in batches:
        for i in range(batch.num_rows):
            block = _Block(batch, i, n_docs, n_words)
            marks = block.marks(places)
            for held, terms, own in zip(best, queries.terms, weights, strict=True):
                if not len(terms):
                    continue
                bound = block.most_possible(marks, terms, own)
                left = np.flatnonzero(bound > 0)
                left = left[np.argsort(-bound[left], kind="stable")]
                hashes, at, step = queries.hashes[terms], 0, 2 * k
                while at < len(left):
                    least = held[k - 1][0] if len(held) >= k else 1
                    some = left[at : at + step]
                    some = some[bound[some] >= least]
                    if not len(some):
                        break  # bounds fall from here on
                    at, step = at + step, 8 * step
                    score = block.scores(some, hashes, own)
                    good = score >= least
                    held += [(s, block.ids[d].as_py()) for s, d in zip(score[good].tolist(), some[good].tolist(), strict=True)]
                    held.sort(key=_order)
                    del held[k:]
    rows = [(q, d, s) for q, held in enumerate(best) for s, d in held]
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), kind, pa.int64()), strict=True)], names=["query", "doc_id", "score"])


def _top(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(index: DataFrame, items: list, id_type, size, k: int) -> DataFrame:
    spark = index.sparkSession
    queries = _queries([text for _, text in items])
    shared = spark.sparkContext.broadcast(queries)
    counts = index.select("hashes").mapInArrow(partial(_holding, shared), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(queries.hashes), np.int64)
    for row in counts.collect():  # at most one row a term of the queries
        df[row["term"]] = row["df"]
    n_docs, n_words = size["n"] or 0, size["words"] or 1
    rare = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)
    weights = [rare[t] * r for t, r in zip(queries.terms, queries.repeats, strict=True)]
    given = spark.sparkContext.broadcast((queries, weights, n_docs, n_words))
    kind = index.schema["ids"].dataType.elementType
    found = index.mapInArrow(partial(_best, given, to_arrow_type(kind), k), f"query bigint, doc_id {kind.simpleString()}, score bigint")
    found = _top(found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), k, "query", "salt").drop("rank", "salt")
    names = local_frame(spark, [(q, i) for q, (i, _) in enumerate(items)], f"query bigint, item_id {id_type.simpleString()}")
    ranked = _top(found, k, "query").join(F.broadcast(names), "query")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for each item.

    Equal scores go by ascending document id, null last.  Items are searched for in
    groups of up to ``QUERY_TERMS`` different terms, one pass over the index each.  Null texts
    and texts without a known term have no result; each row of ``items`` is an item
    of its own; null item ids are kept; an empty table gives no rows.
    """
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("words")).first()
    id_type = items.schema[id_col].dataType
    groups, terms = [[]], set()
    for row in items.select(F.col(id_col), F.col(text_col).cast("string")).toLocalIterator():
        more = {h for _, _, hashes, _ in term_counts(pa.array([row[1]], pa.string())) for h in hashes.tolist()}
        if groups[-1] and len(terms | more) > QUERY_TERMS:
            groups.append([])
            terms = set()
        groups[-1].append((row[0], row[1]))
        terms |= more
    found = [_search(index, group, id_type, size, k) for group in groups]
    return reduce(DataFrame.unionByName, found)

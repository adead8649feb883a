"""N-gram Jaccard join: an R-tree over counts of hashed shingles, built per rare shingle.

A document is the set of its distinct word shingles.  Hashing shingles into
``GROUPS`` groups makes it a point of group counts, and the sum over groups of the
smaller count bounds the overlap of two documents from above.

Why the tree is not built over all points at once: the counts of unrelated documents
differ only by noise of about sqrt(n / groups) a coordinate, while partners may
differ by 0.11 (n + m) in sum, so boxes of a tree over everything overlap and a
search would visit all leaves.  Partners do share one of their first
``n - ceil(0.8 n) + 1`` shingles in any common order, so there is one tree for
each such shingle.  The order puts shingles of many documents last.

1. :func:`describe`   size, signature and point of each document; frequent shingles
2. :func:`members`    first shingles of each distinct set, those of one set dropped
3. first links        the smallest set and the next smaller one under a shingle, if the
                      points allow it, verified exactly
4. :func:`tree_pairs` leaves of the trees, boxes joined by bound, points of surviving
                      leaves compared; only between documents not yet connected, and
                      only under the first shingle that two sets share
5. verification on whole sets, connected components; pairs of long sets, whose counts in
   ``GROUPS`` groups are all alike, are first bounded by fine points

No step lists the pairs of a group: copies are one point, and a family that the first
links have connected is not compared with itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellwise.llm import textgrid
from cellwise.llm.graph import components
from cellwise.session import cut_lineage, ensure_checkpoint_dir, ship_package
from cellwise.sources.buckets import write_bucketed

SHINGLE = 5
PERCENT = 80
GROUPS = 256
LONG = 1000  # sets of more shingles also have a fine point, with at least as many groups as shingles
LEAF = 256  # points of one leaf
KNOWN = 8  # tokens that a row in a cell has of its set; fewer give pairs more often, never other ones
FREQUENT = 64  # a shingle counted in so many documents goes to the end of the order ...
MAX_FREQUENT = 100_000  # ... the most frequent ones of them; the order changes cost, never results


def needed_overlap(n, m, percent: int = PERCENT):
    """Smallest intersection of sets of ``n`` and ``m`` elements that links them."""
    return -((-percent * (n + m)) // (100 + percent))


def sets_of(column: pa.Array, width: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, sorted distinct shingle hashes, offsets by row."""
    for row, data, offsets in textgrid.blocks(column):
        data = textgrid.lower_ascii(data)
        starts, ends, owner = textgrid.spans(data, offsets)
        words = textgrid.span_hash(data, starts, ends)
        n_docs = len(offsets) - 1
        counts = np.bincount(owner, minlength=n_docs)
        factors = textgrid.mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
        first = np.concatenate([[0], np.cumsum(counts)])
        left = first[owner + 1] - np.arange(len(words))  # words from here to the end of the document
        total = np.zeros(len(words), np.uint64)
        for k in range(width):
            reach = left > k
            at = np.flatnonzero(reach) + k
            total[reach] += words[at] * factors[k]
        whole = counts[owner] < width  # the sequence as one shingle, taken at its first word
        keep = (left >= width) | (whole & (left == counts[owner]))
        total = textgrid.mix(total + np.minimum(counts[owner], width).astype(np.uint64))[keep]
        owner = owner[keep]
        order = np.lexsort((total, owner))
        total, owner = total[order], owner[order]
        fresh = np.ones(len(total), bool)
        fresh[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
        total, owner = total[fresh], owner[fresh]
        yield row, total, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))])


def signatures(total: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash a set, whatever its order; 0 for the empty set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textgrid.mix(total ^ np.uint64(0x5851F42D4C957F2D)))])
    sizes = np.diff(bounds)
    return np.where(sizes > 0, textgrid.mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64)), np.uint64(0))


def points(total: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Group counts, one row a set; 255 stands for 255 or more."""
    n = len(bounds) - 1
    cell = np.repeat(np.arange(n), np.diff(bounds)) * GROUPS + (total % np.uint64(GROUPS)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=n * GROUPS), 255).astype(np.uint8).reshape(n, GROUPS)


def _shrunk(counts: np.ndarray) -> bytes:
    raw = counts.tobytes()
    return min(raw, pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True), key=len)


def _counts(point: bytes, groups: int) -> bytes:
    return point if len(point) == groups else pa.Codec("zstd").decompress(point, groups, asbytes=True)


def fine_point(total: np.ndarray) -> np.ndarray | None:
    """Counts in as many groups as there are shingles, rounded up to a power of two; null if one is 255 or more."""
    groups = 1 << (len(total) - 1).bit_length()
    counts = np.bincount((total % np.uint64(groups)).astype(np.int64), minlength=groups)
    return counts.astype(np.uint8) if counts.max() < 255 else None


def fine_bound(a: np.ndarray, b: np.ndarray) -> int:
    """Upper bound of the overlap of two sets from their fine points; the longer one is folded to the groups of the other."""
    a, b = sorted((a.astype(np.int64), b.astype(np.int64)), key=len)
    return int(np.minimum(a, b.reshape(-1, len(a)).sum(axis=0)).sum())


def _describe(width: int, batches):
    for batch in batches:
        ids = batch.column(0)
        for row, total, bounds in sets_of(batch.column(1), width):
            n = len(bounds) - 1
            vectors = points(total, bounds)
            yield pa.record_batch({
                "doc_id": ids.slice(row, n), "sig": textgrid.as_long(signatures(total, bounds)),
                "n": np.diff(bounds), "point": pa.array([_shrunk(v) for v in vectors], pa.binary()),
                "token": pa.nulls(n, pa.int64()), "docs": pa.nulls(n, pa.int64()),
            })
            token, docs = np.unique(total, return_counts=True)
            token, docs = token[docs > 1], docs[docs > 1]
            none = {k: pa.nulls(len(token), t) for k, t in (("doc_id", ids.type), ("sig", pa.int64()), ("n", pa.int64()), ("point", pa.binary()))}
            yield pa.record_batch({**none, "token": textgrid.as_long(token), "docs": docs})


def describe(docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE) -> DataFrame:
    """Per document ``doc_id, sig, n, point``; with null ``n``, counts ``token, docs`` of repeated shingles."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, sig bigint, n bigint, point binary, token bigint, docs bigint"
    return docs.select(id_col, text_col).mapInArrow(partial(_describe, width), schema)


def frequent_shingles(described: DataFrame) -> np.ndarray:
    """The shingles that go last: at most MAX_FREQUENT, so 800 kB to each task."""
    counts = described.where("token is not null").groupBy("token").agg(F.sum("docs").alias("docs"))
    top = counts.where(F.col("docs") >= FREQUENT).orderBy(F.desc("docs"), "token").limit(MAX_FREQUENT)
    tokens = top.select("token").toArrow().column(0).to_numpy().astype(np.int64)
    return np.sort(tokens.view(np.uint64))


def _first_shingles(width: int, percent: int, frequent, batches):
    last = frequent.value
    seen: set[int] = set()
    for batch in batches:
        for _, total, bounds in sets_of(batch.column(0), width):
            sig, sizes = signatures(total, bounds), np.diff(bounds)
            hot = np.zeros(len(total), bool)
            if len(last) and len(total):
                hot = last[np.minimum(np.searchsorted(last, total), len(last) - 1)] == total
            tokens, sigs, ns = [], [], []
            for i in range(len(sizes)):
                n, own = int(sizes[i]), int(sig[i])
                if not n or own in seen:
                    continue
                seen.add(own)
                mine, is_hot = total[bounds[i] : bounds[i + 1]], hot[bounds[i] : bounds[i + 1]]
                length = n - -(-percent * n // 100) + 1
                rare = mine[~is_hot][:length]
                if len(rare) < length:
                    rare = np.concatenate([rare, mine[is_hot][: length - len(rare)]])
                tokens.append(rare)
                sigs.append(sig[i])
                ns.append(n)
            if tokens:
                lengths = [len(t) for t in tokens]
                yield pa.record_batch({
                    "token": textgrid.as_long(np.concatenate(tokens)),
                    "sig": textgrid.as_long(np.repeat(np.array(sigs, np.uint64), lengths)),
                    "n": np.repeat(np.array(ns, np.int64), lengths).astype(np.int32),
                })


GROUPED = "token bigint, sig bigint, n int, before bigint, before_n int, first bigint, first_n int"


def _grouped(batches):
    """Rows sorted by token, n, sig: those whose token has another set, with the set before and the first one.

    The last row is held back until the next one shows whether its token goes on; the
    first set of an open token is carried along.  Nothing else is kept.
    """
    held = None  # token, sig, n, before, before_n, first, first_n of the last row; before is 0 for a first row
    for batch in _with_end(batches):
        if batch is None:
            token = np.zeros(0, np.int64)
        else:
            token, sig, n = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
        if held is not None and len(token):
            token, sig, n = (np.concatenate([[h], x]) for h, x in zip(held[:3], (token, sig, n), strict=True))
        elif held is not None:
            if batch is None and held[7]:
                yield _grouped_rows([np.array([h]) for h in held[:7]], np.array([True]))
            continue
        if not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])
        token, sig, n = token[new], sig[new], n[new]
        later = np.zeros(len(token), bool)  # not the first row of its token
        later[1:] = token[1:] == token[:-1]
        lead = np.maximum.accumulate(np.where(later, 0, np.arange(len(token))))
        columns = [token, sig, n, np.roll(sig, 1), np.roll(n, 1), sig[lead], n[lead]]
        if held is not None and held[7]:
            later[0] = True
            own = token == token[0]
            for i in (3, 4):
                columns[i][0] = held[i]
            for i in (5, 6):
                columns[i] = np.where(own, held[i], columns[i])
        joined = later.copy()
        joined[:-1] |= later[1:]
        yield _grouped_rows([c[:-1][joined[:-1]] for c in columns], later[:-1][joined[:-1]])
        held = (*[int(c[-1]) for c in columns], bool(later[-1]))


def _grouped_rows(columns, later):
    token, sig, n, before, before_n, first, first_n = columns
    none = ~later
    return pa.record_batch({
        "token": token, "sig": sig, "n": n.astype(np.int32),
        "before": pa.array(before, mask=none), "before_n": pa.array(before_n.astype(np.int32), mask=none),
        "first": pa.array(first, mask=none), "first_n": pa.array(first_n.astype(np.int32), mask=none),
    })


def members(docs: DataFrame, text_col: str, frequent: np.ndarray, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Distinct sets under a first shingle that another set shares, with two others of it (``GROUPED``)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    rows = docs.select(text_col).mapInArrow(partial(_first_shingles, width, percent, shared), "token bigint, sig bigint, n int")
    rows = rows.repartition("token").sortWithinPartitions("token", "n", "sig")
    return rows.mapInArrow(_grouped, GROUPED)


def _packed(width: int, batches):
    seen: set[int] = set()
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        texts = batch.column(0)
        for row, total, bounds in sets_of(texts, width):
            sig = textgrid.as_long(signatures(total, bounds))
            keep = [i for i, k in enumerate(np.asarray(sig).tolist()) if bounds[i] < bounds[i + 1] and k not in seen and not seen.add(k)]
            for at in range(0, len(keep), 1000):
                some = keep[at : at + 1000]
                raw = [texts[row + i].as_buffer() for i in some]
                packed = pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary())
                ns = np.diff(bounds)[some]
                points_ = [fine_point(total[bounds[i] : bounds[i + 1]]) if n > LONG else None for i, n in zip(some, ns.tolist(), strict=True)]
                fine = pa.array([None if f is None else _shrunk(f) for f in points_], pa.binary())
                yield pa.record_batch({"sig": np.asarray(sig)[some], "n": ns, "fine": fine, "size": np.array([r.size for r in raw], np.int64), "packed": packed})


def packed_texts(docs: DataFrame, text_col: str, wanted: DataFrame, table: str, width: int = SHINGLE) -> DataFrame:
    """``sig, n, fine, size, packed``: one compressed text, and the fine point if it is long, of each set in ``wanted`` (``sig``, each once), stored in buckets by ``sig``.

    Texts are dealt once, by their set; every search for partners' texts then joins them where they lie.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.where(F.col(text_col).isNotNull()).select(text_col)
    dealt = texts.mapInArrow(partial(_packed, width), "sig bigint, n bigint, fine binary, size bigint, packed binary").repartition(buckets, "sig")
    found = dealt.join(wanted.hint("merge"), "sig", "left_semi").groupBy("sig").agg(F.any_value(F.struct("n", "fine", "size", "packed")).alias("x"))
    path = f"{ensure_checkpoint_dir(spark)}/{table}"
    return write_bucketed(found.select("sig", "x.*"), table, buckets, "sig", path, dealt=True)


def _points_of(sized: DataFrame, grouped: DataFrame) -> DataFrame:
    """``sig, n, point`` of each set that shares a first shingle."""
    found = sized.select("sig", "n", "point").join(grouped.select("sig").distinct().hint("merge"), "sig")
    return found.groupBy("sig").agg(F.any_value(F.struct("n", "point")).alias("x")).select("sig", "x.*")


def neighbours(grouped: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct pairs ``a, b``: each set with the smallest and the next smaller one of a shingle, if sizes allow."""
    near = F.array(F.struct(F.col("before").alias("y"), F.col("before_n").alias("m")), F.struct(F.col("first").alias("y"), F.col("first_n").alias("m")))
    pairs = grouped.select("sig", "n", F.explode(near).alias("x")).where(f"x.y is not null and x.y <> sig and 100 * x.m >= {percent} * n")
    return pairs.select(F.least("sig", "x.y").alias("a"), F.greatest("sig", "x.y").alias("b")).distinct()


def _pairs_in_bound(percent: int, batches):
    for batch in batches:
        n, m = (batch.column(c).to_numpy() for c in ("an", "bn"))
        near = np.flatnonzero(100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        batch, n, m = batch.take(pa.array(near)), n[near], m[near]
        x, y = (_stacked(batch.column(c)) for c in ("ap", "bp"))
        good = pa.array(_bound(x, y, np.minimum(n, m)) >= needed_overlap(n, m, percent))
        yield pa.record_batch({c: batch.column(c).filter(good) for c in ("a", "b")})


def within_bound(pairs: DataFrame, point_of: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that sizes and points allow to be linked."""
    for side in ("a", "b"):
        points_ = point_of.select(F.col("sig").alias(side), F.col("n").alias(f"{side}n"), F.col("point").alias(f"{side}p"))
        pairs = pairs.join(points_.hint("merge"), side)
    return pairs.select("a", "b", "an", "bn", "ap", "bp").mapInArrow(partial(_pairs_in_bound, percent), "a bigint, b bigint")


def _linked(percent: int, width: int, batches):
    codec = pa.Codec("zstd")
    for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
        rows = batch.to_pydict()
        sizes = {}
        for i in range(batch.num_rows):
            sizes.setdefault(rows["a"][i], (rows["a_size"][i], rows["a_packed"][i]))
            sizes.setdefault(rows["b"][i], (rows["b_size"][i], rows["b_packed"][i]))
        names, sets = list(sizes), {}
        for at in range(0, len(names), 128):
            part = names[at : at + 128]
            raw = [codec.decompress(sizes[s][1], sizes[s][0], asbytes=True) for s in part]
            for row, total, bounds in sets_of(pa.array(raw, pa.binary()), width):
                for i in range(len(bounds) - 1):
                    sets[part[row + i]] = total[bounds[i] : bounds[i + 1]]
        good = np.zeros(batch.num_rows, bool)
        for i, (a, b) in enumerate(zip(rows["a"], rows["b"], strict=True)):
            x, y = sets[a], sets[b]
            if len(x) > len(y):
                x, y = y, x
            both = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))
            good[i] = 100 * both >= percent * (len(x) + len(y) - both)
        yield pa.record_batch({c: batch.column(c).filter(pa.array(good)) for c in ("a", "b")})


def _pairs_in_fine_bound(percent: int, batches):
    def counts(n, fine):
        return np.frombuffer(_counts(fine, 1 << (n - 1).bit_length()), np.uint8)

    for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
        rows = zip(*(batch.column(c).to_pylist() for c in ("an", "bn", "af", "bf")), strict=True)
        good = [x is None or y is None or fine_bound(counts(n, x), counts(m, y)) >= needed_overlap(n, m, percent) for n, m, x, y in rows]
        yield pa.record_batch({c: batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")})


def within_fine_bound(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that the fine points of long sets allow to be linked; pairs with a shorter set are all kept."""
    for side in ("a", "b"):
        own = texts.select(F.col("sig").alias(side), F.col("n").alias(f"{side}n"), F.col("fine").alias(f"{side}f"))
        pairs = pairs.join(own.hint("merge"), side)
    return pairs.select("a", "b", "an", "bn", "af", "bf").mapInArrow(partial(_pairs_in_fine_bound, percent), "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """The pairs ``a, b`` whose whole sets reach the similarity."""
    for side in ("a", "b"):
        own = texts.select(F.col("sig").alias(side), F.col("size").alias(f"{side}_size"), F.col("packed").alias(f"{side}_packed"))
        pairs = pairs.join(own.hint("merge"), side)
    kept = pairs.select("a", "b", "a_size", "b_size", "a_packed", "b_packed")
    return kept.mapInArrow(partial(_linked, percent, width), "a bigint, b bigint")


def _stacked(column) -> np.ndarray:
    rows = [_counts(p, GROUPS) for p in column.to_pylist()]
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1 if rows else GROUPS)


def _boxes(key, rows):
    top = np.max(_stacked(pa.array(rows["point"], pa.binary())), axis=0)
    rows = rows.iloc[:1].assign(
        least=int(rows["n"].min()), most=int(rows["n"].max()), corner=[_shrunk(top)],
        one=rows["root"].iloc[0] if rows["root"].nunique() == 1 else None,
    )
    return rows[["token", "leaf", "least", "most", "one", "corner"]].astype({"one": "Int64"})


def _bound(a, b, most):
    """Upper bounds of the overlap, from arrays of points and the most elements that the smaller sets have.

    A group that is full in both points may hold any number, so it counts as ``most``.
    """
    both = np.minimum(a, b)
    known = both.sum(axis=1, dtype=np.int64)
    return np.where((both == 255).any(axis=1), most, np.minimum(known, most))


def _box_pairs(percent: int, batches):
    for batch in batches:
        corner = [_stacked(batch.column(c)) for c in ("corner", "corner2")]
        n, m, most, most2 = (batch.column(c).to_numpy() for c in ("least", "least2", "most", "most2"))
        good = pa.array(_bound(*corner, np.minimum(most, most2)) >= needed_overlap(n, m, percent))
        yield pa.record_batch({k: batch.column(k).filter(good) for k in ("token", "leaf", "leaf2")})


def _leaf_pairs(percent: int, batches):
    """Rows sorted by cell: pairs of points of different components whose bound allows a link.

    Compares each row with the one ``step`` rows on, for all cells of a batch at once.
    A cell that goes on in the next batch is held back; it has two leaves at most.
    A pair is left to an earlier shingle if both sets are known to have that one.
    """
    rest = None
    for batch in _with_end(batches):
        if batch is not None:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            if not rest.num_rows:
                continue
            cell = rest.column("cell").to_numpy()
            done = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if cell[0] != cell[-1] else 0
            part, rest = rest.slice(0, done), rest.slice(done)
        else:
            part, rest = rest, None
        if part is None or part.num_rows < 2:
            continue
        columns = ("cell", "sig", "root", "n", "leaf", "home", "token")
        cell, sig, root, n, side, home, token = (part.column(c).to_numpy(zero_copy_only=False) for c in columns)
        point, owned = _stacked(part.column("point")), _Owned(part.column("owned"), token)
        step, last = 1, np.flatnonzero(np.concatenate([cell[1:] != cell[:-1], [True]]))
        size = int(np.diff(np.concatenate([[-1], last])).max())
        while step < size:
            i = np.flatnonzero((cell[:-step] == cell[step:]) & (root[:-step] != root[step:]))
            j = i + step
            i, j = (x[home[i] | (side[i] != side[j])] for x in (i, j)) if len(i) else (i, j)
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            near = 100 * low >= percent * high
            i, j = i[near], j[near]
            step += 1
            if not len(i):
                continue
            good = _bound(point[i], point[j], np.minimum(n[i], n[j])) >= needed_overlap(n[i], n[j], percent)
            near = owned.first(i, j, good)
            i, j = i[near], j[near]
            if len(i):
                yield pa.record_batch({"a": np.minimum(sig[i], sig[j]), "b": np.maximum(sig[i], sig[j])})


class _Owned:
    """The least tokens that the sets of a batch have; each row's are made a set when it is first asked for."""

    def __init__(self, column: pa.Array, token: np.ndarray):
        self.offsets, self.values = column.offsets.to_numpy(), column.values.to_numpy()
        self.token, self.sets = token.tolist(), {}

    def of(self, row: int) -> set[int]:
        if row not in self.sets:
            self.sets[row] = set(self.values[self.offsets[row] : self.offsets[row + 1]].tolist())
        return self.sets[row]

    def first(self, a: np.ndarray, b: np.ndarray, good: np.ndarray) -> np.ndarray:
        """The good pairs of which no token before their own is known to be in both sets."""
        at = np.flatnonzero(good)
        keep = [min(self.of(i) & self.of(j), default=self.token[i]) >= self.token[i] for i, j in zip(a[at].tolist(), b[at].tolist(), strict=True)]
        return at[np.array(keep, bool)]


def _with_end(batches):
    yield from batches
    yield None


def _with_partners(rows: DataFrame, percent: int) -> DataFrame:
    """The rows whose token has a set of another component and a fitting size.

    In the order of sizes, the next set of another component stands before or after the
    run of sets of the same one.
    """
    order = Window.partitionBy("token").orderBy("n", "sig")
    before, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    marked = rows.withColumns({
        "smaller": F.when(F.lag("root").over(order) != F.col("root"), F.lag("n").over(order)),
        "larger": F.when(F.lead("root").over(order) != F.col("root"), F.lead("n").over(order)),
    })
    found = marked.withColumns({"smaller": F.last("smaller", True).over(before), "larger": F.first("larger", True).over(after)})
    fits = (100 * F.col("smaller") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("larger"))
    return found.where(fits).drop("smaller", "larger")


def tree_pairs(grouped: DataFrame, point_of: DataFrame, roots: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs ``a, b`` that share a shingle, of different components, that the points can't rule out; each once.

    The points of a shingle are cut into leaves of ``LEAF``, ordered by component and
    size; leaves get boxes (upper corner, size range), and pairs of leaves that pass
    the bound become cells.  A shingle whose sets are all connected is left out, and one
    of up to three sets, all pairs of which the first links have tried.
    """
    rows = grouped.select("token", "sig", "n").join(roots.hint("merge"), F.col("sig") == F.col("node"), "left")
    rows = rows.select("token", "sig", "n", F.coalesce("root", "sig").alias("root"))
    own = Window.partitionBy("token")  # dealt as for the partners, so that rows move by token once
    mixed = rows.withColumns({"lo": F.min("root").over(own), "hi": F.max("root").over(own), "c": F.count("*").over(own)})
    rows = _with_partners(mixed.where("lo <> hi and c > 3").drop("lo", "hi", "c"), percent)
    rank = F.row_number().over(Window.partitionBy("token").orderBy("root", "n", "sig"))
    rows = cut_lineage(rows.withColumn("leaf", ((rank - 1) / LEAF).cast("int")))
    owned = rows.groupBy("sig").agg(F.slice(F.sort_array(F.collect_list("token")), 1, KNOWN).alias("owned"))
    known = cut_lineage(point_of.select("sig", "point").join(owned.hint("merge"), "sig"))
    split = rows.where("leaf > 0").select("token").distinct()
    box_kind = "token bigint, leaf int, least bigint, most bigint, one bigint, corner binary"
    boxes = rows.join(split, "token").join(known.select("sig", "point").hint("merge"), "sig")
    boxes = cut_lineage(boxes.select("token", "leaf", "n", "root", "point").groupBy("token", "leaf").applyInPandas(_boxes, box_kind))
    other = boxes.select("token", *[F.col(c).alias(f"{c}2") for c in ("leaf", "least", "most", "one", "corner")])
    met = boxes.join(other, "token").where(
        f"leaf < leaf2 and 100 * most >= {percent} * least2 and 100 * most2 >= {percent} * least and not (one <=> one2 and one is not null)"
    )
    kept = met.select("token", "leaf", "leaf2", "least", "least2", "most", "most2", "corner", "corner2").mapInArrow(partial(_box_pairs, percent), "token bigint, leaf int, leaf2 int")
    apart = kept.select("token", F.explode(F.array("leaf", "leaf2")).alias("leaf"), F.xxhash64("token", "leaf", "leaf2").alias("cell"))
    columns = ["cell", "leaf", "sig", "root", "n", "home", "token"]
    at_home = rows.withColumns({"cell": F.xxhash64("token", "leaf"), "home": F.lit(True)}).select(*columns)
    across = rows.join(apart, ["token", "leaf"]).withColumn("home", F.lit(False)).select(*columns)
    # points join last and only once: they are most of a row; of the known tokens, those before the row's own are asked for
    cells = at_home.union(across).join(known.hint("merge"), "sig").withColumn("owned", F.filter("owned", lambda x: x < F.col("token")))
    cells = cells.repartition("cell").sortWithinPartitions("cell", "leaf", "root", "n", "sig")
    return cells.mapInArrow(partial(_leaf_pairs, percent), "a bigint, b bigint").distinct()


def set_classes(docs: DataFrame, id_col: str, text_col: str, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """One row a document: ``doc_id, n, sig, class``; linked sets have the same class, documents without shingles ``n = 0``."""
    ship_package(docs.sparkSession)
    described = cut_lineage(describe(docs, id_col, text_col, width))
    frequent = frequent_shingles(described)
    sized = described.where("n is not null")
    grouped = cut_lineage(members(docs, text_col, frequent, width, percent))
    point_of = cut_lineage(_points_of(sized, grouped))
    table = f"texts_{uuid.uuid4().hex}"
    texts = packed_texts(docs, text_col, point_of.select("sig"), table, width)
    try:
        tried = cut_lineage(within_bound(neighbours(grouped, percent), point_of, percent))
        roots = components(verified(within_fine_bound(tried, texts, percent), texts, percent, width))
        met = tree_pairs(grouped, point_of, roots, percent).join(tried.hint("merge"), ["a", "b"], "left_anti")
        roots = components(roots.toDF("a", "b").union(verified(within_fine_bound(met, texts, percent), texts, percent, width)))
    finally:
        docs.sparkSession.sql(f"drop table if exists {table}")
    return sized.join(roots, F.col("sig") == F.col("node"), "left").select("doc_id", "n", "sig", F.coalesce("root", "sig").alias("class"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """One row a document: ``doc_id, n_shingles, component_id``.

    Two documents are linked when their sets of ``width``-word shingles have
    ``100 * intersection >= percent * union``; the component id is the smallest id
    that links reach.  Words are runs of bytes outside ASCII white space, A-Z lower-cased.
    A text of fewer words is one shingle; null, empty and blank texts have none, are
    linked with nothing and keep their own id.  Repeated rows stay rows of one
    component; a null id never is a component id unless it stands alone.  Other
    columns are not read.  An empty table gives no rows.
    """
    classes = set_classes(docs, id_col, text_col, percent, width)
    least = classes.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    named = classes.where("n > 0").join(least, "class").select("doc_id", "n", "component_id")
    alone = classes.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return named.union(alone).select(F.col("doc_id"), F.col("n").alias("n_shingles"), "component_id")

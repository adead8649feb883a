"""Repeated substrings of all texts, by names of sampled positions.

The plan is that of suffix sorting with a difference cover: sample positions such that any
two equal stretches hold samples at a common distance from their starts, sort the
samples by what follows them, name them, and place all other positions by what stands
between them and the next sample, and its name.  Two things differ, because sorting
two thirds of all suffixes would move more than 20 bytes for each byte of text:

* The cover follows the content: of ``COVER`` consecutive positions, the one with the
  smallest hash of its ``CORE`` bytes is sampled.  Equal stretches of ``LENGTH =
  COVER + CORE - 1`` bytes hold the same sample, so one position in 69 is enough
  where a cover by residues needs one in eleven or more.
* A name is a fingerprint, not a rank, since only equality counts.  Names recurse once:
  a sample's core has a name, and so has the stretch of all strings that
  belong to the sample.  Where stretches agree, their strings need no further look;
  where a core occurs once, none of its strings can repeat.

Only strings of samples whose core repeats in other surroundings are merged: sorted
by name and distance to the sample, and compared with their neighbours byte by byte.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellwise.llm import textgrid
from cellwise.session import cut_lineage, ship_package

LENGTH = 200
CORE = 64
PART = 1 << 19  # longer texts are sampled in parts that overlap by LENGTH - 1 bytes
GROUP = 20_000  # stretches of one name that a task compares at once; more go through a shuffle

_SAMPLE = "name bigint, stretch bigint, text_key bigint, sample bigint, first bigint, last bigint"


def _parts(data: np.ndarray, offsets: np.ndarray, length: int):
    """Bytes, row bounds, row and base of each: all rows at once, or long rows alone, in overlapping parts."""
    sizes = np.diff(offsets)
    if not len(sizes) or sizes.max() <= PART:
        yield data, offsets, np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
        return
    for i, size in enumerate(sizes.tolist()):
        for base in range(0, max(size - length + 1, 1), PART):
            piece = data[offsets[i] + base : offsets[i] + min(size, base + PART + length - 1)]
            yield piece, np.array([0, len(piece)]), np.array([i]), np.array([base])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by running minima of blocks from both sides."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def samples(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, core: int = CORE):
    """Sampled positions with the range of string starts that belong to each: row, sample, first, last, name, stretch."""
    parts = [_samples(*part, length, core) for part in _parts(data, offsets, length)]
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _samples(data, offsets, rows, bases, length: int, core: int):
    cover = length - core + 1
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    sums, scale = textgrid.prefix_hash(data)
    n = len(data) - core + 1
    names = textgrid.mix((sums[core:] - sums[:-core]) * scale[:n])
    low = np.uint64((1 << 24) - 1)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[:n]
    inside = np.arange(n, dtype=np.uint64)
    inside -= np.repeat(offsets[:-1], sizes)[:n].astype(np.uint64)
    inside &= low
    inside |= names & ~low
    least = _least(inside, cover)
    del inside
    starts = np.flatnonzero(np.arange(length, len(least) + length) <= offsets[1:][row[: len(least)]])
    row = row[starts]
    sample = offsets[row] + (least[starts] & low).astype(np.int64)
    del least
    new = np.ones(len(starts), bool)
    new[1:] = (sample[1:] != sample[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1 if len(first) else first
    sample, begin, end, row = sample[first], starts[first], starts[last], row[first]
    whole = (sums[end + length] - sums[begin]) * scale[begin]
    stretch = textgrid.mix(whole + textgrid.mix((sample - begin).astype(np.uint64)) + (end - begin).astype(np.uint64))
    base = bases[row] - offsets[row]
    return rows[row], sample + base, begin + base, end + base, names[sample], stretch


def _sampled(length: int, core: int, batches):
    seen: set[int] = set()
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for at, data, offsets in textgrid.blocks(batch.column(1)):
            row, sample, first, last, name, stretch = samples(data, offsets, length, core)
            fresh = np.array([k not in seen and not seen.add(k) for k in keys[at : at + len(offsets) - 1].tolist()], bool)
            keep = fresh[row]
            yield pa.record_batch({
                "name": textgrid.as_long(name[keep]), "stretch": textgrid.as_long(stretch[keep]), "text_key": keys[at + row[keep]],
                "sample": sample[keep], "first": first[keep], "last": last[keep],
            })


def _packed(batches):
    seen: set[int] = set()
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        keep = [i for i, k in enumerate(batch.column(0).to_pylist()) if k not in seen and not seen.add(k)]
        for at in range(0, len(keep), 1000):
            part = batch.take(pa.array(keep[at : at + 1000], pa.int64()))
            raw = [t.as_buffer() for t in part.column(1)]
            yield pa.record_batch({"text_key": part.column(0), "size": np.array([r.size for r in raw], np.int64), "packed": pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary())})


def _stretches(length: int, batches):
    codec = pa.Codec("zstd")
    kind = pa.schema([("name", pa.int64()), ("text_key", pa.int64()), ("first", pa.int64()), ("ahead", pa.int64()), ("bytes", pa.binary())])
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            rows = []
            for key, size, packed, parts in zip(*batch.slice(at, 100).to_pydict().values(), strict=True):
                text = codec.decompress(packed, size, asbytes=True)
                rows += [(p["name"], key, p["first"], p["sample"] - p["first"], text[p["first"] : p["last"] + length]) for p in parts]
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kind.types, strict=True)], schema=kind)


def _strings(data, offsets, name, ahead, length):
    """Fingerprints of the strings of stretches: fingerprint, stretch, start in the stretch, start in the data."""
    sums, scale = textgrid.prefix_hash(data)
    count = np.diff(offsets) - length + 1
    of = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = offsets[of] + step
    mark = (sums[at + length] - sums[at]) * scale[at] + textgrid.mix(name[of].view(np.uint64) + (ahead[of] - step).astype(np.uint64))
    return textgrid.mix(mark), of, step, at


def _runs(key, start, again):
    """Starts of strings that repeat, as runs: key, first, last."""
    key, start = key[again], start[again]
    order = np.lexsort((start, key))
    key, start = key[order], start[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(key)]])[: len(first)] - 1
    return key[first], start[first], start[last]


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings at ``a`` and ``b`` agree byte by byte."""
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    same = np.zeros(len(a), bool)
    for at in range(0, len(a), 20_000):
        same[at : at + 20_000] = (view[a[at : at + 20_000]] == view[b[at : at + 20_000]]).all(axis=1)
    return same


def _compare(part: pa.RecordBatch, length: int):
    name, key, first, ahead = (part.column(c).to_numpy() for c in ("name", "text_key", "first", "ahead"))
    data, offsets = textgrid.flat(part.column("bytes"))
    if not len(data):
        return
    mark, of, step, at = _strings(data, offsets, name, ahead, length)
    order = np.argsort(mark, kind="stable")
    equal = np.flatnonzero(mark[order[1:]] == mark[order[:-1]])
    equal = equal[_same(data, at[order[equal]], at[order[equal + 1]], length)]
    again = np.zeros(len(mark), bool)
    again[order[equal]] = again[order[equal + 1]] = True
    k, f, last = _runs(key[of], first[of] + step, again)
    yield pa.record_batch({"text_key": k, "first": f, "last": last, "mark": pa.nulls(len(k), pa.int64())})


def _spread(part: pa.RecordBatch, length: int):
    """Each string of a name with very many stretches as a row of its own."""
    for at in range(0, part.num_rows, 2000):
        some = part.slice(at, 2000)
        name, key, first, ahead = (some.column(c).to_numpy() for c in ("name", "text_key", "first", "ahead"))
        data, offsets = textgrid.flat(some.column("bytes"))
        mark, of, step, _ = _strings(data, offsets, name, ahead, length)
        yield pa.record_batch({"text_key": key[of], "first": first[of] + step, "last": first[of] + step, "mark": textgrid.as_long(mark)})


def _merged(length: int, batches):
    """Stretches sorted by name: runs of starts of strings that repeat; for names of very many, all strings."""
    held, wide = [], None  # stretches of the open name and of names before it; the name that is being spread
    for batch in batches:
        while batch.num_rows:
            name = batch.column("name").to_numpy()
            if wide is not None:
                end = int(np.searchsorted(name != wide, True)) if name[-1] != wide else batch.num_rows
                yield from _spread(batch.slice(0, end), length)
                batch = batch.slice(end)
                wide = wide if not batch.num_rows else None
                continue
            held.append(batch)
            rows = pa.concat_batches(held)
            batch = rows.slice(0, 0)
            name = rows.column("name").to_numpy()
            start = int(np.searchsorted(name == name[-1], True))
            if start:
                yield from _compare(rows.slice(0, start), length)
            held = [rows.slice(start)]
            if held[0].num_rows > GROUP:
                wide = name[-1]
                yield from _spread(held.pop(), length)
    if held:
        yield from _compare(pa.concat_batches(held), length)


def _cut(length: int, batches):
    codec = pa.Codec("zstd")
    for batch in batches:
        out = []
        for key, size, packed, runs in zip(*batch.to_pydict().values(), strict=True):
            text = codec.decompress(packed, size, asbytes=True)
            merged: list[list[int]] = []
            for first, last in sorted((r["first"], r["last"] + length) for r in runs):
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], last)
                else:
                    merged.append([first, last])
            kept, at = [], 0
            for first, last in merged:
                kept.append(text[at:first])
                at = last
            kept.append(text[at:])
            out.append((key, sum(b - a for a, b in merged), [{"first": a, "end": b} for a, b in merged], hashlib.sha256(b"".join(kept)).hexdigest()))
        span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), span, pa.string())
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["text_key", "n_removed", "spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, core: int = CORE) -> DataFrame:
    """Per row: its id, ``n_bytes, n_removed, spans, kept_sha256``.

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else
    too, in any row, the same included.  ``spans`` are the removed runs ``(first,
    end)`` of the UTF-8 bytes.  Null counts as empty; texts shorter than ``length``
    stay; repeated rows are copies of each other and go as a whole; null ids are kept.
    Rows of one text are handled once, known by a 64-bit hash of it.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = docs.select(F.xxhash64(text).alias("text_key"), text.alias("text"))
    long = keyed.where(F.length("text") >= length)
    sampled = long.mapInArrow(partial(_sampled, length, core), _SAMPLE)
    by_name = Window.partitionBy("name")
    by_stretch = Window.partitionBy("name", "stretch")
    named = sampled.withColumn("rank", F.row_number().over(by_stretch.orderBy("text_key", "sample")))
    named = named.withColumn("copies", F.count("*").over(by_stretch))
    named = named.withColumn("mixed", F.min("stretch").over(by_name) != F.max("stretch").over(by_name))
    named = named.where("copies > 1 or mixed").withColumn("open", F.expr("mixed and rank = 1"))
    named = cut_lineage(named.select("name", "text_key", "sample", "first", "last", "open", (F.col("copies") > 1).alias("whole")))
    need = F.collect_list(F.when(F.col("open"), F.struct("name", "sample", "first", "last")))
    wanted = named.groupBy("text_key").agg(need.alias("parts"))
    packed = long.mapInArrow(_packed, "text_key bigint, size bigint, packed binary")
    touched = cut_lineage(packed.join(wanted.hint("merge"), "text_key"))
    stretches = touched.where(F.size("parts") > 0).mapInArrow(partial(_stretches, length), "name bigint, text_key bigint, first bigint, ahead bigint, bytes binary")
    stretches = stretches.repartition("name").sortWithinPartitions("name")
    found = cut_lineage(stretches.mapInArrow(partial(_merged, length), "text_key bigint, first bigint, last bigint, mark bigint"))
    spread = found.where("mark is not null").withColumn("times", F.count("*").over(Window.partitionBy("mark"))).where("times > 1")
    runs = named.where("whole").select("text_key", "first", "last")
    runs = runs.union(found.where("mark is null").select("text_key", "first", "last")).union(spread.select("text_key", "first", "last"))
    runs = runs.groupBy("text_key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    cut = touched.select("text_key", "size", "packed").join(runs.hint("merge"), "text_key")
    cut = cut.mapInArrow(partial(_cut, length), "text_key bigint, n_removed bigint, spans array<struct<first:bigint,end:bigint>>, kept_sha256 string")
    cut = cut.dropDuplicates(["text_key"])
    rows = docs.select(F.col(id_col), F.xxhash64(text).alias("text_key"), F.length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    copies = rows.groupBy("text_key").agg(F.count("*").alias("copies"))
    verdict = copies.join(cut.hint("merge"), "text_key", "left")
    rows = rows.join(verdict.hint("merge"), "text_key")
    every = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return rows.select(
        id_col, "n_bytes", F.when(every, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(every, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(every, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )

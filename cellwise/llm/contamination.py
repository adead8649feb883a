"""Benchmark decontamination: windows of benchmark words looked up in every document.

A Bloom filter of the benchmark's windows, of bounded size, travels as a constant of the
query.  Documents look up the hashes of their own windows in it; the few that pass are joined
with the windows by hash and words, which removes the false ones, and the hits of a document
are joined to it again.  No words of the benchmark stand in a plan; up to ``MAX_WINDOWS``
windows are broadcast, and more are joined by a shuffle and without the filter.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.llm.expressions import let
from cellwise.session import cut_lineage

WINDOW = 13
MAX_WINDOWS = 200_000  # broadcast, some 30 MB; more go through a shuffled join without the filter
BITS_PER_WINDOW = 32
MAX_BITS = 1 << 22  # some 1.3 MB as text in a plan; at 200,000 windows one of 10,000 passes wrongly
PROBES = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_NO_ITEMS, _NO_SPANS = "array<string>", "array<struct<first:int,end:int>>"


def words(text: Column) -> Column:
    """A-Z lower-cased, cut at all ASCII but letters and digits; null has no words."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN)
    return F.array_remove(cut, "")


def window_hashes(tokens: Column, length: int) -> Column:
    """A hash for each run of ``length`` words, in order."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (length - 1))
    return F.when(F.size(tokens) >= length, F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, length)))).otherwise(
        F.array().cast("array<bigint>")
    )


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, width: int = WINDOW) -> DataFrame:
    """``len, h, w, items``: distinct windows and the ids with them.  A short item is one window.

    An item of null id counts for hits and is in no list; one without words has no window.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws"))
    items = items.withColumn("len", F.least(F.size("ws"), F.lit(width))).where("len > 0")
    starts = F.sequence(F.lit(1), F.size("ws") - F.col("len") + 1)
    each = items.select("item", "len", F.explode(F.transform(starts, lambda i: F.slice("ws", i, F.col("len")))).alias("ws"))
    each = each.select("item", "len", F.xxhash64("ws").alias("h"), F.array_join("ws", " ").alias("w"))
    return each.groupBy("len", "h", "w").agg(F.collect_set("item").alias("items"))


def _positions(h: Column, n_bits: int) -> list[Column]:
    """The bits of a hash, by double hashing with its halves; ``n_bits`` is a power of two."""
    first, step = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(first + step * i).bitwiseAND(F.lit(n_bits - 1)) for i in range(PROBES)]


def _filter_bits(windows: DataFrame, n_windows: int) -> list[int]:
    """The Bloom filter of the hashes as 64-bit words."""
    n_bits = min(MAX_BITS, 1 << (BITS_PER_WINDOW * n_windows).bit_length())
    each = windows.select(F.explode(F.array(*_positions(F.col("h"), n_bits))).alias("p"))
    bit = F.call_function("shiftleft", F.expr("1L"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    bits = [0] * (n_bits // 64)
    for r in each.groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(bit).alias("word")).collect():
        bits[r["at"]] = r["word"]
    return bits


def _passes(bits: Column, n_bits: int, h: Column) -> Column:
    out = F.lit(True)
    for p in _positions(h, n_bits):
        out = out & (F.getbit(F.get(bits, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def _spots(tokens: Column, lengths: list[int], passes: Callable[[Column], Column]) -> Column:
    """``array<struct<len, at, h, w>>``: windows of a document whose hash passes."""

    def of_length(length):
        spots = F.transform(window_hashes(tokens, length), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.transform(
            F.filter(spots, lambda x: passes(x["h"])),
            lambda x: F.struct(F.lit(length).alias("len"), x["i"].alias("at"), x["h"].alias("h"), F.array_join(F.slice(tokens, x["i"] + 1, length), " ").alias("w")),
        )

    return F.concat(*[of_length(n) for n in lengths])


def _summary(hits: Column) -> Column:
    """``n_hit, items, spans`` of one document; hits are in the order of positions."""
    none = F.array().cast(_NO_SPANS)

    def add(out, x):
        last = F.get(out, F.size(out) - 1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["end"], x["at"] + x["len"]).alias("end"))
        more = F.array(F.struct(x["at"].alias("first"), (x["at"] + x["len"]).alias("end")))
        return F.when(last["end"] >= x["at"], F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(F.concat(out, more))

    def put(spans):
        n_hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
        items = F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda x: x["items"]))))
        return F.struct(n_hit.alias("n_hit"), items.alias("items"), spans.alias("spans"))

    return let(F.aggregate(hits, none, add), put)


def _found(source: DataFrame, windows: DataFrame, n_windows: int, max_windows: int) -> DataFrame:
    """``_key, _hit``: what is found in the documents that hold a window, one row a key.

    The table is written, so that its size decides how it is joined to the documents.
    """
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())
    few = n_windows <= max_windows
    ws = words(F.col("_text"))
    if few:
        filled = _filter_bits(windows, n_windows)
        table = F.from_json(F.lit(json.dumps(filled)), "array<bigint>")
        spots = let(table, lambda bits: let(ws, lambda ws: _spots(ws, lengths, lambda h: _passes(bits, 64 * len(filled), h))))
    else:
        spots = let(ws, lambda ws: _spots(ws, lengths, lambda h: F.lit(True)))
    each = source.select("_key", F.explode(spots).alias("x")).select("_key", "x.*")
    hits = each.join(F.broadcast(windows) if few else windows, ["len", "h", "w"])
    hits = hits.groupBy("_key").agg(F.array_sort(F.collect_set(F.struct("at", "len", "items"))).alias("hits"))
    return cut_lineage(hits.select("_key", _summary(F.col("hits")).alias("_hit")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = WINDOW, keep: tuple[str, ...] = (), max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per document: its id, ``keep``, ``n_words, n_hit, items, spans``.

    ``n_hit`` counts the words inside occurrences of windows, ``items`` are the ids
    found, sorted as strings, and ``spans`` the merged runs of hit words ``(first, end)``.
    Null, empty and wordless texts, and an empty benchmark, have no hits; repeated rows
    are judged alike; a null id is kept.
    """
    windows = cut_lineage(benchmark_windows(benchmark, item_col, "text", width))
    names = [id_col, *[c for c in keep if c != id_col]]
    # Hits follow from the text; the id only deals copies of one text over the tasks.
    key = F.concat(F.sha2(F.coalesce(text_col, F.lit("")), 256), F.xxhash64(id_col).cast("string"))
    source = docs.select(F.struct(*[F.col(c).alias(c) for c in names]).alias("_kept"), key.alias("_key"), F.col(text_col).alias("_text"))
    rows = source.select("_kept", "_key", F.size(words(F.col("_text"))).cast("bigint").alias("n_words"))
    none = F.struct(F.lit(0).cast("bigint").alias("n_hit"), F.array().cast(_NO_ITEMS).alias("items"), F.array().cast(_NO_SPANS).alias("spans"))
    n_windows = windows.count()
    if n_windows:
        found = rows.join(_found(source, windows, n_windows, max_windows), "_key", "left").withColumn("_hit", F.coalesce("_hit", none))
    else:
        found = rows.withColumn("_hit", none)
    return found.select(*[F.col("_kept").getField(c).alias(c) for c in names], "n_words", "_hit.*")


def is_contaminated() -> Column:
    """A twentieth of the words or more are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))

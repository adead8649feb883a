"""URL filters: a blocked Bloom filter before an exact join, under rules of host and path.

The filter is a table of blocks of 256 bits, built by a grouped OR and broadcast; a URL
looks at one block only.  Most URLs are ruled out there, and those that pass are joined
with the list itself, which removes the false ones.  The number of blocks has a ceiling:
with a longer list more URLs pass, and the join still decides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 20  # 48 MB broadcast at most
URLS_PER_BLOCK = 20  # 12.8 bits a URL: about 0.5 % pass wrongly
PROBES = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


@dataclass(frozen=True)
class PathRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        own = (F.col("host") == self.host) | F.col("host").endswith(f".{self.host}")
        return own & F.col("path").startswith(self.path)


# Fixed values.
RULES = [
    PathRule("block", "net", "/"),
    PathRule("allow", "example.net", "/en/"),
    PathRule("block", "example.com", "/de/"),
    PathRule("allow", "org", "/fr/"),
]


def parts(url: Column) -> dict[str, Column]:
    """Host (A-Z lower-cased), path, and what stands after ``?``; empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return {
        "host": F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER),
        "path": F.regexp_extract(url, PARTS, 2),
        "query": F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")),
    }


def canonical() -> Column:
    """Host without ``www.`` or ``m.``, path without a slash at its end, query without tracking, sorted."""
    host = F.regexp_replace("host", r"^(www|m)\.", "")
    path = F.regexp_replace("path", r"/+$", "")
    query = F.filter(F.split("query", "&"), lambda x: (x != "") & ~x.rlike("^(utm_[a-z]+|ref)="))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise(""))


def _masks(key: Column) -> list[Column]:
    """Four words of a block with the bits of a URL, from the bytes of one hash."""
    hashed = F.xxhash64(key, F.lit("bits"))
    bits = [F.shiftrightunsigned(hashed, 8 * i).bitwiseAND(F.lit(255)) for i in range(PROBES)]
    words = []
    for w in range(4):
        word = F.lit(0).cast("bigint")
        for b in bits:
            bit = F.expr("1L").cast("bigint")
            word = word.bitwiseOR(F.when(F.floor(b / 64) == w, F.call_function("shiftleft", bit, (b % 64).cast("int"))).otherwise(F.lit(0).cast("bigint")))
        words.append(word)
    return words


def bloom_blocks(keys: DataFrame, key_col: str, n_blocks: int) -> DataFrame:
    """``block, w0 .. w3``: at most ``n_blocks`` rows; blocks without a URL are left out."""
    masks = _masks(F.col(key_col))
    rows = keys.select(F.pmod(F.xxhash64(key_col), F.lit(n_blocks)).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", rules: list[PathRule] = RULES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``id, host, path, rule, verdict, listed`` of every row.

    The longest rule that fits decides; without one, a URL whose canonical form is that
    of a listed URL is blocked, and any other allowed.  Null URLs and those without
    ``://`` have empty parts and are allowed; repeated rows are judged alike; an empty
    list blocks nothing.
    """
    keys = listed.where(F.col(listed_col).contains("://")).select(F.col(listed_col).alias("_url"))
    keys = keys.withColumns(parts(F.col("_url"))).select(canonical().alias("key")).distinct()
    n_keys = keys.count()
    n_blocks = min(max_blocks, 1 << max(0, (n_keys // URLS_PER_BLOCK).bit_length()))
    blocks = bloom_blocks(keys, "key", n_blocks)
    rows = pages.select(F.col(id_col), F.col(url_col).alias("_url")).withColumns(parts(F.col("_url")))
    fit = sorted(rules, key=lambda r: -len(r.name))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(fit):
        rule, verdict = F.when(r.fits(), r.name).otherwise(rule), F.when(r.fits(), r.verdict).otherwise(verdict)
    rows = rows.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("ruled"), canonical().alias("key"), F.col("_url").contains("://").alias("whole"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)))
    masks = _masks(F.col("key"))
    passes = F.lit(True)
    for i, m in enumerate(masks):
        passes = passes & (F.col(f"w{i}").bitwiseAND(m) == m)
    rows = rows.join(F.broadcast(blocks), "block", "left").withColumn("possible", F.coalesce(passes & F.col("whole"), F.lit(False)))
    rows = rows.select(id_col, "host", "path", "rule", "ruled", "key", "possible")
    ruled_out = rows.where(~F.col("possible")).withColumn("listed", F.lit(False))
    exact = rows.where("possible").join(keys.withColumn("listed", F.lit(True)), "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    both = ruled_out.unionByName(exact)
    return both.select(id_col, "host", "path", "rule", F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")

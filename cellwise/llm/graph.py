"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.session import cut_lineage


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every linked node but the roots; the root is the smallest node.

    ``links``: two long columns.  Loops and nulls are ignored; repeated links count
    once; no links give no rows.  Each round writes its links to the shared folder
    and ends when nothing moves, so the number of rounds follows the data.
    """
    a, b = links.columns
    links = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = cut_lineage(links)
    state = _state(links)
    while state[0]:
        links = cut_lineage(_small_star(_large_star(links)))
        moved, state = state, _state(links)
        if moved == state:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))

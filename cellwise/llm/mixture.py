"""Mixing sources to target weights: every document is repeated a Poisson number of times.

The mean of a source is its target amount of text over the amount it has.  The number is
the inverse of the Poisson distribution at a hash of seed and id, so that any task, run
or partitioning repeats a document alike; copies are ordered by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.session import center_budget, cut_lineage

SEED = 42
STEP = 32  # a mean above is drawn as a sum of draws with a mean of at most this
TAIL = 160  # the chance of more at a mean of 32 is below 1e-50
RATE_BYTES = 1400  # of a source's row beside its name: TAIL + 1 doubles and some more


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("null")) for p in parts])), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def _steps(mean: Column) -> Column:
    """Values of the distribution function at 0, 1, ... TAIL."""
    none = F.exp(-mean)
    start = F.struct(none.alias("term"), none.alias("sum"), F.array(none).alias("out"))

    def step(s, k):
        term = s["term"] * mean / k
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"), F.concat(s["out"], F.array(s["sum"] + term)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TAIL)), start, step, lambda s: s["out"])


def source_rates(docs: DataFrame, source_col: str, text_col: str, weights: dict[str, float] | None = None, budget: float = 1.0) -> DataFrame:
    """``source, mean, draws, steps``: how often a document of each source comes on average.

    ``weights``: share of the text by source, scaled to 1; a source that is not named
    gets none.  Without weights, all get the same.  ``budget``: text of the mixture over
    text of the input.  A source without text (all null or empty) keeps each row once.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("size"))
    sizes = cut_lineage(sizes)  # read for the total, the check of its size and the join
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.coalesce(F.get(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(v)).alias("v")) for k, v in weights.items()]), lambda x: x["k"].eqNullSafe(F.col("source"))), F.lit(0))["v"], F.lit(0.0))
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(F.lit(0.0)))
    total = sizes.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    amount = budget * float(total["size"] or 0) / (total["weight"] or 1.0)
    mean = F.when(F.col("size") > 0, F.col("weight") * F.lit(amount) / F.col("size"))
    rates = sizes.select("source", mean.alias("mean"))
    rates = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("mean") / STEP)).cast("int"))
    return rates.withColumn("steps", _steps(F.col("mean") / F.col("draws")))


def _with_rate(docs: DataFrame, rates: DataFrame, source_col: str) -> DataFrame:
    """Whole rows as ``row``, and their ``rate``; documents stay where they are if the rates fit the broadcast budget."""
    name = F.coalesce(F.octet_length(F.col("source").cast("string")), F.lit(0))
    size = rates.agg(F.sum(F.lit(RATE_BYTES) + name)).first()[0] or 0
    rates = rates.select(F.struct("mean", "draws", "steps").alias("rate"), "source")
    if size <= center_budget(docs.sparkSession):
        rates = F.broadcast(rates)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(rates, F.col(f"row.`{source_col}`").eqNullSafe(F.col("source")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, budget: float = 1.0, seed: int = SEED) -> DataFrame:
    """All columns of ``docs``, ``copy`` (from 1), ``n_copies`` and ``shuffle_key``, in the order of the key.

    A null source is a source, a null id is drawn like an id; rows of one id are drawn
    alike.  Text may be null.  Columns named like the three new ones are replaced, other names
    cannot clash.  An empty table gives no rows.
    """
    docs = docs.drop("copy", "n_copies", "shuffle_key")
    rates = source_rates(docs, source_col, text_col, weights, budget)
    drawn = _with_rate(docs, rates, source_col)

    own_id = F.col(f"row.`{id_col}`").cast("string")
    draws = F.transform(F.sequence(F.lit(1), F.col("rate.draws")), lambda j: uniform(F.lit(str(seed)), own_id, j.cast("string")))
    count = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("rate.steps", lambda c: u >= c)))
    drawn = drawn.select("row", F.when(F.col("rate.mean").isNull(), 1).otherwise(count).alias("n_copies"))
    copies = drawn.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed} order"), F.coalesce(own_id, F.lit("null")), F.col("copy").cast("string")))
    return copies.select("row.*", "copy", "n_copies", key.alias("shuffle_key")).orderBy("shuffle_key")

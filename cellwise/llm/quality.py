"""Quality rules: a learned decision list over text statistics, as one Spark expression.

Rules are found by sequential covering: a rule for low quality is grown condition by
condition on two thirds of a labelled sample, pruned on the rest, and the rows it
covers are taken out before the next one is grown.  The list is then an ordered
``CASE`` over columns, so the whole table is judged in one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.llm.expressions import let

SAMPLE_ROWS = 20_000  # labelled documents that the list is learnt from; the only bound
CUTS = 32  # thresholds a feature
SPACES = r"[\x20\x09-\x0D]+"


def _covered(sorted_windows: Column) -> Column:
    """Words inside windows that share their hash with another one; input sorted by hash."""

    def again(x, j):
        return (F.get(sorted_windows, j - 1)["h"] == x["h"]) | (F.get(sorted_windows, j + 1)["h"] == x["h"])

    at = F.array_sort(F.transform(F.filter(sorted_windows, again), lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(at, start, lambda s, i: F.struct((i + 3).alias("end"), (s["n"] + i + 3 - F.greatest(s["end"], i)).alias("n")), lambda s: s["n"])


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""

    def count(ws):
        hashes = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))

        def weigh(h):
            ranked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(ranked, _covered))

        return F.when(F.size(ws) < 4, 0).otherwise(let(hashes, weigh))

    return let(words, count)


def statistics(text: Column) -> dict[str, Column]:
    """Counts of a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(text, SPACES, "")),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_words(words),
        "n_upper": F.length(F.regexp_replace(text, r"[^A-Z]+", "")),
        "n_digits": F.length(F.regexp_replace(text, r"[^0-9]+", "")),
        "n_marks": F.length(F.regexp_replace(text, r"[^.,;:!?]+", "")),
        "n_lines": F.size(lines),
    }


def with_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.withColumns({k: c.cast("bigint") for k, c in statistics(F.col(text_col)).items()})


def features() -> dict[str, Column]:
    """What conditions are about: sizes, and shares that do not depend on the size."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
        "mark_share": F.col("n_marks") / chars,
        "words_per_line": F.col("n_words") / lines,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.cut if self.above else value <= self.cut

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        value = table[self.feature]
        return value > self.cut if self.above else value <= self.cut


Rules = list[tuple[list[Condition], int, float]]  # conditions, verdict, share of rows with it


def _conditions(table: dict[str, np.ndarray]) -> list[Condition]:
    found = []
    for name, values in table.items():
        kinds = np.unique(values)
        for cut in np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 2)[1:-1], method="lower")):
            above = kinds[np.searchsorted(kinds, cut, "right") :][:1]
            cut = (cut + above[0]) / 2 if len(above) else cut  # half-way to the next value
            found += [Condition(name, above, float(cut)) for above in (True, False)]
    return found


def _all(conditions: list[Condition], table) -> np.ndarray:
    return np.logical_and.reduce([c.holds(table) for c in conditions])


def learn(table: dict[str, np.ndarray], low: np.ndarray, precision: float = 0.75, least: int = 5, longest: int = 4) -> Rules:
    """An ordered list of rules for low quality; a row that no rule covers is of high quality.

    A rule enters the list if it covers ``least`` rows of the part it was not grown on
    with at least ``precision``; the search ends at the first one that does not.
    """
    rules: Rules = []
    order = np.arange(len(low)) % 3 < 2
    left = np.ones(len(low), bool)
    options = _conditions(table) if len(low) else []
    held = [c.holds(table) for c in options]
    while options:
        inside, rule = left & order, []
        while len(rule) < longest:
            p, n = (inside & low).sum(), (inside & ~low).sum()
            if not p or not n:
                break
            hits = np.array([(h & inside & low).sum() for h in held])
            misses = np.array([(h & inside & ~low).sum() for h in held])
            gain = hits * (np.log2(np.maximum(hits, 1e-9) / np.maximum(hits + misses, 1e-9)) - np.log2(p / (p + n)))
            best = int(np.argmax(gain))
            if gain[best] <= 1e-9:
                break
            rule.append(options[best])
            inside = inside & held[best]
        if not rule:
            break
        check = left & ~order

        def worth(conditions):
            got = check & _all(conditions, table)
            return ((got & low).sum() - (got & ~low).sum()) / max(got.sum(), 1)  # noqa: B023

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        got = check & _all(rule, table)
        share = (got & low).sum() / max(got.sum(), 1)
        if got.sum() < least or share < precision:
            break
        rules.append((rule, 0, float(share)))
        left &= ~_all(rule, table)
    return rules


def verdict(rules: Rules) -> Column:
    """The list as an ordered expression: 1 for high quality."""
    out = None
    for conditions, value, _ in rules:
        test = conditions[0].column()
        for c in conditions[1:]:
            test = test & c.column()
        out = F.when(test, value) if out is None else out.when(test, value)
    return F.lit(1) if out is None else out.otherwise(1)


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS) -> Rules:
    """Learn from the ``sample_rows`` labelled ids that come first by hash, those that fail the base rules left out.

    A repeated id counts once, with its smaller label; labels without text, or of one
    kind, give an empty list, which keeps everything.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    measured = with_statistics(texts, "_text").where(~base_failed())
    measured = measured.select("_id", "_label", *[c.alias(k) for k, c in features().items()]).dropDuplicates(["_id"])
    rows = sorted(measured.collect())
    table = {k: np.array([r[k] for r in rows], float) for k in features()}
    return learn(table, np.array([r["_label"] == 0 for r in rows], bool))


def judge(docs: DataFrame, rules: Rules, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the statistics, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base rules.  Repeated rows are judged
    alike.  Columns of ``docs`` with the names of statistics are replaced.
    """
    measured = with_statistics(docs, text_col)
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (verdict(rules) == 1))

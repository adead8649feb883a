"""Secret scans with a ledger: each distinct text is scanned once for each version of a rule.

A text's address is the SHA-256 of its bytes.  The ledger, a Parquet folder, holds what
each version of a rule found in each address; a scan looks only at pairs of address and rule that
are not in it, adds them, and joins the findings of the versions asked for back to all
rows with the address.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellwise.llm.expressions import let

LEDGER = "blob string, rules array<string>, spans array<struct<rule:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and the least length of one of its groups."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, in the order in which spans of one start are listed.
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
]
MORE = [
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
]
RULES = [*BASE, *MORE]


def _pieces(rule: Rule) -> Column:
    """For each match: its rule, order, length before it since the last one, length, length of the group."""
    text = F.col("text")
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    both = F.zip_with(whole, group, lambda m, g: F.struct(F.length(m).alias("m"), F.length(g).alias("g")))

    def put(before):
        def one(x, i):
            good = (x["g"] >= rule.least).alias("good")
            return F.struct(F.lit(rule.name).alias("rule"), i.alias("i"), F.length(F.get(before, i)).alias("gap"), x["m"].alias("m"), good)

        return F.transform(both, one)

    return let(gaps, put)


def _first_look(rule: Rule) -> str:
    """A cheaper pattern that every accepted match contains."""
    return {"hex": "[0-9a-f]{24}", "access": "AKIA[A-Z0-9]{16}"}.get(rule.kind, rule.pattern)


def scan(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``blob, spans``: what the rules in column ``rules`` find in ``text``; only blobs with a finding."""
    none = F.array().cast("array<struct<rule:string,i:int,gap:int,m:int,good:boolean>>")
    looked = [
        F.when(F.array_contains("rules", r.name) & F.col("text").rlike(_first_look(r)), _pieces(r)).otherwise(none) for r in rules
    ]
    each = texts.select("blob", F.explode(F.concat(*looked)).alias("x")).select("blob", "x.*")
    so_far = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum((F.col("gap") + F.col("m")).cast("bigint")).over(so_far)).where("good")
    order = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("rule"))
    span = F.struct((F.col("end") - F.col("m")).alias("start"), order.alias("order"), "rule", "end")
    spans = F.transform(F.array_sort(F.collect_list(span)), lambda s: F.struct(s["rule"].alias("rule"), s["start"].alias("start"), s["end"].alias("end")))
    return each.groupBy("blob").agg(spans.alias("spans"))


def address(text_col: str) -> Column:
    """Where a text's findings are kept; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def leaking_blobs(spark, ledger_path: str, rules: list[Rule] = RULES) -> DataFrame:
    """Addresses, each once, in which one of the rules, in its version, found something."""
    names = [r.name for r in rules]
    hit = F.exists("spans", lambda s: s["rule"].isin(names))
    return read_ledger(spark, ledger_path).where(hit).select("blob").distinct()


def read_ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(docs: DataFrame, ledger_path: str, text_col: str = "text", rules: list[Rule] = RULES) -> None:
    """Scan the pairs of text and rule that the ledger lacks, and add them.

    Null counts as empty.  A run that dies before its write has added nothing; pairs
    that two runs add at once are stored twice and read once.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = docs.select(address(text_col).alias("blob"), text.alias("text")).groupBy("blob").agg(F.any_value("text").alias("text"))
    seen = read_ledger(spark, ledger_path).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = blobs.join(seen.hint("merge"), "blob", "left").withColumn("rules", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
    todo = todo.where(F.size("rules") > 0).select("blob", "text", "rules")
    found = scan(todo, rules)
    fresh = docs.select(address(text_col).alias("blob")).distinct().join(seen.hint("merge"), "blob", "left")
    fresh = fresh.withColumn("rules", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("rules") > 0)
    rows = fresh.join(found.hint("merge"), "blob", "left").select("blob", "rules", F.coalesce("spans", F.array().cast("array<struct<rule:string,start:bigint,end:bigint>>")).alias("spans"))
    rows.write.mode("append").parquet(ledger_path)


def findings(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``id, spans`` of every row: all spans of its text by start, then kind in the order of ``rules``.

    Only findings of the given versions count.  Start and end are code points, the end
    exclusive.  Repeated rows and null ids are kept; null and empty texts have no span;
    an empty table gives no rows; other columns are not read.
    """
    held = read_ledger(docs.sparkSession, ledger_path)
    names = F.array(*[F.lit(r.name) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    each = held.select("blob", F.explode("spans").alias("s")).select("blob", "s.*").where(F.col("rule").isin([r.name for r in rules])).distinct()
    order = F.array_position(names, F.col("rule")).cast("int")
    span = F.struct("start", order.alias("order"), F.get(kinds, order - 1).alias("kind"), "end")
    each = each.groupBy("blob").agg(F.transform(F.array_sort(F.collect_list(span)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
    rows = docs.select(F.col(id_col), address(text_col).alias("blob"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.join(each, "blob", "left").select(id_col, F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

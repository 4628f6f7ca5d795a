"""Operator 4: quality rules as a learned decision list, in DataFrame operations alone.

Every text gets word, symbol, line and repetition counts. Sequential covering then learns when a document is bad from the
labelled ones (``labels.quality`` = 0): a rule grows by the threshold literal with the most information gain, from
histograms that Spark counts over the labelled rows not covered yet; on the other third of the rows it is pruned to its most
precise beginning, and accepted if that is precise enough. The list is an ordered Spark conditional expression, so
verdicts are made in the scan. What comes to the driver is one histogram a step: features x bins x 2 numbers.

A null text has no words, so it fails the base rule (under 50 words), as do empty texts. Long texts are counted whole. A document
with several labels is bad only if all are; labels without a quality or a document are ignored. Without labels, or without bad ones,
the list is empty and the base rule decides. Repeated rows get the same verdict. An empty table gives no rows. All columns are kept
as they are, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import SPACE, WORD, documents
from barloom.session import materialized

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_digits", "n_upper")
CUTS = (0.002, 0.005, 0.01, 0.02, 0.04, *(k / 16 for k in range(1, 16)), 0.96, 0.98, 0.99, 0.995, 0.998)
RULES, LITERALS, PRECISION, LEAST = 8, 4, 0.95, 5


def counted(docs: DataFrame) -> DataFrame:
    """row (the columns as they were) and s (struct of the counts, long)."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = rows.select("row", F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "").alias("w"), F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    m = F.greatest(F.size("w") - 2, F.lit(0))
    two = F.zip_with(F.slice("w", 1, m), F.slice("w", 2, m), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    three = F.zip_with(two, F.slice("w", 3, m), lambda ab, c: F.xxhash64(ab["a"], ab["b"], c))
    rows = rows.select("row", "w", "lines", F.sort_array(F.transform(three, lambda h, i: F.struct(h.alias("h"), i.alias("p")))).alias("t"))
    # neighbours in hash order that are equal: windows found more than once, and where they begin
    n = F.greatest(F.size("t") - 1, F.lit(0))
    twice = F.zip_with(F.slice("t", 1, n), F.slice("t", 2, n), lambda x, y: F.when(x["h"] == y["h"], F.array(x["p"], y["p"])))
    begins = F.array_sort(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull()))))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(begins, start, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(p - s["last"], F.lit(3))).alias("n")))["n"]
    without = lambda chars: F.length(F.translate(text, chars, ""))
    values = {
        "n_words": F.size("w"), "word_chars": without(BLANKS), "n_symbols": F.length(text) - without(SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "n_repeat_words": covered, "n_lines": F.size("lines"),
        "n_distinct": F.size(F.array_distinct("w")), "n_digits": F.length(text) - without("0123456789"),
        "n_upper": F.length(text) - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    }
    # a generator, unlike a projection, is not merged into what uses its result: every count is made once for a row
    return rows.select("row", F.explode(F.array(F.struct(*(values[c].cast("long").alias(c) for c in COUNTS)))).alias("s"))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    per = lambda a, b: s[a] / F.greatest(s[b], F.lit(1))
    return {
        "words": s["n_words"].cast("double"), "word_length": per("word_chars", "n_words"), "symbols": per("n_symbols", "n_words"),
        "repeated_lines": per("n_dup_lines", "n_lines"), "repeated_words": per("n_repeat_words", "n_words"),
        "distinct": per("n_distinct", "n_words"), "digits": per("n_digits", "word_chars"), "upper": per("n_upper", "word_chars"),
        "line_words": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] >= self.threshold if self.above else of[self.feature] < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


Rule = tuple[Literal, ...]


def holds(rule: Rule, of: dict[str, Column]) -> Column:
    out = F.lit(True)
    for literal in rule:
        out = out & literal.column(of)
    return out


def verdict(rules: list[Rule], s: Column) -> Column:
    """True where the document stays: the first rule that holds rejects it, and a document that none holds for stays."""
    out = F.when(base_failed(s), F.lit(False))
    for rule in rules:
        out = out.when(holds(rule, features(s)), F.lit(False))
    return out.otherwise(F.lit(True))


def information(bad: float, good: float) -> float:
    return math.log2((bad + 1) / (bad + good + 2))


def learned(stats: DataFrame, labels: DataFrame, rules: int = RULES, literals: int = LITERALS, precision: float = PRECISION, least: int = LEAST) -> list[Rule]:
    """The decision list for stats (doc_id, s) under labels (doc_id, quality)."""
    said = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.max("quality") < 1).alias("bad"))
    known = stats.join(said, "doc_id").filter(~base_failed(F.col("s")))
    known = known.select("bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("grow"), *(c.alias(k) for k, c in features(F.col("s")).items()))
    known = materialized(known, "labelled")
    names = list(features(F.col("s")))
    cuts = known.agg(*(F.percentile_approx(f, list(CUTS), 1000).alias(f) for f in names)).first()
    thresholds = {f: sorted(set(cuts[f] or [])) for f in names}
    of = {f: F.col(f) for f in names}
    out: list[Rule] = []
    while len(out) < rules:
        left = known
        for rule in out:
            left = left.filter(~holds(rule, of))
        rule: Rule = ()
        while len(rule) < literals:
            if (best := next_literal(left.filter(F.col("grow") & holds(rule, of)), thresholds)) is None:
                break
            rule = (*rule, best)
        kept = pruned(left.filter(~F.col("grow")), rule, of, precision, least)
        if not kept:
            break
        out.append(kept)
    return out


def next_literal(rows: DataFrame, thresholds: dict[str, list[float]]) -> Literal | None:
    """The literal with the most information gain over rows, from one histogram for each feature."""
    bins = [F.struct(F.lit(f).alias("f"), sum((F.when(F.col(f) >= t, 1).otherwise(0) for t in ts), F.lit(0)).alias("b")) for f, ts in thresholds.items() if ts]
    if not bins:
        return None
    found = rows.select("bad", F.explode(F.array(*bins)).alias("x")).groupBy("x.f", "x.b").agg(F.sum(F.col("bad").cast("int")).alias("bad"), F.count("*").alias("n")).collect()
    count: dict[str, dict[int, tuple[int, int]]] = {}
    for f, b, bad, n in found:
        count.setdefault(f, {})[b] = (bad, n - bad)
    if not count:
        return None
    bad, good = (sum(x[k] for x in next(iter(count.values())).values()) for k in (0, 1))
    if not bad or not good:
        return None
    ways = []
    for f, own in sorted(count.items()):
        for i, t in enumerate(thresholds[f]):
            above = [sum(x[k] for b, x in own.items() if b > i) for k in (0, 1)]
            for up, (p, n) in ((True, above), (False, (bad - above[0], good - above[1]))):
                if p and n < good:
                    ways.append((p * (information(p, n) - information(bad, good)), f, up, t))
    gain, f, up, t = max(ways, default=(0, "", True, 0.0))
    return Literal(f, up, t) if gain > 1e-9 else None


def pruned(rows: DataFrame, rule: Rule, of: dict[str, Column], precision: float, least: int) -> Rule:
    """The beginning of a rule that is most precise on rows it wasn't grown on; none if that isn't enough."""
    if not rule:
        return ()
    begins = [rule[:k] for k in range(1, len(rule) + 1)]
    sums = [F.coalesce(F.sum((holds(r, of) & (F.col("bad") == bad)).cast("int")), F.lit(0)).alias(f"{k}_{bad}") for k, r in enumerate(begins) for bad in (True, False)]
    got = rows.agg(*sums).first()
    best = max(range(len(begins)), key=lambda k: ((got[2 * k] + 1) / (got[2 * k] + got[2 * k + 1] + 2), got[2 * k]))
    bad, good = got[2 * best], got[2 * best + 1]
    return begins[best] if bad >= least and bad >= precision * (bad + good) else ()


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """row, s and kept of every document, by rules learned from the labelled ones."""
    stats = materialized(counted(docs.select("doc_id", "text")).select("row.doc_id", "s"), "quality")
    rules = learned(stats, labels)
    return counted(docs).withColumn("kept", verdict(rules, F.col("s")))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay."""
    return judged(docs, labels).filter("kept").select(*(F.col("row")[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialized(counted(documents(spark, sf_dir).select("doc_id", "text")).select("row.doc_id", "s"), "quality")
    rules = learned(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    s = F.col("s")
    return stats.select("doc_id", *(s[c].alias(c) for c in COUNTS[:5]), base_failed(s).alias("base_failed"), verdict(rules, s).alias("kept"))

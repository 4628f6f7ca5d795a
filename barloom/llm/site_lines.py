"""Operator 8: line dedup by distinct-site spread.

Every distinct line of a document counts its site (``source``) in a HyperLogLog sketch of the line's hash; sketches merge by
aggregation. A line whose estimate is clearly above ``sites`` is boilerplate, one clearly below is not, and lines near the
threshold get exact distinct counts. The earliest occurrence of a boilerplate line (least doc_id, then first in its text)
stays and all others go, so a passage that many sites copied is not lost.

Null texts stay null and have no lines; a null site counts for nothing. Blank lines are left alone, and so are lines of
fewer than ``words`` words: none, unless the caller asks for it. Rows with a null doc_id come first. Repeated rows are one document. All other columns are kept as
they are, whatever their names. An empty table gives no rows. Lines are known by 128-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import SPACE, documents
from barloom.session import materialized

SITES = 10
#: Least words of a line in the query, as in its SQL: every line that isn't blank.
WORDS = 1
#: 2^8 registers: a standard error of 6.5 per cent, so a quarter is about four of them.
LG_K = 8
NEAR = 0.25


def key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("l1"), F.xxhash64(line, F.lit(8)).alias("l2"))


def eligible(line: Column, words: int) -> Column:
    return F.size(F.filter(F.split(line, f"{SPACE}+"), lambda w: w != "")) >= words


def identified(docs: DataFrame) -> DataFrame:
    """The row, its id (of repeated rows the same), site and lines, apart from the columns that were there."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).select(
        "row", F.xxhash64(F.lit(7), "row.doc_id", "row.text").alias("rid"), F.split("row.text", "\n").alias("lines"))


def boilerplate(rows: DataFrame, sites: int, words: int) -> tuple[DataFrame, DataFrame]:
    """Lines of all documents (line, site, doc_id, rid), and the boilerplate among them (line, first)."""
    listed = F.transform(F.filter(F.array_distinct("lines"), lambda x: eligible(x, words)), key)
    lines = rows.select(F.col("row.source").cast("string").alias("site"), "row.doc_id", "rid", F.explode(listed).alias("line"))
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min(F.struct("doc_id", "rid")).alias("first"))
    spread = spread.select("line", "first", F.hll_sketch_estimate("sketch").alias("about")).filter(F.col("about") >= sites * (1 - NEAR))
    # stored, the few lines left are broadcast by their size, or joined so that Spark can split a frequent line
    spread = materialized(spread, "spread")
    clear = spread.filter(F.col("about") > sites * (1 + NEAR)).select("line", "first")
    near = spread.filter(F.col("about") <= sites * (1 + NEAR)).select("line", "first")
    exact = lines.select("line", "site").join(near, "line").groupBy("line", "site").agg(F.first("first").alias("first"))
    exact = exact.groupBy("line").agg(F.count("site").alias("n"), F.first("first").alias("first"))
    return lines, materialized(clear.union(exact.filter(F.col("n") >= sites).select("line", "first")), "boilerplate")


def rewritten(docs: DataFrame, sites: int = SITES, words: int = 1) -> DataFrame:
    """row (the columns as they were), lines (before), kept (after; null where the text is)."""
    rows = identified(docs)
    lines, found = boilerplate(rows, sites, words)
    own = F.col("first.rid") == F.col("rid")
    here = lines.join(found, "line").groupBy("rid").agg(
        F.collect_set(F.when(~own, F.col("line"))).alias("drop"), F.collect_set(F.when(own, F.col("line"))).alias("once"))
    joined = rows.join(here, "rid", "left")

    def stays(line: Column, i: Column) -> Column:
        k = key(line)
        again = F.array_contains("once", k) & (F.array_position("lines", line) != i + 1)
        return ~(F.array_contains("drop", k) | again)

    return joined.select("row", "lines", F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", stays)).alias("kept"))


def deduplicated(docs: DataFrame, sites: int = SITES, words: int = 1) -> DataFrame:
    """The documents with the lines that stay."""
    text = F.array_join("kept", "\n").alias("text")
    return rewritten(docs, sites, words).select(*(text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = rewritten(documents(spark, sf_dir), words=WORDS)
    count = F.coalesce(F.size("lines"), F.lit(0)).cast("long")
    return done.select(
        F.col("row.doc_id").alias("doc_id"), F.greatest(count, F.lit(0)).alias("n_lines"),
        (F.greatest(count, F.lit(0)) - F.greatest(F.coalesce(F.size("kept"), F.lit(0)), F.lit(0))).alias("n_removed"),
        F.sha2(F.encode(F.coalesce(F.array_join("kept", "\n"), F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT *, len(list_filter(regexp_split_to_array(line, '[ \\t-\\r]+'), lambda x: x <> '')) >= {WORDS} AS able FROM l),
b AS (
  SELECT line, min(doc_id) AS first_doc FROM w WHERE able
  GROUP BY line HAVING count(DISTINCT source) >= {SITES}),
k AS (
  SELECT w.*, b.line IS NULL OR (w.doc_id = b.first_doc AND w.i = min(w.i) OVER (PARTITION BY w.doc_id, w.line)) AS stays
  FROM w LEFT JOIN b ON w.line = b.line AND w.able)
SELECT d.doc_id, coalesce(count(k.i), 0) AS n_lines, coalesce(count(k.i) FILTER (NOT k.stays), 0) AS n_removed,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (k.stays), '')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id
"""

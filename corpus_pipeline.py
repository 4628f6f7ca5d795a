"""From raw documents to packed training sequences: one operator a stage, each on all that the stage before kept.

Quality rules drop documents, line dedup and masking rewrite texts (``n_chars`` follows), the n-gram join keeps one document of
each group of near copies, and one of those that line dedup left without words, and packing returns pieces with their sequences. Nulls, empty texts, repeated rows, empty
tables and further columns are handled as each operator's docstring says; all columns of ``documents`` are kept up to packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decision_list, jaccard_join, packing, site_lines, skip_chain
from barloom.llm.common import documents
from barloom.session import materialized


def recounted(docs: DataFrame) -> DataFrame:
    """n_chars as the text now is."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decision_list.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recounted(site_lines.deduplicated(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recounted(skip_chain.masked(docs, skip_chain.fitted(docs)))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("best-fit packing", packed_sequences),
]

#: Rules are learned and texts are tokenized, which SQL can't express: tests/llm compares the stages with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialized(docs, "".join(c if c.isalnum() else "-" for c in name))
    return docs

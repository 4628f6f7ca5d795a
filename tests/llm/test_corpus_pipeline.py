"""The stages beside plain versions of what they must do, and on odd rows."""

import re

import pytest
from compare import DATA
from test_text_operators import SCHEMA, WORDS, odd_rows, plain_links, plain_spans

import __spark_entry__ as entry
import corpus_pipeline
from barloom.llm import decision_list, packing
from barloom.session import materialized

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = materialized(stage(spark, docs, SF), "stage")
    return [*out, docs]


def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_columns(stages):
    assert all(docs.columns == stages[0].columns for docs in stages[:5])
    assert "sequence_id" in stages[5].columns


def test_quality(spark, stages):
    before, after = texts(stages[0]), texts(stages[1])
    judged = decision_list.judged(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).select("row.doc_id", "kept").collect()
    assert set(after) == {r.doc_id for r in judged if r.kept} and all(after[k] == before[k] for k in after)


def test_lines(stages):
    rows = sorted((r.doc_id, r.text, r.source) for r in stages[1].collect())
    sites, first = {}, {}
    for doc_id, text, source in rows:
        for i, line in enumerate(text.split("\n")):
            if len(line.split()) >= 1:
                sites.setdefault(line, set()).add(source)
                first.setdefault(line, (doc_id, i))
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if len(sites.get(x, ())) < 10 or first[x] == (d, i)) for d, t, _ in rows}
    assert texts(stages[2]) == want


def test_near_duplicates(stages):
    before = sorted(texts(stages[2]).items())
    _, least = plain_links([t for _, t in before])
    assert texts(stages[3]) == {d: t for k, (d, t) in enumerate(before) if least[k] == k}


def test_copies_over_many_sources_leave_one_document_without_words(spark):
    text = "a line of four words here\nanother line of several words"
    rows = [(g * 100 + k, f"{text} {g}\nlast line of group {g}" if g else text, f"s{k}") for g in range(3) for k in range(14)]
    rows += [(1000, None, "s1"), (1001, " \n ", "s2"), (1002, "words of its own", "s3"), (1002, "words of its own", "s3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for stage in (corpus_pipeline.line_dedup, corpus_pipeline.near_duplicates):
        docs = materialized(stage(spark, docs, SF), "stage")
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert docs.count() == 5 and set(kept) == {0, 1, 100, 200, 1002}
    assert kept[1] == "" and kept[0] == text and kept[1002] == "words of its own"


def test_masking(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for d, text in before.items():
        assert not [s for s in plain_spans(after[d]) if s[0] != 2] and (plain_spans(text) or after[d] == text or re.search("<[A-Z]+>", after[d]))


def test_packing(stages):
    own = packing.word_ids(WORDS)
    got = stages[5].groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0]: r[1] for r in got} == {d: len(own.ids([t or ""])[0]) // 4 for d, t in texts(stages[4]).items()}


@pytest.mark.parametrize("rows", [odd_rows(), []])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == SCHEMA.replace(",", "").split()[::2]
    assert docs.count() >= 0


def test_registered():
    assert {f"op{n}_" for n in range(1, 11)} <= {q[: q.index("_") + 1] for q in entry.queries() if q.startswith("op")}
    assert "pipeline" in entry.queries()

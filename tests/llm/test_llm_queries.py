"""Registered queries with SQL beside it, and the pipeline stage by stage."""

import corpus_pipeline
import plain
import pytest
from compare import connect, difference
from plain import SMALL
from pyspark.sql import functions as F

from tidegauge.llm import queries
from tidegauge.llm.tables import kept


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, name):
    found = difference(spark, connect(SMALL), queries.QUERIES[name], queries.ORACLES[name], SMALL)
    assert not found


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, previous = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        now = kept(stage(spark, previous, SMALL), "trial")
        before = [(r.doc_id, r.text) for r in previous.select("doc_id", "text").collect()]
        if name == "language ID":
            assert now.count() == len(before)  # all are clean
        elif name == "line dedup":
            want = {i: text for i, (text, _, _) in plain.dedup_lines(before).items()}
            assert {r.doc_id: (r.text, r.n_chars) for r in now.collect()} == {
                i: (t, len(t)) for i, t in want.items()}
        elif name == "n-gram Jaccard join":
            groups = plain.jaccard_groups(before)
            assert {r.doc_id for r in now.collect()} == {i for i, (_, c) in groups.items() if i == c}
        else:
            assert {r.doc_id for r in now.collect()} == {i for i, _ in before}
            break
        assert now.columns == columns
        previous = now


def test_pipeline_rejects_texts_without_letters(spark, documents):
    known = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = documents([(10 ** 6, "12 34 !!"), (10 ** 6 + 1, None)], known.schema)
    out = corpus_pipeline.languages(spark, known.union(odd.select(known.columns)), SMALL)
    assert out.count() == known.count()


def test_pipeline_keeps_short_clean_texts(spark, documents):
    known = spark.read.parquet(f"{SMALL}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars")
    # The first words of each text, in which languages are hard to tell.
    short = known.select((F.col("doc_id") + 10 ** 6).alias("doc_id"), F.array_join(
        F.slice(F.split("text", " "), 1, 2), " ").alias("text"), F.lit(None).cast("string")
        .alias("lang"), "source", "n_chars")
    both = known.union(short)
    assert corpus_pipeline.languages(spark, both, SMALL).count() == both.count()


def odd_rows():
    long = " ".join(f"word{i}" for i in range(40_000))
    same = "one text that comes more than once in this small table of texts"
    return [(None, None), (None, None), (1, same), (1, same), (None, same), (2, same), (3, ""),
            (4, "   "), (5, long), (6, "short"), (6, "another text of the same document id here")]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, clashing, documents, name):
    """Nulls, repeated rows and ids, clashing columns, long texts, no labels, empty tables."""
    stage = dict(corpus_pipeline.STAGES)[name]
    empty = stage(spark, clashing([]), SMALL)
    assert empty.count() == 0
    rows, docs = odd_rows(), clashing(odd_rows()).withColumn("row_number", F.lit("x"))
    docs = docs.withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes
                             if c not in ("doc_id", "text", "row_number")})
    out = stage(spark, docs, SMALL)
    if name == "packing":
        assert out.agg(F.count_if(F.col("start") == 0)).first()[0] == len(rows)
        return
    assert out.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    if name == "language ID":
        assert found == sorted(rows, key=str)
    elif name == "line dedup":
        assert len(found) == len(rows)
        assert [r for r in found if r[1] == rows[2][1]] == [(1, rows[2][1])] * 2
    else:
        assert [r for r in found if r[1] == rows[2][1]] == [(1, rows[2][1])]
        assert len(found) == len(rows) - 3


def test_pipeline_without_labels_keeps_the_corpus(spark, documents):
    rows = [(i, f"number {i} says something of its own {i * 7} times over again") for i in range(50)]
    docs = documents(rows)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = kept(stage(spark, docs, SMALL), "trial")
    assert docs.count() == len(rows)

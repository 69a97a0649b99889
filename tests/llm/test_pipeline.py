"""Every stage of the pipeline on its own input, against plain versions."""

from __future__ import annotations

import corpus_pipeline
import pytest
from helpers import awkward, empty, prose
from moodframe.llm import lines, queries, quality
from pyspark.sql import functions as F
from test_lines import brute
from test_neardup import groups, kmers

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near-duplicate removal", "mixing", "packing"]


def test_quality_stage(spark, docs):
    kept = STAGES["quality rules"](spark, docs, SF)
    judged = {r.doc_id for r in quality.judge_quality(docs, quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect() if r.kept}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == judged


def test_line_stage(spark, docs):
    rows = STAGES["line dedup"](spark, docs, SF).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], lines.MIN_WORDS)
    had = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in rows} == {k: t for k, t in want.items() if t.strip(" \t\n\x0b\x0c\r") or t == had[k]}
    assert all(r.n_chars == len(r.text) for r in rows)


def test_neardup_stage(spark, docs):
    kept = {r.doc_id for r in STAGES["near-duplicate removal"](spark, docs, SF).collect()}
    sets = {r.doc_id: kmers(r.text) for r in docs.collect()}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert kept == set(groups(links, sets).values())


def test_mixing_stage(spark, docs):
    mixed = STAGES["mixing"](spark, docs, SF)
    want = {r.doc_id: r.copies for r in queries.QUERIES["op8_mixing"](spark, SF).collect()}
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == docs.columns and set(got.values()) <= {1, 2}
    assert abs(sum(got.values()) - sum(want.values())) < 0.1 * sum(want.values())


def test_packing_stage(spark, docs):
    rows = STAGES["packing"](spark, docs, SF).collect()
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert all(len(r.ids) == r.length for r in rows)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_and_empty_input(spark, name):
    docs = awkward(spark).unionByName(spark.createDataFrame(
        [(70 + i, prose(70 + i, 90), "en", "a", 1) for i in range(3)], "doc_id long, text string, lang string, source string, n_chars long"),
        allowMissingColumns=True)
    out = STAGES[name](spark, docs, SF)
    assert out.count() > 0 and (name == "packing" or out.columns == docs.columns)
    assert STAGES[name](spark, empty(spark), SF).count() == 0


def test_columns_named_like_helpers_keep_their_values(spark):
    """The line stage counts lines; a table's own columns of those names stay."""
    extra = "doc_id long, text string, lang string, source string, n_chars int, lines int, lines_removed int, LINES_ string"
    text = prose(5, 120)
    docs = spark.createDataFrame([(1, text, "en", "a", len(text), 77, 5, "x"), (2, text + "\nown words", "en", "a", 9, 88, None, None)], extra)
    out = STAGES["line dedup"](spark, docs, SF)
    assert out.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.lines, r.lines_removed, r.LINES_) for r in out.collect()) == [(1, 77, 5, "x"), (2, 88, None, None)]


def test_clean_documents_come_through(spark, docs):
    """Distinct prose passes the three filtering stages unchanged."""
    clean = spark.createDataFrame([(1000 + i, prose(1000 + i, 300), "en", "a", 1) for i in range(20)], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    both = docs.unionByName(clean)
    for name in ("quality rules", "line dedup", "near-duplicate removal"):
        kept = STAGES[name](spark, both, SF).filter(F.col("doc_id") >= 1000)
        assert kept.count() == 20 and kept.join(clean, ["doc_id", "text"]).count() == 20

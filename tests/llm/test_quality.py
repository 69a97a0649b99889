from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, empty, prose
from moodframe.llm import quality
from moodframe.llm.common import table


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)]


@pytest.mark.parametrize("text", [
    None, "", " \n ", "a b c a b c", "a a a a", "x\nx\n x\n\n\n", "é b  c", "# * | <b>", "one\rtwo\x0bthree\x0cfour", prose(3, 500) * 2])
def test_counts(text):
    assert quality.text_counts(text)[0] == plain(text)


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (2, 0), (99, 1)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    rows = quality.judge_quality(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(empty(spark), labels)
    assert model.forest is None and quality.judge_quality(empty(spark), model).count() == 0
    docs = spark.createDataFrame([(1, prose(1, 90)), (2, "few")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality.judge_quality(docs, model).collect()} == {1: True, 2: False}


def test_outliers_have_shorter_paths():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    forest = quality.Forest.grow(x, np.full(3, -10.0), np.full(3, 10.0))
    assert forest.score(np.array([[9.0, 9.0, 9.0]]))[0] > forest.score(x).max()


def test_held_out_labels(spark):
    """Fitted on one half of the labels, judged on the other."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = quality.fit_quality(docs, labels.filter("doc_id % 2 = 0"))
    rows = quality.judge_quality(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_repeated_ids_are_one_labelled_row(spark, monkeypatch):
    """Rows of a labelled id beyond the bound change nothing, whatever their order."""
    words = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{words} own{i} " * (1 + i % 2), None, None, None) for i in range(20)]
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(20)], "doc_id long, quality int")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    once = quality.fit_quality(spark.createDataFrame(rows, schema), labels, max_labelled=20)
    many = quality.fit_quality(spark.createDataFrame(rows * 30, schema).repartition(7), labels, max_labelled=20)
    assert once.threshold == many.threshold


def test_a_row_goes_to_the_judge_once(spark, monkeypatch):
    monkeypatch.setattr(quality, "SLICE", 3)  # slices begin inside a batch
    docs = spark.createDataFrame([(i, prose(i, 80) if i % 3 else None, "x") for i in range(20)], "doc_id long, text string, source string").coalesce(1)
    kept = quality.keep_good(docs, quality.QualityModel())
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(r.doc_id, r.text) for r in docs.collect() if r.text}
    sent = re.search(r"MapInArrow passing\(([^)]*)\)", kept._jdf.queryExecution().analyzed().toString())[1]
    assert sent.startswith("row#") and "," not in sent

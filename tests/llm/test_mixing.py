from __future__ import annotations

from collections import defaultdict

import pytest
from helpers import DOCS, awkward, empty
from moodframe.llm import mixing, queries
from pyspark.sql import functions as F


def water_level(sizes, weights=(3, 1, 2), budget=1.5, most=2.0):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), budget * sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * share >= most * sizes[s]}
        if not full:
            target |= {s: weight[s] * share for s in free}
            break
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 300}, {"a": 0, "b": 7}, {"z": 5, None: 50, "é": 20, "Z": 9, "\U0001f600": 3},
    {f"s{i}": (i * 37) % 101 for i in range(50)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(water_level(sizes))


def check(rows):
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r.copies <= 2
        by[r.source].append(r)
    want = water_level({s: sum(r.size for r in x) for s, x in by.items()})
    for s, x in by.items():
        assert x[0].target == pytest.approx(want[s])
        assert abs(sum(r.copies * r.size for r in x) - want[s]) <= max(r.size for r in x) / 2 + 1e-6
        share = want[s] / max(1, sum(r.size for r in x))
        assert all(r.copies in (int(share + 1e-9), int(-(-(share - 1e-9) // 1))) for r in x if r.size)


def test_takes_near_target_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 8)
    rows = [(i, f"s{i % 5}" if i % 3 else "hot", (i * 7919) % 400) for i in range(1500)]
    df = spark.createDataFrame(rows, "key long, source string, size long")
    got = mixing.mix(df).collect()
    assert len(got) == 1500
    check(got)
    again = mixing.mix(df.orderBy(F.desc("size"))).collect()
    assert {(r.key, r.copies) for r in got} == {(r.key, r.copies) for r in again}


def test_expected_copies(spark):
    """Over many seeds a document is taken as often as its target says."""
    df = spark.createDataFrame([(i, "a" if i < 12 else "b", 10 + i) for i in range(40)], "key long, source string, size long")
    total, n = defaultdict(int), 12
    for seed in range(n):
        for r in mixing.mix(df, seed=seed).collect():
            total[r.source] += r.copies * r.size / r.target / n
    assert total == pytest.approx({"a": 1, "b": 1}, rel=0.05)


def test_query(spark):
    rows = queries.QUERIES["op8_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    check(rows)
    assert all(r.taken == r.copies * r.size for r in rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    size = lambda df: {r[0]: r[1] for r in df.groupBy("source").agg(F.sum(mixing.word_count(F.col("text")))).collect()}
    had, has = size(docs), size(mixed)
    want = water_level({k: v or 0 for k, v in had.items()})
    for s in want:
        assert has.get(s, 0) <= 2 * had[s] and abs((has.get(s) or 0) - want[s]) <= 20_000


def test_empty_table(spark):
    assert mixing.mix_documents(empty(spark)).count() == 0


def test_repeated_rows_are_units_of_their_own(spark):
    docs = spark.createDataFrame([(1, "a b c d", "en", "s", 7)] * 9 + [(2, "e f", "en", "t", 3)] * 9, DOCS)
    taken = {r.doc_id: r["count"] for r in mixing.mix_documents(docs).groupBy("doc_id").count().collect()}
    # 81 words to share 3 : 1 make 60.75 words of s (rows of 4) and 20.25 of t (rows of 2)
    assert taken == {1: 15, 2: 10}

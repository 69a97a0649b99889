"""Operators for sizes beyond one task: long documents, filtered backlogs, wide vectors."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodframe.operators import backlog_filter as bf
from moodframe.operators import features as ft
from moodframe.operators import gram, long_segment, sequence
from moodframe.operators.catalogue import catalogue
from moodframe.operators.scoring import scoring_backlog
from moodframe.session import scratch_path

# --- C8 by pointer doubling ------------------------------------------------------


def packed(lines, limit):
    """Properties of a greedy packing fix it: read scene by scene."""
    scenes, at = [], 0
    while at < len(lines):
        end, held = at + 1, len(lines[at].split())
        while end < len(lines) and held + len(lines[end].split()) <= limit:
            held += len(lines[end].split())
            end += 1
        scenes.append((held, "\n".join(lines[at:end])))
        at = end
    return scenes


def _lines(rng, n):
    return [" ".join(["w"] * rng.choice([0, 1, 1, 2, 3, 5, 9, 30])) for _ in range(n)]


@pytest.mark.parametrize("limit", [1, 7, 20])
def test_scenes_of_long_documents(spark, monkeypatch, limit):
    monkeypatch.setattr(long_segment, "BLOCK", 16)  # sums cross many blocks
    rng = random.Random(limit)
    docs = {1: _lines(rng, 400), 2: _lines(rng, 1), 3: ["w " * 50] * 5, None: _lines(rng, 30), 5: [""] * 4}
    docs |= {10 + i: _lines(rng, rng.randint(1, 30)) for i in range(40)}  # document 1 holds a third of all lines
    rows = [(d, 3 * i + 1, x) for d, v in docs.items() for i, x in enumerate(v)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, line_no long, line string").repartition(5)
    got = {}
    for r in long_segment.segment_long_documents(df, max_words=limit).collect():
        got.setdefault(r.doc_id, {})[r.scene_idx] = (r.n_words, r.text)
        assert r.n_scenes == len(packed(docs[r.doc_id], limit))
    words = lambda v: [(n, t) for n, t in packed(v, limit)]
    assert {d: [v[i] for i in range(len(v))] for d, v in got.items()} == {d: words(v) for d, v in docs.items()}


def test_only_numbers_are_moved_before_lines_have_scenes(spark, monkeypatch):
    seen = []

    def noted(name, module):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *a, **k: seen.append((name, df.columns)) or plain(df, *a, **k))

    noted("dense_index", sequence)
    noted("sums_before", long_segment)
    noted("scene_starts", long_segment)
    rows = [(d, i, f"{d} w{i} x") for d in (1, 2, None) for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, line_no long, line string")
    got = long_segment.segment_long_documents(df, max_words=7).collect()
    assert sorted((r.doc_id or 0, r.scene_idx, r.n_scenes, r.n_words, r.text) for r in got) == sorted(
        (d or 0, k, 4, min(6, 21 - 6 * k), "\n".join(f"{d} w{i} x" for i in range(2 * k, min(7, 2 * k + 2)))) for d in (1, 2, None) for k in range(4))
    assert {n for n, _ in seen} == {"dense_index", "sums_before", "scene_starts"}
    assert not any("line" in c for _, c in seen)


def test_repeated_rows_of_a_long_document_stay(spark):
    df = spark.createDataFrame([(1, i, f"w{i}") for i in range(5)] * 2, "doc_id long, line_no long, line string").repartition(3)
    got = long_segment.segment_long_documents(df, max_words=4).orderBy("scene_idx").collect()
    assert [r.text.split("\n") for r in got] == [["w0", "w0", "w1", "w1"], ["w2", "w2", "w3", "w3"], ["w4", "w4"]]


def test_no_lines(spark):
    df = spark.createDataFrame([], "doc_id long, line_no long, line string")
    assert long_segment.segment_long_documents(df).count() == 0


def test_sums_before_cross_blocks(spark, monkeypatch):
    monkeypatch.setattr(long_segment, "BLOCK", 4)
    df = spark.createDataFrame([(k, i, i + 1) for k in ("a", None) for i in range(15)], "k string, i long, v long")
    got = long_segment.sums_before(df, "k", "i", "v", "before").collect()
    assert len(got) == 30 and all(r.before == r.i * (r.i + 1) // 2 for r in got)


# --- D4 / J9 with a Bloom filter ---------------------------------------------------


def _ids(spark, ids):
    return spark.createDataFrame([(i, f"text {i}") for i in ids], "scene_id string, text string")


def test_filtered_backlog_equals_the_anti_join(spark):
    scenes = _ids(spark, [f"s{i}" for i in range(5_000)] + ["s1", None, None])
    scored = _ids(spark, [f"s{i}" for i in range(0, 5_000, 3)] + ["other", None])
    filter_ = bf.build_filter(scored)
    new, doubtful = bf.split_by_filter(scenes, filter_)
    got = sorted(map(tuple, bf.filtered_backlog(scenes, scored, filter_).collect()), key=str)
    assert got == sorted(map(tuple, scoring_backlog(scenes, scored).collect()), key=str)
    known = 1_667 + (1 % 3 == 0)
    assert new.count() + doubtful.count() == scenes.count()
    assert known <= doubtful.count() <= known + 0.1 * 5_000  # a few share bits by chance
    assert doubtful.join(scored, "scene_id").count() == scenes.join(scored, "scene_id").count()  # no scored scene passes as new


def test_filters_are_merged_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(bf, "MAX_WORDS", 64)
    first, second = _ids(spark, [f"a{i}" for i in range(900)]), _ids(spark, [f"b{i}" for i in range(900)])
    path = bf.write_filter(spark, first)
    merged = spark.read.parquet(bf.write_filter(spark, second, old=path))
    assert merged.count() <= 64 and spark.read.parquet(path).count() <= 64  # full, and still exact
    both, scenes = first.unionByName(second), _ids(spark, [f"{c}{i}" for c in "abc" for i in range(950)])
    assert bf.filtered_backlog(scenes, both, merged).count() == scoring_backlog(scenes, both).count() == 950 + 100


def test_empty_filter_and_plan(spark):
    scenes, nothing = _ids(spark, ["x", "y"]), _ids(spark, [])
    assert bf.filtered_backlog(scenes, nothing, bf.build_filter(nothing)).count() == 2
    scored, folder = _ids(spark, [f"s{i}" for i in range(50)]), scratch_path(spark, "scenes")
    scenes.write.parquet(folder)
    new, _ = bf.split_by_filter(spark.read.parquet(folder), spark.read.parquet(bf.write_filter(spark, scored)))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan  # sure misses are not shuffled


# --- E12 for wide vectors ------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 5, 70])
def test_correlations_of_vectors(spark, size):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(300, size)) @ rng.normal(size=(size, size)) + 1e6  # far from 0: moments must be centred
    x[:, 0] = 4.0 if size > 1 else x[:, 0]
    rows = [(v.tolist(),) for v in x] + [(None,), ([],), ([1.0] * (size + 1),), ([float("nan")] * size,), ([None] * size,)]
    df = spark.createDataFrame(rows, "v array<double>").repartition(6)
    got = {(r.dim_a, r.dim_b): r.corr for r in gram.vector_correlations(df, "v", size).collect()}
    assert len(got) == size * size
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(x.T).reshape(size, size)
    for (a, b), r in got.items():
        if size > 1 and 0 in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(want[a, b], abs=1e-7)


def test_no_vectors(spark):
    assert gram.vector_correlations(spark.createDataFrame([], "v array<float>"), "v", 3).count() == 0


# --- groups that cross tasks (D1, J2, E11) ---------------------------------------------


def test_pair_features_of_a_long_group(spark):
    rows = [(("hot" if i % 3 else f"k{i % 7}"), i, [float(i), -float(i)]) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i long, v array<double>").repartition(4)
    plain, long_ = (ft.pair_features(df, ["k"], ["i"], "v", F.lit(0.5), long_groups=x) for x in (False, True))
    assert sorted((r.i, r.features) for r in long_.collect()) == sorted((r.i, r.features) for r in plain.collect())


def test_catalogue_of_a_long_season(spark):
    rows = [(1 if e % 3 else 2, e, f"t{e}", f"s{e}_{k}", k) for e in range(120) for k in range(2)]
    df = spark.createDataFrame(rows, "season int, episode int, title string, scene_id string, scene_idx int").repartition(4)
    got = {(r.season, r.episode): (r.episode_rank, r.n_episodes, r.season_rank, r.scene_ids) for r in catalogue(df).collect()}
    for season in (1, 2):
        episodes = sorted({r[1] for r in rows if r[0] == season})
        assert [got[season, e] for e in episodes] == [(i + 1, len(episodes), season, [f"s{e}_0", f"s{e}_1"]) for i, e in enumerate(episodes)]


def test_previous_text_of_a_long_source(spark):
    rows = [("src", i, f"text {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "episode_id string, scene_idx long, text string").repartition(4)
    got = {r.scene_idx: r.prev_scene_text for r in sequence.prev_scene_text(df, long_groups=True).collect()}
    assert got == {i: f"text {i - 1}" if i else "" for i in range(200)}

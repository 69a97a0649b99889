from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from moodframe.llm import chat
from moodframe.llm.common import table
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("text,want", [
    (None, [(0, "")]), ("", [(0, "")]), ("hello\nthere", [(0, "hello\nthere")]),
    ("User: hi\nyes\n**Assistant:** ok\n### System: s", [(2, "hi\nyes"), (3, "ok"), (1, "s")]),
    ("before\nQ: a?\nA: b", [(0, "before"), (2, "a?"), (3, "b")]), ("\n\n[Human] x", [(2, "x")]),
    ("<|im_start|>user\nhi", [(2, "\nhi")]), ("users: no marker", [(0, "users: no marker")])])
def test_segments(text, want):
    assert chat.segments(text) == want


@given(st.lists(st.tuples(st.sampled_from(chat.ROLES), st.text(alphabet="<|>us\nen d/", max_size=30))))
def test_rendering_round_trip(turns):
    assert chat.parse_rendered("".join(chat.render(*t) for t in turns)) == turns


def value(model, scores, path):
    return model.start[path[0]] + sum(model.step[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(
        scores[i, k] for i, k in enumerate(path))


def random_model(seed):
    rng = np.random.default_rng(seed)
    share = lambda *n: np.log(rng.dirichlet(np.ones(n[-1]), size=n[:-1]))
    return chat.Model(share(chat.S), share(chat.S, chat.S), [share(chat.S, n) for n in chat.SIZES])


@pytest.mark.parametrize("seed", range(6))
def test_blocks_give_the_path_of_one_viterbi(spark, monkeypatch, seed):
    """Matrices per block and borders against one pass over the conversation."""
    monkeypatch.setattr(chat, "BLOCK", 4)
    rng, model = np.random.default_rng(seed), random_model(seed)
    rows = [(c, t, None, "w " * int(rng.integers(0, 90)) + "?" * int(rng.integers(0, 2))) for c in range(5) for t in range(int(rng.integers(1, 40)))]
    got = chat.recover_roles(spark.createDataFrame(rows, TURNS), model).collect()
    for c in range(5):
        mine = sorted((r for r in got if r.conv_id == c), key=lambda r: r.turn)
        scores = model.scores([chat.features(*s) for r in rows if r[0] == c for s in chat.segments(r[3])])
        # several paths can be equally likely
        assert value(model, scores, [chat.ROLES.index(r.role) for r in mine]) == pytest.approx(
            value(model, scores, chat.trace(model, scores, None, None)), abs=1e-9)


def test_blocks_are_bounded_whatever_the_turn_numbers(spark, monkeypatch):
    """Null ids, null turns and one repeated turn number."""
    monkeypatch.setattr(chat, "BLOCK", 4)
    rows = [(None, i % 8, "user", f"a{i}") for i in range(40)] + [(1, None, "user", f"b{i}") for i in range(40)] + [
        (2, 7, "assistant", f"c{i}") for i in range(40)]
    units = chat._units(spark.createDataFrame(rows, TURNS), "conv_id", "turn", "text", "role")
    assert [r["count"] for r in units.groupBy("conv", "block").count().collect()] == [4] * 30
    got = chat.recover_roles(spark.createDataFrame(rows, TURNS), random_model(3)).collect()
    assert sorted(r.text for r in got) == sorted(r[3] for r in rows)


def test_viterbi_against_all_paths():
    from itertools import product
    model, rng = random_model(9), np.random.default_rng(9)
    scores = np.log(rng.random((6, chat.S)))
    best = max(value(model, scores, p) for p in product(range(chat.S), repeat=6))
    assert value(model, scores, chat.trace(model, scores, None, None)) == pytest.approx(best)


def test_held_out_accuracy(spark):
    turns = table(spark, "/root/testdata/sf0.01", "conversations")
    model = chat.fit_roles(turns.filter("conv_id % 3 > 0"))
    rows = turns.filter("conv_id % 3 = 0")
    right = chat.recover_roles(rows, model).alias("r").join(rows.alias("t"), ["conv_id", "turn"]).select(
        F.avg((F.col("r.role") == F.col("t.role")).cast("int"))).first()[0]
    assert right > 0.95


def test_markers_decide(spark):
    model = chat.fit_roles(table(spark, "/root/testdata/sf0.01", "conversations"))
    text = "System: be short\nUser: why?\nAssistant: so\nUser: and?\nAssistant: no"
    got = chat.recover_roles(spark.createDataFrame([(1, 0, None, text)], TURNS), model).orderBy("seg").collect()
    assert [r.role for r in got] == ["system", "user", "assistant", "user", "assistant"]
    assert chat.parse_rendered("".join(r.rendered for r in got))[2] == ("assistant", "so")


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "a"), (None, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "user", "y"),
            (1, None, "odd", ""), (2, -5, "assistant", "w " * 100_000)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], TURNS + ", block long, conv string")
    model = chat.fit_roles(df)
    assert chat.recover_roles(df, model).count() == len(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], TURNS)
    assert chat.recover_roles(df, chat.fit_roles(df)).count() == 0

"""The joint loss, its distributed gradient and the training loop."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodframe.operators import training as tr

SCHEMA = "id int, v array<double>, funny int, sad int, phase string"


def _rows(n: int, seed: int):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 6))
    out = []
    for i in range(n):
        f, s = int(rng.integers(1, 6)), int(rng.integers(1, 6))
        v = np.r_[centres[f - 1][:3], centres[s - 1][3:]] * 2 + rng.normal(size=6) * 0.4
        out.append((i, [float(x) for x in v], f, s, "train" if i % 4 else ("validate" if i % 8 else "test")))
    return out


def _losses(x, f, s, w):
    total = 0.0
    for y, head in ((f, w[0]), (s, w[1])):
        z = head @ np.r_[x, 1.0]
        total += np.log(np.exp(z).sum()) - z[y - 1]
    return total


def test_gradient_is_that_of_the_loss(spark):
    rows = _rows(120, 1)
    w = np.random.default_rng(2).normal(size=(2, 5, 7))
    df = tr.usable_rows(spark.createDataFrame(rows, SCHEMA).repartition(6), "v", 6)
    got = {(r["phase"], r["k"]): r["total"] for r in tr.head_sums(df, w).collect()}
    train = [r for r in rows if r[4] == "train"]
    assert got["train", -2] == len(train) and got["validate", -2] == sum(r[4] == "validate" for r in rows)
    assert {p for p, _ in got} == {"train", "validate"} and ("validate", 0) not in got
    assert got["train", -1] == pytest.approx(sum(_losses(r[1], r[2], r[3], w) for r in train))
    for k in range(0, w.size, 7):  # central differences
        step = np.zeros(w.size)
        step[k] = 1e-5
        up, down = (sum(_losses(r[1], r[2], r[3], w + e.reshape(w.shape)) for r in train) for e in (step, -step))
        assert got["train", k] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-4)


def test_training_beats_the_majority_and_keeps_the_first_best_epoch(spark):
    df = spark.createDataFrame(_rows(400, 3), SCHEMA)
    w, log, best = tr.train_heads(df, "v", 6, epochs=15, rate=0.2)
    loss = {(r["epoch"], r["phase"]): r["loss"] for r in log.collect()}
    assert loss[0, "train"] == pytest.approx(2 * np.log(5))
    held_out = [loss[e, "validate"] for e in range(15)]
    assert held_out[best] == min(held_out) and held_out.index(min(held_out)) == best
    scored = tr.score_joint_heads(df.filter("phase = 'test'"), w, "v")
    for axis in ("funny", "sad"):
        n, hits, top = scored.count(), scored.filter(F.col(axis) == F.col(f"predicted_{axis}")).count(), max(
            r["count"] for r in scored.groupBy(axis).count().collect())
        assert hits > 1.5 * top and hits > 0.6 * n


def test_unusable_rows_take_no_part(spark):
    good = _rows(40, 4)
    bad = [(100, None, 1, 1, "train"), (101, [1.0], 1, 1, "train"), (102, [None] * 6, 1, 1, "train"),
           (103, [0.0] * 6, 0, 1, "train"), (104, [0.0] * 6, 1, None, "train"), (105, [float("nan")] * 6, 1, 1, "train"),
           (106, [0.0] * 6, 1, 1, None)]
    run = [tr.train_heads(spark.createDataFrame(r, SCHEMA).coalesce(1), "v", 6, epochs=2)[0] for r in (good, good + bad)]
    assert np.allclose(run[0], run[1])
    scored = {r["id"]: r["predicted_sad"] for r in tr.score_joint_heads(spark.createDataFrame(bad, SCHEMA), run[0], "v").collect()}
    assert scored[100] is None and scored[101] is None and scored[102] is None and scored[103] in range(1, 6)
    with pytest.raises(ValueError, match="no training row"):
        tr.train_heads(spark.createDataFrame(bad, SCHEMA), "v", 6, epochs=1)

"""Joint training of the two rating heads on frozen vectors (SURVEY J6 with
E19 and E16).

One epoch is one Spark job over the stored rows: every task adds up the loss and
the gradient of its rows in Arrow batches (training rows only for the gradient)
and emits one number per weight, Spark sums those by weight, and the driver,
which holds the weights (2 heads x 5 classes x (dimensions + 1), fixed by the
model), takes the step. Losses of the held-out rows come from the same pass, so
the log has the state before each step; ``best_run`` names the first epoch with
the lowest validation loss, and that epoch's weights are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodframe.operators.features import best_run, epoch_loss, to_double_array
from moodframe.session import scratch_path

#: Ratings run from 1 to this.
CLASSES = 5
#: Rows that the steps learn from, and rows that choose the epoch.
PHASES = ("train", "validate")


def heads_step(x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joint cross-entropy of each row and its gradient summed over the rows.
    ``x`` (rows, d + 1) ends with a column of ones, ``labels`` (2, rows) are
    1-based, ``weights`` are (2, classes, d + 1)."""
    losses, grad = np.zeros(len(x)), np.zeros_like(weights)
    at = np.arange(len(x))
    for h in range(len(weights)):
        z = x @ weights[h].T
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        total = e.sum(axis=1)
        losses += np.log(total) - z[at, labels[h] - 1]
        p = e / total[:, None]
        p[at, labels[h] - 1] -= 1.0
        grad[h] = p.T @ x
    return losses, grad


def head_sums(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(phase, k, total)``: per phase the summed gradient by weight number
    ``k`` (row-major in head, class, dimension; the last dimension is the
    intercept), the summed loss at -1 and the number of rows at -2. The gradient
    is summed for the phase ``train`` only. ``rows`` have ``x array<double>``,
    ``funny``, ``sad`` and ``phase``; a phase outside ``PHASES`` is left out."""
    dims = weights.shape[2] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grad, loss, count = np.zeros_like(weights), dict.fromkeys(PHASES, 0.0), dict.fromkeys(PHASES, 0)
        for b in batches:
            vectors = b.column("x")
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims)
            x = np.c_[x, np.ones(b.num_rows)]
            labels = np.array([b.column(a).to_numpy(zero_copy_only=False) for a in ("funny", "sad")])
            phase = np.array(b.column("phase").to_pylist(), dtype=object)
            for name in PHASES:
                here = phase == name
                if here.any():
                    losses, g = heads_step(x[here], labels[:, here], weights)
                    loss[name] += float(losses.sum())
                    count[name] += int(here.sum())
                    if name == "train":
                        grad += g
        out = [(p, k, v) for p in PHASES if count[p] for k, v in ((-1, loss[p]), (-2, float(count[p])))]
        if count["train"]:
            out += [("train", k, v) for k, v in enumerate(grad.ravel().tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.string(), pa.int32(), pa.float64()))], ["phase", "k", "total"])

    parts = rows.select("x", "funny", "sad", "phase").mapInArrow(run, "phase string, k int, total double")
    return parts.groupBy("phase", "k").agg(F.sum("total").alias("total"))


def usable_rows(df: DataFrame, vec_col: str, dims: int, funny: str = "funny", sad: str = "sad") -> DataFrame:
    """Rows with a vector of ``dims`` known numbers and both ratings in range,
    as ``x, funny, sad, phase``."""
    x = to_double_array(vec_col)
    good = (F.size(x) == dims) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v))
    for a in (funny, sad):
        good = good & F.col(a).between(1, CLASSES)
    return df.filter(good).select(x.alias("x"), F.col(funny).cast("int").alias("funny"),
                                  F.col(sad).cast("int").alias("sad"), "phase")


def train_heads(df: DataFrame, vec_col: str, dims: int, epochs: int = 20, rate: float = 0.1,
                funny: str = "funny", sad: str = "sad") -> tuple[np.ndarray, DataFrame, int]:
    """(weights of the best epoch, log ``epoch, phase, batch, loss``, best epoch).

    ``df`` has a column ``phase`` (train / validate). Full-batch steps of Adam
    from zero weights. Rows without a usable vector or rating take no part; no
    training row is an error, and without validation rows the last epoch counts.
    Rows are stored once in the shared folder and read by every epoch."""
    spark = df.sparkSession
    path = scratch_path(spark, "train-heads")
    usable_rows(df, vec_col, dims, funny, sad).write.parquet(path)
    rows = spark.read.parquet(path)
    w = np.zeros((2, CLASSES, dims + 1))
    first, second = np.zeros_like(w), np.zeros_like(w)
    seen, log = [], []
    for epoch in range(epochs):
        sums = {(r["phase"], r["k"]): r["total"] for r in head_sums(rows, w).collect()}  # one row per weight
        if ("train", -2) not in sums:
            raise ValueError("no training row")
        seen.append(w)
        log += [(epoch, p, 0, sums[p, -1] / sums[p, -2]) for p in PHASES if (p, -2) in sums]
        g = np.array([sums["train", k] for k in range(w.size)]).reshape(w.shape) / sums["train", -2]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        t = epoch + 1
        w = w - rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    frame = spark.createDataFrame([(0, *r) for r in log], "run int, epoch int, phase string, batch int, loss double")
    best = best_run(epoch_loss(frame)).collect()
    at = best[0]["best_epoch"] if best else epochs - 1
    return seen[at], frame.drop("run"), at


def score_joint_heads(df: DataFrame, weights: np.ndarray, vec_col: str) -> DataFrame:
    """Add ``predicted_funny`` and ``predicted_sad`` (1..5, first on ties); NULL
    where the vector is NULL, of another length or has an unknown number."""
    v = to_double_array(vec_col)
    fits = (F.size(v) == weights.shape[2] - 1) & ~F.exists(v, lambda x: x.isNull())
    d = df.withColumn("__v", F.when(fits, v))
    for h, axis in enumerate(("funny", "sad")):
        logits = F.array(*(F.aggregate(
            F.zip_with("__v", F.lit(w[:-1].tolist()), lambda a, b: a * b), F.lit(float(w[-1])), lambda s, x: s + x)
            for w in weights[h]))
        d = d.withColumn("__z", F.when(F.col("__v").isNotNull(), logits))
        d = d.withColumn(f"predicted_{axis}", F.array_position("__z", F.array_max("__z")).cast("int")).drop("__z")
    return d.drop("__v")

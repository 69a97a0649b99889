"""Features, heads and run bookkeeping for encoder scoring (SURVEY J1-J7,
E16, E19).

Vectors stay Spark arrays; element-wise work uses ``transform``/``zip_with``
and per-dimension statistics are ``posexplode`` + partial aggregation, so a
large group never has to fit into one row or one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodframe.functions.fields import model_name
from moodframe.functions.text import explode_positions
from moodframe.operators import sequence
from moodframe.operators.sequence import _listify

# --- fixed values -----------------------------------------------------------
# Configuration grid of the encoder runs.
BACKBONES = ("microsoft/deberta-v3-small", "microsoft/deberta-v3-base")
OPTIMIZERS = ("AdamW", "SGD")
DROPOUT = (True, False)
ENCODINGS = ("cls", "mean_pooling")
# Split of episodes: share held out, share of the held-out part used for test, seed.
HOLDOUT_SHARE, TEST_SHARE, SPLIT_SEED = 0.3, 0.5, 100
# ---------------------------------------------------------------------------


# J1 --------------------------------------------------------------------------
def group_split(df: DataFrame, group_col: str, seed: int = SPLIT_SEED, holdout: float = HOLDOUT_SHARE,
                test_share: float = TEST_SHARE) -> DataFrame:
    """``(group, split)``: every group in exactly one of train / validate /
    test. Groups are ordered by ``md5(group || ':' || seed)``; sizes follow
    the ceil rule (held out = ceil(holdout * n), test = ceil(test_share *
    held out)). The rank comes from sorted ranges of the hash, so no single
    task ranks all groups."""
    g = df.select(F.col(group_col)).distinct()
    h = F.md5(F.concat(F.col(group_col).cast("string"), F.lit(f":{seed}")))
    ranked = sequence.dense_index(g.withColumn("__h", h), [], ["__h"], index_col="__rk", count_col="__n", long_groups=True)
    n = F.col("__n").cast("double")
    n_hold = F.ceil(F.lit(holdout) * n)
    n_test = F.ceil(F.lit(test_share) * n_hold)
    split = (F.when(F.col("__rk") < F.col("__n") - n_hold, F.lit("train"))
              .when(F.col("__rk") < F.col("__n") - n_test, F.lit("validate"))
              .otherwise(F.lit("test")))
    return ranked.select(group_col, split.alias("split"))


# D3 --------------------------------------------------------------------------
def rows_in_split(df: DataFrame, splits: DataFrame, group_col: str, name: str) -> DataFrame:
    """Rows whose group is in the named split (left semi join)."""
    keep = splits.filter(F.col("split") == name).select(group_col)
    return df.join(keep, group_col, "left_semi")


def to_double_array(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(col, lambda x: x.cast("double"))


# J2 --------------------------------------------------------------------------
def pair_features(df: DataFrame, keys, order, vec_col: str, position: Column | str,
                  out_col: str = "features", long_groups: bool = False) -> DataFrame:
    """``[prev, cur, cur - prev, position]`` per row; the first row of a group
    uses a zero vector as its previous encoding. ``long_groups``: from sorted
    ranges, for groups that outgrow a task."""
    d = df.withColumn("__v", to_double_array(vec_col))
    d = sequence.prev_values(d, keys, order, ["__v"], prefix="__p", long_groups=long_groups)
    zeros = F.transform(F.col("__v"), lambda x: F.lit(0.0))
    prev = F.coalesce(F.col("__p__v"), zeros)
    pos = F.col(position) if isinstance(position, str) else position
    feats = F.concat(prev, F.col("__v"), F.zip_with(F.col("__v"), prev, lambda a, b: a - b),
                     F.array(pos.cast("double")))
    return d.withColumn(out_col, feats).drop("__v", "__p__v")


# J3 --------------------------------------------------------------------------
def pool_tokens(df: DataFrame, keys, order, vec_col: str) -> DataFrame:
    """Per group and dimension: the first row's value (CLS pooling) and the
    mean over rows (masked mean pooling). Long form ``(keys..., dim, cls,
    mean)`` from one partial aggregate."""
    keys, order = _listify(keys), _listify(order)
    e = explode_positions(df.withColumn("__v", to_double_array(vec_col)), "__v", keys + order, "dim", "x")
    first = F.min(F.struct(*[F.col(o) for o in order], F.col("x").alias("x")))["x"]
    return e.groupBy(*keys, "dim").agg(first.alias("cls"), F.avg("x").alias("mean"))


# J4 --------------------------------------------------------------------------
def argmax_rating(logits: Column | str) -> Column:
    """1-based index of the largest logit (first on ties)."""
    lg = F.col(logits) if isinstance(logits, str) else logits
    return F.array_position(lg, F.array_max(lg)).cast("int")


# J5 --------------------------------------------------------------------------
def cross_entropy(logits: Column, label_1based: Column) -> Column:
    """``logsumexp(logits) - logits[label]``, computed stably."""
    m = F.array_max(logits)
    lse = m + F.log(F.aggregate(F.transform(logits, lambda x: F.exp(x - m)), F.lit(0.0), lambda a, b: a + b))
    return lse - F.element_at(logits, label_1based)


def two_head_loss(df: DataFrame, funny_logits: Column, sad_logits: Column, funny: Column, sad: Column,
                  keys=None) -> DataFrame:
    """Mean over rows of the sum of the two cross-entropies."""
    loss = cross_entropy(funny_logits, funny) + cross_entropy(sad_logits, sad)
    return df.groupBy(*_listify(keys)).agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("rows"))


# J6 --------------------------------------------------------------------------
def fit_heads(train: DataFrame, vec_col: str, funny: str = "funny", sad: str = "sad",
              max_iter: int = 50, reg: float = 0.0):
    """Two multinomial logistic-regression heads (ratings 1..5 -> classes
    0..4) on frozen vectors; training is distributed by Spark ML."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    d = train.withColumn("__x", array_to_vector(to_double_array(vec_col)))
    models = {}
    for axis in (funny, sad):
        lr = LogisticRegression(featuresCol="__x", labelCol="__y", family="multinomial", maxIter=max_iter,
                                regParam=reg, predictionCol=f"__pred_{axis}", probabilityCol=f"__prob_{axis}",
                                rawPredictionCol=f"__raw_{axis}")
        models[axis] = lr.fit(d.withColumn("__y", (F.col(axis) - 1).cast("double")))
    return models


def score_heads(df: DataFrame, models, vec_col: str) -> DataFrame:
    """Add ``predicted_<axis>`` (1..5) from fitted heads."""
    from pyspark.ml.functions import array_to_vector
    d = df.withColumn("__x", array_to_vector(to_double_array(vec_col)))
    for axis, m in models.items():
        d = m.transform(d).withColumn(f"predicted_{axis}", (F.col(f"__pred_{axis}") + 1).cast("int")) \
             .drop(f"__pred_{axis}", f"__prob_{axis}", f"__raw_{axis}")
    return d.drop("__x")


# J7 --------------------------------------------------------------------------
def param_grid() -> list[dict]:
    """Every backbone x optimizer x dropout x encoding combination, in
    that nesting order (16 runs)."""
    return [{"backbone": b, "optimizer": o, "dropout": d, "encoding": e}
            for b in BACKBONES for o in OPTIMIZERS for d in DROPOUT for e in ENCODINGS]


def grid_frame(spark) -> DataFrame:
    """The grid as a DataFrame with ``run`` index and model name (16 rows:
    a bounded literal, safe to broadcast)."""
    rows = [(i, g["backbone"], g["optimizer"], g["dropout"], g["encoding"]) for i, g in enumerate(param_grid())]
    g = spark.createDataFrame(rows, "run int, backbone string, optimizer string, dropout boolean, encoding string")
    return g.withColumn("model", model_name("backbone", "optimizer", "dropout", "encoding"))


# E19 -------------------------------------------------------------------------
def epoch_loss(log: DataFrame, run_cols: Sequence[str] = ("run",), epoch: str = "epoch", phase: str = "phase",
               batch: str = "batch", loss: str = "loss") -> DataFrame:
    """Mean of the batch means per run, epoch and phase (not a mean of rows)."""
    keys = [*run_cols, epoch, phase]
    b = log.groupBy(*keys, batch).agg(F.avg(loss).alias("__bm"))
    return b.groupBy(*keys).agg(F.avg("__bm").alias("loss"))


# E16 -------------------------------------------------------------------------
def best_run(epochs: DataFrame, run_cols: Sequence[str] = ("run",), epoch: str = "epoch",
             phase: str = "phase", loss: str = "loss", on_phase: str = "validate") -> DataFrame:
    """Epoch with the lowest validation loss per run (earliest on ties)."""
    v = epochs.filter(F.col(phase) == on_phase)
    best = F.min(F.struct(F.col(loss).alias("l"), F.col(epoch).alias("e")))
    return v.groupBy(*run_cols).agg(best.alias("__b")).select(
        *run_cols, F.col("__b.e").alias("best_epoch"), F.col("__b.l").alias("best_loss"))

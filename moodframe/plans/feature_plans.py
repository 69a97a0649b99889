"""Feature and run plans (J1-J6, D3, E16, E19) on ``embeddings`` (vectors,
``label`` as group), ``conversations`` (episodes to split) and ``events``
(a training-metric log: run = event_id mod 16, loss = ln(value + 1))."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from moodframe.functions import fields as fd
from moodframe.operators import features as ft
from moodframe.operators import sequence
from moodframe.operators import training as tr
from moodframe.plans.registry import plan
from moodframe.plans.tables import table
from moodframe.functions.text import explode_positions


def _r(c, places=6):
    return F.round(F.col(c), places).alias(c)


SPLIT_SQL = """
g AS (SELECT DISTINCT conv_id FROM conversations),
r AS (SELECT conv_id, row_number() OVER (ORDER BY md5(CAST(conv_id AS VARCHAR) || ':100')) - 1 AS rk,
             count(*) OVER () AS n FROM g),
s AS (SELECT conv_id, CASE WHEN rk < n - ceil(CAST(0.3 AS DOUBLE) * n) THEN 'train'
                           WHEN rk < n - ceil(CAST(0.5 AS DOUBLE) * ceil(CAST(0.3 AS DOUBLE) * n)) THEN 'validate'
                           ELSE 'test' END AS split FROM r)"""


@plan("group_split", "WITH " + SPLIT_SQL + " SELECT conv_id, split FROM s")
def group_split(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return ft.group_split(c, "conv_id")


@plan("rows_in_split", "WITH " + SPLIT_SQL + """
SELECT c.conv_id, c.turn FROM conversations c SEMI JOIN s ON c.conv_id = s.conv_id AND s.split = 'test'
""")
def rows_in_split(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    splits = ft.group_split(c, "conv_id")
    return ft.rows_in_split(c.select("conv_id", "turn"), splits, "conv_id", "test")


@plan("pair_features", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
l AS (SELECT vec_id, v, lag(v) OVER (PARTITION BY label ORDER BY vec_id) AS pv,
             row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i,
             count(*) OVER (PARTITION BY label) AS n FROM e),
f AS (SELECT vec_id, v, coalesce(pv, list_transform(v, lambda x: 0.0)) AS p,
             round(CASE WHEN n > 1 THEN i / (n - 1) ELSE 0.0 END, 4) AS pos FROM l),
g AS (SELECT vec_id, list_concat(list_concat(list_concat(p, v),
                                 list_transform(range(1, len(v) + 1), lambda k: v[k] - p[k])), [pos]) AS feats
      FROM f)
SELECT vec_id, CAST(u.i - 1 AS INTEGER) AS dim, round(u.x, 6) AS value
FROM g, unnest(g.feats) WITH ORDINALITY AS u(x, i)
""")
def pair_features(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    e = sequence.dense_index(e, ["label"], ["vec_id"], index_col="i", count_col="n", long_groups=True)
    e = e.withColumn("position", sequence.scene_position("i", "n"))
    f = ft.pair_features(e, ["label"], ["vec_id"], "embedding", "position", long_groups=True)
    out = explode_positions(f, "features", ["vec_id"], "dim", "value")
    return out.select("vec_id", F.col("dim").cast("int").alias("dim"), _r("value"))


@plan("pool_tokens", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, vec_id, CAST(u.i - 1 AS INTEGER) AS dim, u.x AS x
      FROM e, unnest(e.v) WITH ORDINALITY AS u(x, i))
SELECT label, dim, round(arg_min(x, vec_id), 6) AS cls, round(avg(x), 6) AS mean FROM x GROUP BY label, dim
""")
def pool_tokens(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    p = ft.pool_tokens(e, ["label"], ["vec_id"], "embedding")
    return p.select("label", F.col("dim").cast("int").alias("dim"), _r("cls"), _r("mean"))


@plan("argmax_rating", """
SELECT vec_id, CAST(list_position(embedding[1:5], list_max(embedding[1:5])) AS INTEGER) AS predicted_funny,
       CAST(list_position(embedding[6:10], list_max(embedding[6:10])) AS INTEGER) AS predicted_sad
FROM embeddings
""")
def argmax_rating(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", ft.argmax_rating(F.slice("embedding", 1, 5)).alias("predicted_funny"),
                    ft.argmax_rating(F.slice("embedding", 6, 5)).alias("predicted_sad"))


@plan("two_head_loss", """
WITH e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
l AS (SELECT label, v[1:5] AS f, v[6:10] AS s, label % 5 + 1 AS yf, (label // 2) % 5 + 1 AS ys FROM e),
c AS (SELECT label,
        list_max(f) + ln(list_sum(list_transform(f, lambda x: exp(x - list_max(f))))) - f[yf]
        + list_max(s) + ln(list_sum(list_transform(s, lambda x: exp(x - list_max(s))))) - s[ys] AS loss
      FROM l)
SELECT label, round(avg(loss), 6) AS loss, count(*) AS rows FROM c GROUP BY label
""")
def two_head_loss(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("v", ft.to_double_array("embedding"))
    yf = (F.col("label") % 5 + 1).cast("int")
    ys = (F.floor(F.col("label") / 2) % 5 + 1).cast("int")
    out = ft.two_head_loss(e, F.slice("v", 1, 5), F.slice("v", 6, 5), yf, ys, keys=["label"])
    return out.select("label", _r("loss"), "rows")


HELD_OUT_SQL = """
g AS (SELECT embedding, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR) || ':100')) - 1 AS rk, count(*) OVER () AS n
      FROM embeddings),
held AS (SELECT list_position(embedding[1:5], list_max(embedding[1:5])) AS funny,
                list_position(embedding[6:10], list_max(embedding[6:10])) AS sad FROM g
         WHERE rk >= n - ceil(CAST(0.5 AS DOUBLE) * ceil(CAST(0.3 AS DOUBLE) * n)))"""


def _rated_vectors(spark, sf_dir):
    """Ratings that the vectors determine (J4 on two slices): ``label`` says
    nothing about them, so no head can be right on held-out rows with it."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", ft.argmax_rating(F.slice("embedding", 1, 5)).alias("funny"),
        ft.argmax_rating(F.slice("embedding", 6, 5)).alias("sad"))


def _labelled_vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", (F.col("label") % 5 + 1).alias("funny"),
        (F.floor(F.col("label") / 2) % 5 + 1).cast("int").alias("sad"))


@plan("fit_heads")
def fit_heads(spark, sf_dir):
    """Two multinomial heads on the vectors (rows-only: an iterative fit)."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", (F.col("label") % 5 + 1).alias("funny"),
        (F.floor(F.col("label") / 2) % 5 + 1).cast("int").alias("sad"))
    splits = ft.group_split(e, "vec_id")
    train = ft.rows_in_split(e, splits, "vec_id", "train")
    models = ft.fit_heads(train, "embedding", max_iter=30)
    return ft.score_heads(e, models, "embedding").select("vec_id", "predicted_funny", "predicted_sad")


@plan("heads_against_majority", "WITH " + HELD_OUT_SQL + """
, c AS (SELECT 'funny' AS axis, funny AS label, count(*) AS n FROM held GROUP BY 2
        UNION ALL SELECT 'sad', sad, count(*) FROM held GROUP BY 2)
SELECT axis, CAST(sum(n) AS BIGINT) AS rows, max(n) AS majority, true AS above_majority FROM c GROUP BY axis
""")
def heads_against_majority(spark, sf_dir):
    """Per head: held-out rows, those of the most frequent class there, and
    whether the head, fitted on the training rows, is right more often."""
    e = _rated_vectors(spark, sf_dir)
    splits = ft.group_split(e, "vec_id")
    models = ft.fit_heads(ft.rows_in_split(e, splits, "vec_id", "train"), "embedding", max_iter=30)
    seen = _against_majority(ft.score_heads(ft.rows_in_split(e, splits, "vec_id", "test"), models, "embedding"))
    return seen.select("axis", "rows", "majority", (F.col("hits") > F.col("majority")).alias("above_majority"))


def _against_majority(scored):
    counts = scored.select(F.inline(F.array(*(
        F.struct(F.lit(a).alias("axis"), F.col(a).cast("int").alias("label"), (F.col(a) == F.col(f"predicted_{a}")).alias("hit"))
        for a in ("funny", "sad"))))).groupBy("axis", "label").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"))
    return counts.groupBy("axis").agg(F.sum("n").alias("rows"), F.max("n").alias("majority"), F.sum("hits").alias("hits"))


# J6 with E19 and E16: the joint loss, its gradient and the training loop --------
DIMS = 64  # of the embeddings


@plan("joint_gradient", """
WITH e AS (SELECT vec_id, label % 5 + 1 AS funny, (label // 2) % 5 + 1 AS sad, list_append(CAST(embedding AS DOUBLE[]), 1.0) AS v
           FROM embeddings),
x AS (SELECT vec_id, funny, sad, CAST(u.i - 1 AS INTEGER) AS dim, u.x
      FROM e, unnest(e.v) WITH ORDINALITY AS u(x, i)),
hc AS (SELECT h, c FROM range(2) a(h), range(5) b(c)),
z AS (SELECT vec_id, funny, sad, h, c, sum(x * ((h * 11 + c * 7 + dim * 3) % 5 - 2) / 10) AS z FROM x, hc GROUP BY ALL),
p AS (SELECT vec_id, h, c, CASE WHEN h = 0 THEN funny ELSE sad END = c + 1 AS hit,
             exp(z - max(z) OVER w) / sum(exp(z)) OVER w * exp(max(z) OVER w) AS p
      FROM z WINDOW w AS (PARTITION BY vec_id, h))
SELECT CAST(h AS INTEGER) AS head, CAST(c + 1 AS INTEGER) AS rating, dim,
       round(avg((p - CASE WHEN hit THEN 1 ELSE 0 END) * x), 6) AS gradient
FROM p JOIN x USING (vec_id) GROUP BY h, c, dim
""")
def joint_gradient(spark, sf_dir):
    """Gradient of the mean joint loss over all vectors at fixed weights."""
    h, c, d = np.indices((2, tr.CLASSES, DIMS + 1))
    weights = ((h * 11 + c * 7 + d * 3) % 5 - 2) / 10
    e = _labelled_vectors(spark, sf_dir).withColumn("phase", F.lit("train"))
    sums = tr.head_sums(tr.usable_rows(e, "embedding", DIMS), weights)
    rows = sums.filter("k = -2").select("phase", F.col("total").alias("rows"))
    size = DIMS + 1
    return sums.filter("k >= 0").join(rows, "phase").select(
        F.floor(F.col("k") / (tr.CLASSES * size)).cast("int").alias("head"),
        (F.floor(F.col("k") / size) % tr.CLASSES + 1).cast("int").alias("rating"),
        (F.col("k") % size).alias("dim"), F.round(F.col("total") / F.col("rows"), 6).alias("gradient"))


@plan("train_heads")
def train_heads(spark, sf_dir):
    """Rows that the heads of the best of 20 epochs and the most frequent class
    get right, among rows that neither the steps nor the choice of the epoch saw
    (rows-only: an iterative fit)."""
    e = _rated_vectors(spark, sf_dir)
    e = e.join(ft.group_split(e, "vec_id").withColumnRenamed("split", "phase"), "vec_id")
    weights, _, _ = tr.train_heads(e, "embedding", DIMS, epochs=20)
    return _against_majority(tr.score_joint_heads(e.filter("phase = 'test'"), weights, "embedding"))


LOG_SQL = """
log AS (SELECT CAST(event_id % 16 AS INTEGER) AS run, CAST(day(ts) AS INTEGER) AS epoch,
               CASE WHEN event_type IN ('view', 'click') THEN 'validate' ELSE 'train' END AS phase,
               user_id % 8 AS batch, ln(value + 1) AS loss FROM events),
b AS (SELECT run, epoch, phase, batch, avg(loss) AS bm FROM log GROUP BY ALL),
el AS (SELECT run, epoch, phase, avg(bm) AS loss FROM b GROUP BY ALL)"""


def metric_log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select((F.col("event_id") % 16).cast("int").alias("run"), F.dayofmonth("ts").alias("epoch"),
                    F.when(F.col("event_type").isin("view", "click"), F.lit("validate"))
                     .otherwise(F.lit("train")).alias("phase"),
                    (F.col("user_id") % 8).alias("batch"), F.log(F.col("value") + 1).alias("loss"))


@plan("epoch_loss", "WITH " + LOG_SQL + " SELECT run, epoch, phase, round(loss, 6) AS loss FROM el")
def epoch_loss(spark, sf_dir):
    return ft.epoch_loss(metric_log(spark, sf_dir)).select("run", "epoch", "phase", _r("loss"))


def _grid_sql() -> str:
    rows = []
    for i, g in enumerate(ft.param_grid()):
        name = "_".join([g["backbone"].replace("-", "_").replace("/", "_"), g["optimizer"],
                         "with_dropout" if g["dropout"] else "without_dropout", g["encoding"], "results"])
        rows.append(f"({i}, '{name}')")
    return "grid(run, model) AS (VALUES " + ", ".join(rows) + ")"


@plan("best_run", "WITH " + LOG_SQL + ", " + _grid_sql() + """,
best AS (SELECT run, min({'l': loss, 'e': epoch}) AS b FROM el WHERE phase = 'validate' GROUP BY run)
SELECT g.model, best.b.e AS best_epoch, round(best.b.l, 6) AS best_loss FROM best JOIN grid g USING (run)
""")
def best_run(spark, sf_dir):
    epochs = ft.epoch_loss(metric_log(spark, sf_dir))
    best = ft.best_run(epochs)
    grid = ft.grid_frame(spark).select("run", "model")
    # the grid is a 16-row literal: a bounded broadcast
    return best.join(F.broadcast(grid), "run").select("model", "best_epoch", _r("best_loss"))


@plan("param_grid", "WITH " + _grid_sql() + " SELECT run, model FROM grid")
def model_name_plan(spark, sf_dir):
    # the grid joined to the runs seen in the metric log (every run has rows)
    runs = metric_log(spark, sf_dir).select("run").distinct()
    grid = ft.grid_frame(spark).select("run", "model")
    return runs.join(F.broadcast(grid), "run").select("run", "model")

"""Evaluation plans (E4-E10, E17) on predictions derived from ``lineitem``:
model = return flag + line status, true ratings 1..5 and predictions 0..5
(0 = no answer) from integer arithmetic on the keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.operators import evaluate as ev
from moodframe.plans.registry import plan
from moodframe.plans.tables import table


def predictions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("model"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % 5 + 1).cast("int").alias("true_funny"),
        (F.col("l_partkey") % 6).cast("int").alias("predicted_funny"),
        ((F.col("l_suppkey") + F.col("l_linenumber")) % 5 + 1).cast("int").alias("true_sad"),
        ((F.col("l_orderkey") + F.col("l_suppkey")) % 6).cast("int").alias("predicted_sad"),
    )


PRED_SQL = """
p AS (
  SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS model,
         CAST((l_orderkey + l_linenumber) % 5 + 1 AS INTEGER) AS true_funny,
         CAST(l_partkey % 6 AS INTEGER) AS predicted_funny,
         CAST((l_suppkey + l_linenumber) % 5 + 1 AS INTEGER) AS true_sad,
         CAST((l_orderkey + l_suppkey) % 6 AS INTEGER) AS predicted_sad
  FROM lineitem
),
u AS (
  SELECT model, l_orderkey, l_linenumber, 'funny' AS axis, true_funny AS label, predicted_funny AS prediction FROM p
  UNION ALL
  SELECT model, l_orderkey, l_linenumber, 'sad' AS axis, true_sad AS label, predicted_sad AS prediction FROM p
),
o AS (
  SELECT *, CASE WHEN label = prediction THEN 'Classified Correctly'
                 WHEN prediction = 0 THEN 'Not Classified'
                 WHEN prediction > label THEN 'Classified Too High'
                 ELSE 'Classified Too Low' END AS outcome
  FROM u WHERE label BETWEEN 1 AND 5
)"""

STATS_SQL = PRED_SQL + """,
cm AS (SELECT model, axis, label, prediction, count(*) AS n FROM o GROUP BY ALL),
cls AS (SELECT unnest([1, 2, 3, 4, 5]) AS c),
st AS (
  SELECT cm.model, cm.axis, cls.c,
    sum(n) AS n_rows,
    sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS n_correct,
    sum(CASE WHEN label = cls.c AND prediction = cls.c THEN n ELSE 0 END) AS tp,
    sum(CASE WHEN prediction = cls.c THEN n ELSE 0 END) AS pp,
    sum(CASE WHEN label = cls.c THEN n ELSE 0 END) AS ap
  FROM cm CROSS JOIN cls GROUP BY cm.model, cm.axis, cls.c
),
pc AS (
  SELECT model, axis, c, n_rows, n_correct,
    CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
    CASE WHEN ap > 0 THEN tp / ap ELSE 0.0 END AS recall,
    CASE WHEN pp + ap > 0 THEN 2 * tp / (pp + ap) ELSE 0.0 END AS f1,
    CASE WHEN n_rows > 0 THEN (n_rows - pp - ap + 2 * tp) / n_rows ELSE 0.0 END AS ovr
  FROM st
),
overall AS (
  SELECT model, axis,
    round(max(n_correct) / max(n_rows), 4) AS accuracy,
    round(avg(precision), 4) AS precision, round(avg(recall), 4) AS recall, round(avg(f1), 4) AS f1
  FROM pc GROUP BY model, axis
)"""


def _rows(spark, sf_dir):
    rows, _ = ev.with_outcome(ev.axis_rows(predictions(spark, sf_dir),
                                           keep=["model", "l_orderkey", "l_linenumber"]))
    return rows


def _stats(spark, sf_dir):
    return ev.class_stats(ev.confusion_counts(_rows(spark, sf_dir)))


@plan("classify_outcome", "WITH " + PRED_SQL + """
SELECT model, l_orderkey, l_linenumber, axis, label, prediction, outcome FROM o
""")
def classify_outcome(spark, sf_dir):
    return _rows(spark, sf_dir).select("model", "l_orderkey", "l_linenumber", "axis", "label",
                                       "prediction", "outcome")


@plan("outcome_counts", "WITH " + PRED_SQL + """,
models AS (SELECT DISTINCT model FROM p),
dom AS (
  SELECT m.model, a.axis, l.label, oc.outcome
  FROM models m
  CROSS JOIN (SELECT unnest(['funny', 'sad']) AS axis) a
  CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS label) l
  CROSS JOIN (SELECT unnest(['Classified Correctly', 'Classified Too High', 'Classified Too Low',
                             'Not Classified']) AS outcome) oc
),
cnt AS (SELECT model, axis, label, outcome, count(*) AS n FROM o GROUP BY ALL)
SELECT d.model, d.axis, d.label, d.outcome, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM dom d LEFT JOIN cnt c USING (model, axis, label, outcome)
""")
def outcome_counts(spark, sf_dir):
    return ev.outcome_counts(_rows(spark, sf_dir))


@plan("confusion_counts", "WITH " + PRED_SQL + """
SELECT model, axis, label, prediction, count(*) AS n FROM o GROUP BY ALL
""")
def confusion_counts(spark, sf_dir):
    return ev.confusion_counts(_rows(spark, sf_dir))


@plan("overall_metrics", "WITH " + STATS_SQL + """
SELECT model, axis, accuracy, precision, recall, f1 FROM overall
""")
def overall_metrics(spark, sf_dir):
    return ev.overall_metrics(_stats(spark, sf_dir))


@plan("per_label_metrics", "WITH " + STATS_SQL + """
SELECT model, axis, CAST(c AS INTEGER) AS label, round(precision, 4) AS precision,
       round(recall, 4) AS recall, round(f1, 4) AS f1
FROM pc
""")
def per_label_metrics(spark, sf_dir):
    return ev.per_label_metrics(_stats(spark, sf_dir)).select(
        "model", "axis", "label", "precision", "recall", "f1")


@plan("one_vs_rest_accuracy", "WITH " + STATS_SQL + """
SELECT model, axis, CAST(c AS INTEGER) AS label, round(ovr, 4) AS accuracy FROM pc
""")
def one_vs_rest_accuracy(spark, sf_dir):
    return ev.per_label_metrics(_stats(spark, sf_dir)).select("model", "axis", "label", "accuracy")


SUMMARY_SQL = STATS_SQL + """,
summary AS (
  SELECT model, axis AS funny_or_sad, 'overall' AS true_label, accuracy, precision, recall, f1
  FROM overall
  UNION ALL
  SELECT model, axis, CAST(c AS VARCHAR), round(ovr, 4), round(precision, 4), round(recall, 4), round(f1, 4)
  FROM pc
)"""


@plan("evaluation_summary", "WITH " + SUMMARY_SQL + " SELECT * FROM summary")
def evaluation_summary(spark, sf_dir):
    return ev.evaluation_summary(predictions(spark, sf_dir))


@plan("select_model", "WITH " + SUMMARY_SQL + """,
ranked AS (
  SELECT *, substr(model, 1, 1) AS family,
         row_number() OVER (PARTITION BY substr(model, 1, 1), funny_or_sad
                            ORDER BY f1 DESC, accuracy DESC, model ASC) AS rk
  FROM summary WHERE true_label = 'overall'
)
SELECT model, funny_or_sad, true_label, accuracy, precision, recall, f1, family FROM ranked WHERE rk = 1
""")
def select_model(spark, sf_dir):
    s = ev.evaluation_summary(predictions(spark, sf_dir))
    return ev.select_model(s, F.substring("model", 1, 1))


# Rows that the summary rejects; missing predictions count as unanswered ---------
def _flawed(spark, sf_dir):
    """Predictions with invalid and missing labels and missing predictions."""
    p = predictions(spark, sf_dir)
    return p.withColumn("true_funny", F.when(F.col("l_orderkey") % 11 == 0, 6).when(F.col("l_orderkey") % 13 != 0, F.col("true_funny"))) \
            .withColumn("predicted_sad", F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 7 != 0, F.col("predicted_sad")))


_FLAWED_SQL = """
f AS (
  SELECT l_returnflag || l_linestatus AS model,
    CASE WHEN l_orderkey % 11 = 0 THEN 6 WHEN l_orderkey % 13 <> 0 THEN (l_orderkey + l_linenumber) % 5 + 1 END AS tf,
    (l_suppkey + l_linenumber) % 5 + 1 AS ts,
    coalesce(CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN (l_orderkey + l_suppkey) % 6 END, 0) AS ps
  FROM lineitem
)"""


@plan("evaluation_rejects", "WITH " + _FLAWED_SQL + """
SELECT model, 'funny' AS funny_or_sad, CASE WHEN tf IS NULL THEN 'label missing' ELSE 'label outside 1..5' END AS reason,
       count(*) AS n
FROM f WHERE tf IS NULL OR tf NOT BETWEEN 1 AND 5 GROUP BY ALL
""")
def evaluation_rejects(spark, sf_dir):
    return ev.evaluation_rejects(_flawed(spark, sf_dir))


@plan("unanswered_predictions", "WITH " + _FLAWED_SQL + """
SELECT model, CAST(ts AS INTEGER) AS label, count(*) AS n FROM f WHERE ps = 0 GROUP BY ALL
""")
def unanswered_predictions(spark, sf_dir):
    rows, _ = ev.with_outcome(ev.axis_rows(_flawed(spark, sf_dir), axes=["sad"]))
    return rows.filter(F.col("outcome") == "Not Classified").groupBy("model", "label").agg(F.count("*").alias("n"))

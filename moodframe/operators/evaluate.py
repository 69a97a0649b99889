"""Multi-class evaluation of predicted ratings.

Plan shape: one narrow per-row step (``inline`` of the two axes, outcome
column), then **one** partial-aggregated group-by to the confusion counts
``(model, axis, label, prediction, n)``. That table has at most
models x 2 x 5 x 6 rows, so every metric after it is computed on a tiny frame.
Dense zero counts come from conditional aggregates, not from a cross join
with a literal domain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
OUTCOMES = ("Classified Correctly", "Classified Too High", "Classified Too Low", "Not Classified")
LABELS = (1, 2, 3, 4, 5)
AXES = ("funny", "sad")
# ---------------------------------------------------------------------------


def classify_outcome(label: Column | str, prediction: Column | str) -> Column:
    """Equal -> correct; prediction 0 -> not classified; higher -> too
    high; else too low (tests in this order)."""
    lab = F.col(label) if isinstance(label, str) else label
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    return (F.when(lab == pred, F.lit(OUTCOMES[0]))
             .when(pred == 0, F.lit(OUTCOMES[3]))
             .when(pred > lab, F.lit(OUTCOMES[1]))
             .otherwise(F.lit(OUTCOMES[2])))


def axis_rows(pred: DataFrame, keep: Sequence[str] = ("model",), axes: Sequence[str] = AXES,
              true_prefix: str = "true_", pred_prefix: str = "predicted_") -> DataFrame:
    """One row per (input row, axis): ``keep..., axis, label, prediction``.
    A per-row ``inline`` of a two-element array: no shuffle."""
    items = F.array(*[
        F.struct(F.lit(a).alias("axis"), F.col(true_prefix + a).cast("int").alias("label"),
                 F.col(pred_prefix + a).cast("int").alias("prediction"))
        for a in axes])
    return pred.select(*keep, F.inline(items))


def with_outcome(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with an ``outcome`` column, rejected rows with a ``reason``). A label
    that is missing or outside 1..5 rejects the row; a missing prediction is an
    unanswered one (0)."""
    ok = F.coalesce(F.col("label").isin(*LABELS), F.lit(False))
    rows = rows.withColumn("prediction", F.coalesce("prediction", F.lit(0)))
    good = rows.filter(ok).withColumn("outcome", classify_outcome("label", "prediction"))
    bad = rows.filter(~ok).withColumn(
        "reason", F.when(F.col("label").isNull(), F.lit("label missing")).otherwise(F.lit("label outside 1..5")))
    return good, bad


def outcome_counts(rows: DataFrame, model_col: str = "model", axes: Sequence[str] = AXES) -> DataFrame:
    """E5: dense counts for every axis x label 1..5 x outcome per model, zeros
    kept. One conditional aggregate per cell, then a per-row ``inline``."""
    cells = [(a, lab, o) for a in axes for lab in LABELS for o in OUTCOMES]
    aggs = [F.count_if((F.col("axis") == a) & (F.col("label") == lab) & (F.col("outcome") == o))
             .alias(f"c{i}") for i, (a, lab, o) in enumerate(cells)]
    wide = rows.groupBy(model_col).agg(*aggs)
    items = F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(lab).alias("label"),
                               F.lit(o).alias("outcome"), F.col(f"c{i}").alias("n"))
                      for i, (a, lab, o) in enumerate(cells)])
    return wide.select(model_col, F.inline(items))


def confusion_counts(rows: DataFrame, model_col: str = "model") -> DataFrame:
    """``(model, axis, label, prediction) -> n``."""
    return rows.groupBy(model_col, "axis", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_stats(confusion: DataFrame, model_col: str = "model") -> DataFrame:
    """Per (model, axis): row count, correct count, and per class c the true
    positives, predicted positives and actual positives."""
    n = F.col("n")
    aggs = [F.sum(n).alias("n_rows"),
            F.sum(F.when(F.col("label") == F.col("prediction"), n).otherwise(0)).alias("n_correct")]
    for c in LABELS:
        aggs += [
            F.sum(F.when((F.col("label") == c) & (F.col("prediction") == c), n).otherwise(0)).alias(f"tp{c}"),
            F.sum(F.when(F.col("prediction") == c, n).otherwise(0)).alias(f"pp{c}"),
            F.sum(F.when(F.col("label") == c, n).otherwise(0)).alias(f"ap{c}"),
        ]
    return confusion.groupBy(model_col, "axis").agg(*aggs)


def _ratio(a: Column, b: Column) -> Column:
    # 0/0 counts as 0 (zero_division=0)
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def _per_class(c: int):
    tp, pp, ap = F.col(f"tp{c}"), F.col(f"pp{c}"), F.col(f"ap{c}")
    n = F.col("n_rows")
    precision = _ratio(tp, pp)
    recall = _ratio(tp, ap)
    f1 = _ratio(2 * tp, pp + ap)
    ovr = _ratio(n - pp - ap + 2 * tp, n)
    return precision, recall, f1, ovr


def per_label_metrics(stats: DataFrame, model_col: str = "model", places: int | None = 4) -> DataFrame:
    """E8 + E9: precision, recall, F1 and one-vs-rest accuracy per class."""
    items = []
    for c in LABELS:
        p, r, f, a = _per_class(c)
        items.append(F.struct(F.lit(c).alias("label"), a.alias("accuracy"), p.alias("precision"),
                              r.alias("recall"), f.alias("f1")))
    out = stats.select(model_col, "axis", F.inline(F.array(*items)))
    return _round(out, places)


def overall_metrics(stats: DataFrame, model_col: str = "model", places: int | None = 4) -> DataFrame:
    """Accuracy over all rows (prediction 0 counts as wrong); macro
    precision, recall and F1 = plain mean over classes 1..5."""
    ps, rs, fs = [], [], []
    for c in LABELS:
        p, r, f, _ = _per_class(c)
        ps.append(p)
        rs.append(r)
        fs.append(f)
    k = float(len(LABELS))
    out = stats.select(
        model_col, "axis",
        _ratio(F.col("n_correct"), F.col("n_rows")).alias("accuracy"),
        (sum(ps[1:], ps[0]) / k).alias("precision"),
        (sum(rs[1:], rs[0]) / k).alias("recall"),
        (sum(fs[1:], fs[0]) / k).alias("f1"),
    )
    return _round(out, places)


def _round(df: DataFrame, places: int | None) -> DataFrame:
    if places is None:
        return df
    return df.select(*[F.round(c, places).alias(c) if c in ("accuracy", "precision", "recall", "f1")
                       else F.col(c) for c in df.columns])


def evaluation_summary(pred: DataFrame, model_col: str = "model", places: int | None = 4) -> DataFrame:
    """Overall rows (``true_label = 'overall'``) and per-class rows for
    each model and axis, in the reference's column order. Rows without a valid
    label are left to ``evaluation_rejects``."""
    rows, _ = with_outcome(axis_rows(pred, keep=[model_col]))
    stats = class_stats(confusion_counts(rows, model_col), model_col)
    overall = overall_metrics(stats, model_col, places).withColumn("true_label", F.lit("overall"))
    per = per_label_metrics(stats, model_col, places).withColumn("true_label", F.col("label").cast("string"))
    cols = [F.col(model_col).alias("model"), F.col("axis").alias("funny_or_sad"), "true_label",
            "accuracy", "precision", "recall", "f1"]
    return overall.select(*cols).unionByName(per.select(*cols))


def evaluation_rejects(pred: DataFrame, model_col: str = "model") -> DataFrame:
    """E10's other half: how many rows of each model and axis the summary could
    not use, and why."""
    _, bad = with_outcome(axis_rows(pred, keep=[model_col]))
    return bad.groupBy(F.col(model_col).alias("model"), F.col("axis").alias("funny_or_sad"), "reason").agg(
        F.count(F.lit(1)).alias("n"))


def select_model(summary: DataFrame, family: Column, axis_col: str = "funny_or_sad") -> DataFrame:
    """Best model per family (and axis) on the overall rows: F1, then
    accuracy, then model name. The summary is tiny, so a window is fine."""
    s = summary.filter(F.col("true_label") == "overall").withColumn("family", family)
    w = Window.partitionBy("family", axis_col).orderBy(F.desc("f1"), F.desc("accuracy"), F.asc("model"))
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == 1).drop("rank")

"""Writers. JSON is written as JSON lines (one record per
line), not one array per file; partition folders replace per-item files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodframe.functions.text import safe_name

SUMMARY_COLUMNS = ["model", "funny_or_sad", "true_label", "accuracy", "precision", "recall", "f1"]


# A7 --------------------------------------------------------------------------
def write_records_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


# A8 --------------------------------------------------------------------------
def write_outcome_slices(rows: DataFrame, counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Scenes per (model, axis, label, outcome) slice as partition folders
    (outcome in file-name form), plus the dense count table in ``_counts``
    so empty slices are known without listing folders."""
    r = rows.withColumn("outcome_key", safe_name("outcome"))
    r.write.mode(mode).partitionBy("model", "axis", "label", "outcome_key").json(f"{path}/slices")
    counts.withColumn("outcome_key", safe_name("outcome")).write.mode(mode).json(f"{path}/_counts")


# A9 --------------------------------------------------------------------------
def write_summary_csv(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    summary.select(*SUMMARY_COLUMNS).write.mode(mode).option("header", True).csv(path)


# A10 -------------------------------------------------------------------------
def write_episodes(scenes: DataFrame, path: str, mode: str = "errorifexists",
                   season: str = "season", episode: str = "episode", source: str = "source",
                   order: str = "scene_idx") -> None:
    """One nested document per episode (ordered scenes), one folder per
    season (``season=N``). An episode's scenes come from one page, so its
    document is bounded by that page."""
    item = F.struct(F.col(order).alias("__o"), F.col("scene_id"), F.col("position"), F.col("text"))
    docs = scenes.groupBy(season, episode, source).agg(F.sort_array(F.collect_list(item)).alias("__s"))
    docs = docs.select(
        F.col(season), F.col(source).alias("source"),
        F.format_string("%d_%02d", F.col(season), F.col(episode)).alias("episode_id"),
        F.col(episode).cast("string").alias("episode"),
        F.transform("__s", lambda x: F.struct(x["scene_id"].alias("scene_id"), x["position"].alias("position"),
                                              x["text"].alias("text"))).alias("scenes"))
    docs.write.mode(mode).partitionBy(season).json(path)

"""Scoring plans (D4-D6, J8, J9): documents as scenes, labels as the
predictions that already exist, a deterministic length scorer as the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.operators import scoring as sc
from moodframe.plans.registry import plan
from moodframe.plans.tables import CONV_SCENES_SQL, conversation_scenes, table
from moodframe.session import scratch_path


def doc_scenes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("scene_id"), "text")


def existing_predictions(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("scene_id"),
        (F.col("quality") + 1).alias("true_funny"), (F.col("toxic") + 1).alias("true_sad"),
        (F.col("quality") + 1).alias("predicted_funny"), (F.col("toxic") + 1).alias("predicted_sad"))


MERGED_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS scene_id, quality + 1 AS true_funny, toxic + 1 AS true_sad,
       quality + 1 AS predicted_funny, toxic + 1 AS predicted_sad
FROM labels
UNION ALL
SELECT CAST(d.doc_id AS VARCHAR), NULL, NULL,
       CAST(length(d.text) % 6 AS INTEGER), CAST(len(string_split(d.text, chr(10))) % 6 AS INTEGER)
FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id
"""


@plan("scoring_backlog", "SELECT CAST(doc_id AS VARCHAR) AS scene_id FROM documents ANTI JOIN labels USING (doc_id)")
def scoring_backlog(spark, sf_dir):
    return sc.scoring_backlog(doc_scenes(spark, sf_dir), existing_predictions(spark, sf_dir)).select("scene_id")


@plan("score_rows", "WITH " + CONV_SCENES_SQL + """
SELECT scene_id, CAST(length(text) % 6 AS INTEGER) AS predicted_funny,
       CAST(len(string_split(text, chr(10))) % 6 AS INTEGER) AS predicted_sad
FROM conv_scenes
""")
def score_rows(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir).select("scene_id", "text")
    return sc.score_rows(s, keep=["scene_id"])


@plan("merge_predictions", MERGED_SQL)
def merge_predictions(spark, sf_dir):
    existing = existing_predictions(spark, sf_dir)
    todo = sc.scoring_backlog(doc_scenes(spark, sf_dir), existing)
    new = sc.score_rows(todo, keep=["scene_id"])
    return sc.merge_predictions(existing, new).select(
        "scene_id", "true_funny", "true_sad", "predicted_funny", "predicted_sad")


@plan("incremental_scores", MERGED_SQL)
def incremental_scores(spark, sf_dir):
    out = scratch_path(spark, "incremental-scores")
    existing_predictions(spark, sf_dir).write.parquet(out)
    docs = doc_scenes(spark, sf_dir)
    sc.incremental_scores(spark, docs, out, keep=["scene_id"])
    # a restart finds nothing left to score
    res = sc.incremental_scores(spark, docs, out, keep=["scene_id"])
    return res.select("scene_id", "true_funny", "true_sad", "predicted_funny", "predicted_sad")


@plan("prefer_source", """
SELECT CAST(doc_id AS VARCHAR) AS scene_id, quality + 1 AS predicted_funny, toxic + 1 AS predicted_sad
FROM labels
""")
def prefer_source(spark, sf_dir):
    base = scratch_path(spark, "prefer-source")
    fallback = f"{base}/labeled_scenes"
    existing_predictions(spark, sf_dir).write.parquet(fallback)
    df = sc.prefer_source(spark, f"{base}/all_scenes", fallback, spark.read.parquet)
    return df.select("scene_id", "predicted_funny", "predicted_sad")


@plan("prefer_by_priority", MERGED_SQL)
def prefer_by_priority(spark, sf_dir):
    existing = existing_predictions(spark, sf_dir)
    scored_all = sc.score_rows(doc_scenes(spark, sf_dir), keep=["scene_id"])
    return sc.prefer_by_priority([existing, scored_all], "scene_id").select(
        "scene_id", "true_funny", "true_sad", "predicted_funny", "predicted_sad")

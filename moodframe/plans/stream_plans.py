"""Streaming plans (K1, K2): the input is written in overlapping parts to a
fresh folder under the shared checkpoint directory, the stream runs with an
``availableNow`` trigger, and the end state is read back and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.plans.label_plans import label_posts
from moodframe.plans.registry import plan
from moodframe.plans.tables import CONV_SCENES_SQL, conversation_scenes
from moodframe.session import scratch_path
from moodframe.streaming.labels import read_latest_version
from moodframe.streaming.labels import stream_upsert_labels as _stream_upsert_labels
from moodframe.streaming.scores import stream_scores as _stream_scores


@plan("stream_scores", "WITH " + CONV_SCENES_SQL + """
SELECT scene_id, CAST(length(text) % 6 AS INTEGER) AS predicted_funny,
       CAST(len(string_split(text, chr(10))) % 6 AS INTEGER) AS predicted_sad
FROM conv_scenes
""")
def stream_scores(spark, sf_dir):
    base = scratch_path(spark, "stream-scores")
    s = conversation_scenes(spark, sf_dir).select("scene_id", "scene_idx", "text")
    # three overlapping landings: early turns, late turns, then every even turn again
    s.filter(F.col("scene_idx") <= 3).write.parquet(f"{base}/in/part=0")
    s.filter(F.col("scene_idx") >= 2).write.parquet(f"{base}/in/part=1")
    s.filter(F.col("scene_idx") % 2 == 0).write.parquet(f"{base}/in/part=2")
    q = _stream_scores(spark, f"{base}/in/*", s.schema, f"{base}/out", f"{base}/ckpt",
                       keep=["scene_id"], max_files_per_trigger=4)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("scene_id", "predicted_funny", "predicted_sad")


@plan("stream_upsert_labels", """
WITH posts AS (
  SELECT printf('%d_%02d_%d', user_id % 6 + 1, user_id // 6 + 1, 1) AS scene_id,
         CAST(event_id % 7 AS INTEGER) AS funny,
         CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INTEGER) AS sad,
         CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS updated_at, event_id
  FROM events
),
ok AS (SELECT * FROM posts WHERE funny BETWEEN 1 AND 5 AND sad BETWEEN 1 AND 5)
SELECT scene_id, funny, sad, updated_at, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY updated_at DESC NULLS LAST, event_id DESC) AS rn
  FROM ok) WHERE rn = 1
""")
def stream_upsert_labels(spark, sf_dir):
    base = scratch_path(spark, "stream-labels")
    p = label_posts(spark, sf_dir).select(
        "scene_id", (F.col("event_id") % 7).cast("int").alias("funny"), "sad", "updated_at", "event_id",
        "event_type")
    for i, et in enumerate(["view", "click", "signup", "purchase", "error"]):
        p.filter(F.col("event_type") == et).drop("event_type").write.parquet(f"{base}/in/part={i}")
    schema = p.drop("event_type").schema
    q = _stream_upsert_labels(spark, f"{base}/in/*", schema, f"{base}/table", f"{base}/ckpt",
                             tie="event_id", max_files_per_trigger=8)
    q.awaitTermination()
    return read_latest_version(spark, f"{base}/table").select("scene_id", "funny", "sad", "updated_at",
                                                              "event_id")

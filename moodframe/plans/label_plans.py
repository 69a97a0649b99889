"""Label-table plans.

Label posts come from ``events``: one scene per user, ratings from the ids
and values, ``updated_at = ts`` except NULL for ``error`` events (so the
NULLS LAST rule is exercised), ``event_id`` as tie-breaker.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.functions.fields import scene_id_build
from moodframe.operators import labels as lb
from moodframe.operators import sequence
from moodframe.plans.registry import plan
from moodframe.plans.tables import CONV_SCENES_SQL, conversation_scenes, table

LOOKUP_SCENE = "1_01_1"


def label_posts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        scene_id_build(F.col("user_id") % 6 + 1, F.floor(F.col("user_id") / 6) + 1, F.lit(1)).alias("scene_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("funny"),
        (F.floor("value").cast("long") % 5 + 1).cast("int").alias("sad"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("ts")).alias("updated_at"),
        "event_id", "event_type", "user_id", "value",
    )


POSTS_SQL = """
posts AS (
  SELECT printf('%d_%02d_%d', user_id % 6 + 1, user_id // 6 + 1, 1) AS scene_id,
         CAST(event_id % 5 + 1 AS INTEGER) AS funny,
         CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INTEGER) AS sad,
         CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS updated_at,
         event_id, event_type, user_id, value
  FROM events
),
latest AS (
  SELECT scene_id, funny, sad, updated_at, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY updated_at DESC NULLS LAST, event_id DESC) AS rn
    FROM posts) WHERE rn = 1
)"""


def _latest(spark, sf_dir):
    p = label_posts(spark, sf_dir)
    return lb.latest_per_key(p, "scene_id", "updated_at", tie="event_id",
                             cols=["funny", "sad", "updated_at", "event_id"])


@plan("latest_label", "WITH " + POSTS_SQL + " SELECT * FROM latest")
def latest_label(spark, sf_dir):
    return _latest(spark, sf_dir)


@plan("upsert_labels", "WITH " + POSTS_SQL + " SELECT * FROM latest")
def upsert_labels(spark, sf_dir):
    p = label_posts(spark, sf_dir).select("scene_id", "funny", "sad", "updated_at", "event_id", "event_type")
    old = p.filter(F.col("event_type").isin("view", "click")).drop("event_type")
    new = p.filter(~F.col("event_type").isin("view", "click")).drop("event_type")
    current = lb.latest_per_key(old, "scene_id", "updated_at", tie="event_id")
    return lb.upsert_labels(current, new, "scene_id", "updated_at", tie="event_id")


@plan("validate_labels", "WITH " + POSTS_SQL + """,
raw AS (SELECT scene_id, event_id, CAST(event_id % 7 AS INTEGER) AS funny,
               CAST(CAST(floor(value) AS BIGINT) % 7 AS INTEGER) AS sad FROM posts)
SELECT scene_id, event_id, funny, sad,
       CASE WHEN scene_id IS NULL THEN 'missing scene_id'
            WHEN funny IS NULL OR sad IS NULL THEN 'missing rating'
            WHEN NOT (funny BETWEEN 1 AND 5) OR NOT (sad BETWEEN 1 AND 5) THEN 'rating outside 1..5'
       END AS reason
FROM raw
""")
def validate_labels(spark, sf_dir):
    p = label_posts(spark, sf_dir).select(
        "scene_id", "event_id", (F.col("event_id") % 7).cast("int").alias("funny"),
        (F.floor("value").cast("long") % 7).cast("int").alias("sad"))
    good, bad = lb.validate_labels(p, check_unique=False)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


@plan("migrate_labels", "WITH " + POSTS_SQL + " SELECT scene_id, funny, sad, updated_at FROM latest")
def migrate_labels(spark, sf_dir):
    legacy = label_posts(spark, sf_dir).select(
        "scene_id", F.concat(F.lit("user"), (F.col("event_id") % 3).cast("string")).alias("username"),
        "funny", "sad", "updated_at", "event_id")
    return lb.migrate_labels(legacy, tie="event_id")


DOC_SCENES_SQL = """
sc AS (
  SELECT source AS episode_id, CAST(doc_id AS VARCHAR) AS scene_id, text,
         coalesce(lag(text) OVER (PARTITION BY source ORDER BY doc_id), '') AS prev_scene_text,
         round(CASE WHEN count(*) OVER (PARTITION BY source) > 1
                    THEN (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)
                         / (count(*) OVER (PARTITION BY source) - 1)
                    ELSE 0.0 END, 4) AS position
  FROM documents
),
lb AS (SELECT CAST(doc_id AS VARCHAR) AS scene_id, quality + 1 AS funny, toxic + 1 AS sad FROM labels)"""


def doc_scenes(spark, sf_dir):
    """Documents as scenes of their source: previous text and position by doc
    id, from sorted ranges, as there are few sources and each has many documents."""
    d = table(spark, sf_dir, "documents").select(
        F.col("source").alias("episode_id"), "doc_id", F.col("doc_id").cast("string").alias("scene_id"), "text")
    d = sequence.dense_index(d, ["episode_id"], ["doc_id"], index_col="scene_idx", count_col="n_scenes", long_groups=True)
    d = sequence.prev_scene_text(d, "episode_id", "doc_id", "text", long_groups=True)
    return d.withColumn("position", sequence.scene_position("scene_idx", "n_scenes"))


def doc_labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("scene_id"),
        (F.col("quality") + 1).alias("funny"), (F.col("toxic") + 1).alias("sad"))


@plan("labeled_scenes", "WITH " + DOC_SCENES_SQL + """
SELECT sc.episode_id, lb.scene_id, lb.funny, lb.sad, sc.text, sc.prev_scene_text, sc.position
FROM lb JOIN sc USING (scene_id)
""")
def labeled_scenes(spark, sf_dir):
    return lb.labeled_scenes(doc_labels(spark, sf_dir), doc_scenes(spark, sf_dir))


@plan("label_status", """
SELECT CAST(d.doc_id AS VARCHAR) AS scene_id, l.quality + 1 AS funny, l.toxic + 1 AS sad,
       l.doc_id IS NOT NULL AS labeled
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def label_status(spark, sf_dir):
    scenes = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("scene_id"))
    return lb.label_status(scenes, doc_labels(spark, sf_dir))


@plan("lookup_label", "WITH " + POSTS_SQL + f" SELECT * FROM latest WHERE scene_id = '{LOOKUP_SCENE}'")
def lookup_label(spark, sf_dir):
    return lb.lookup(_latest(spark, sf_dir), "scene_id", LOOKUP_SCENE)


@plan("lookup_scene", "WITH " + CONV_SCENES_SQL + f"""
SELECT scene_id, episode_id, scene_idx, text FROM conv_scenes WHERE scene_id = '{LOOKUP_SCENE}'
""")
def lookup_scene(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir).select("scene_id", "episode_id", "scene_idx", "text")
    return lb.lookup(s, "scene_id", LOOKUP_SCENE)


@plan("labels_for_scene", "WITH " + POSTS_SQL + f"""
SELECT funny, sad, updated_at, event_id FROM posts WHERE scene_id = '{LOOKUP_SCENE}'
""")
def labels_for_scene(spark, sf_dir):
    p = label_posts(spark, sf_dir)
    return lb.labels_for_scene(p, LOOKUP_SCENE).select("funny", "sad", "updated_at", "event_id")


@plan("all_labels_by_time", "WITH " + POSTS_SQL + """
SELECT scene_id, funny, sad, updated_at,
       CAST(row_number() OVER (ORDER BY updated_at NULLS FIRST, scene_id) AS BIGINT) AS rank
FROM latest
""")
def all_labels_by_time(spark, sf_dir):
    latest = _latest(spark, sf_dir).select("scene_id", "funny", "sad", "updated_at")
    # NULL times come first, as in the ascending order of the ranges
    return sequence.dense_index(latest, [], ["updated_at", "scene_id"], index_col="rank", count_col=None, base=1,
                                long_groups=True)


@plan("sort_episodes", "WITH " + CONV_SCENES_SQL + """
SELECT episode_id, season, episode,
       CAST(row_number() OVER (ORDER BY season, episode) AS BIGINT) AS rank
FROM (SELECT DISTINCT episode_id, season, episode FROM conv_scenes)
""")
def sort_episodes(spark, sf_dir):
    eps = conversation_scenes(spark, sf_dir).select("episode_id", "season", "episode").distinct()
    return sequence.dense_index(eps, [], ["season", "episode"], index_col="rank", count_col=None, base=1,
                                long_groups=True)

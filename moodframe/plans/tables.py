"""Test tables and the rating columns derived from them.

Each derived column is plain integer arithmetic so DuckDB computes the same
values in the oracle SQL (the SQL fragments live next to the builders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodframe.functions.fields import episode_id_build, scene_id_build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# conversations as episodes of scenes -----------------------------------------
# episode = conversation, scene index = turn (0-based), season/episode numbers
# from the conversation id; ratings 0 and 6 occur, so validity resets happen.
def conversation_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    season = (F.col("conv_id") % 6 + 1).cast("int")
    episode = (F.floor(F.col("conv_id") / 6) + 1).cast("int")
    return c.select(
        F.col("conv_id"),
        F.col("turn").alias("scene_idx"),
        season.alias("season"),
        episode.alias("episode"),
        episode_id_build(season, episode).alias("episode_id"),
        scene_id_build(season, episode, F.col("turn") + 1).alias("scene_id"),
        F.col("role"),
        F.col("text"),
        (F.length("text") % 7).cast("int").alias("funny"),
        ((F.length("text") + F.col("turn")) % 6).cast("int").alias("sad"),
    )


CONV_SCENES_SQL = """
conv_scenes AS (
  SELECT conv_id, turn AS scene_idx,
         CAST(conv_id % 6 + 1 AS INTEGER) AS season,
         CAST(conv_id // 6 + 1 AS INTEGER) AS episode,
         printf('%d_%02d', conv_id % 6 + 1, conv_id // 6 + 1) AS episode_id,
         printf('%d_%02d_%d', conv_id % 6 + 1, conv_id // 6 + 1, turn + 1) AS scene_id,
         role, text,
         CAST(length(text) % 7 AS INTEGER) AS funny,
         CAST((length(text) + turn) % 6 AS INTEGER) AS sad
  FROM conversations
)"""


# events as label posts / long rating sequences --------------------------------
def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        (F.col("event_id") % 7).cast("int").alias("funny"),
        (F.floor("value").cast("long") % 6).cast("int").alias("sad"),
    )


EVENT_RATINGS_SQL = """
event_ratings AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(event_id % 7 AS INTEGER) AS funny,
         CAST(CAST(floor(value) AS BIGINT) % 6 AS INTEGER) AS sad
  FROM events
)"""

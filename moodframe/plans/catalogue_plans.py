"""Catalogue plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.functions.text import explode_positions
from moodframe.operators import catalogue as cat
from moodframe.plans.registry import plan
from moodframe.plans.tables import CONV_SCENES_SQL, conversation_scenes, table


@plan("catalogue", "WITH " + CONV_SCENES_SQL + """,
eps AS (SELECT DISTINCT season, episode FROM conv_scenes),
er AS (SELECT season, episode, row_number() OVER (PARTITION BY season ORDER BY episode) AS episode_rank,
              dense_rank() OVER (ORDER BY season) AS season_rank FROM eps)
SELECT s.season, s.episode, 'Episode ' || s.episode AS title, CAST(er.episode_rank AS BIGINT) AS episode_rank,
       CAST(er.season_rank AS BIGINT) AS season_rank, CAST(s.scene_idx AS INTEGER) AS pos, s.scene_id
FROM conv_scenes s JOIN er USING (season, episode)
""")
def catalogue(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir).withColumn(
        "title", F.concat(F.lit("Episode "), F.col("episode").cast("string")))
    c = cat.catalogue(s, "season", "episode", "title", "scene_id", "scene_idx")
    out = explode_positions(c, "scene_ids", ["season", "episode", "title", "episode_rank", "season_rank"],
                            "pos", "scene_id")
    return out.select("season", "episode", "title", "episode_rank", "season_rank",
                      F.col("pos").cast("int").alias("pos"), "scene_id")


@plan("titles_by_season", """
SELECT CAST(p_size % 8 + 1 AS INTEGER) AS season, p_name AS title, p_partkey,
       CAST(row_number() OVER (PARTITION BY p_size % 8 + 1 ORDER BY p_name, p_partkey) AS BIGINT) AS rank
FROM part
""")
def titles_by_season(spark, sf_dir):
    p = table(spark, sf_dir, "part").select((F.col("p_size") % 8 + 1).cast("int").alias("season"),
                                            F.col("p_name").alias("title"), "p_partkey")
    return cat.titles_by_season(p, "season", "title", tie="p_partkey").select("season", "title", "p_partkey", "rank")

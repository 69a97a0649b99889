"""Field-expression plans (B1-B15) on strings built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.functions import fields as fd
from moodframe.plans.registry import plan
from moodframe.plans.tables import CONV_SCENES_SQL, conversation_scenes, table


# B1 ----------------------------------------------------------------------------------
@plan("season_categories", """
WITH m AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 3 = 0 THEN 'Category:Season ' || (p_size % 8 + 1) || ' Transcripts'
              WHEN p_partkey % 3 = 1 THEN 'Category:' || p_brand
              ELSE 'Category:season ' || p_size END AS title
  FROM part
)
SELECT p_partkey, replace(title, 'Category:', '') AS category,
       CAST(NULLIF(regexp_extract(title, '(\\d+)', 1), '') AS INTEGER) AS season
FROM m WHERE contains(title, 'Season')
""")
def season_categories(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 3
    title = (F.when(k == 0, F.concat(F.lit("Category:Season "), (F.col("p_size") % 8 + 1).cast("string"),
                                     F.lit(" Transcripts")))
              .when(k == 1, F.concat(F.lit("Category:"), F.col("p_brand")))
              .otherwise(F.concat(F.lit("Category:season "), F.col("p_size").cast("string"))))
    return fd.season_categories(p.select("p_partkey", title.alias("title"))).select("p_partkey", "category", "season")


# B2 / B3 -----------------------------------------------------------------------------
@plan("episode_id_from_scene", "WITH " + CONV_SCENES_SQL + """
SELECT scene_id, string_split(scene_id, '_')[1] || '_' || string_split(scene_id, '_')[2] AS episode_id
FROM conv_scenes
""")
def episode_id_from_scene(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    return s.select("scene_id", fd.episode_id_from_scene("scene_id").alias("episode_id"))


@plan("scene_id_build", "WITH " + CONV_SCENES_SQL + " SELECT conv_id, scene_idx, scene_id FROM conv_scenes")
def scene_id_build(spark, sf_dir):
    return conversation_scenes(spark, sf_dir).select("conv_id", "scene_idx", "scene_id")


# B4 / B5 -----------------------------------------------------------------------------
_PATHS_SQL = """
paths AS (
  SELECT page_id,
    CASE page_id % 4 WHEN 0 THEN 'Page ' || page_id || ' transcript' WHEN 1 THEN ' transcript'
                     WHEN 2 THEN NULL ELSE '' END AS source,
    CASE page_id % 4 WHEN 0 THEN 'Season ' || (page_id % 6 + 1) || ' Transcripts'
                     WHEN 1 THEN 'season ' || (page_id % 6 + 1) || ' transcripts extra'
                     WHEN 2 THEN 'Season X' ELSE 'Season ' || (page_id % 9) || ' Transcripts' END AS folder,
    CASE page_id % 3 WHEN 0 THEN 'ep_' || lpad(CAST(page_id % 30 AS VARCHAR), 2, '0') || '_My_Title_' || page_id || '_transcript'
                     WHEN 1 THEN 'EP_' || (page_id % 30) || '_Other_Title'
                     ELSE 'page_' || page_id END AS stem
  FROM pages
)"""


def _paths(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    k4, k3 = pid % 4, pid % 3
    source = (F.when(k4 == 0, F.concat(F.lit("Page "), pid.cast("string"), F.lit(" transcript")))
               .when(k4 == 1, F.lit(" transcript")).when(k4 == 2, F.lit(None).cast("string"))
               .otherwise(F.lit("")))
    folder = (F.when(k4 == 0, F.concat(F.lit("Season "), (pid % 6 + 1).cast("string"), F.lit(" Transcripts")))
               .when(k4 == 1, F.concat(F.lit("season "), (pid % 6 + 1).cast("string"), F.lit(" transcripts extra")))
               .when(k4 == 2, F.lit("Season X"))
               .otherwise(F.concat(F.lit("Season "), (pid % 9).cast("string"), F.lit(" Transcripts"))))
    stem = (F.when(k3 == 0, F.concat(F.lit("ep_"), F.lpad((pid % 30).cast("string"), 2, "0"), F.lit("_My_Title_"),
                                     pid.cast("string"), F.lit("_transcript")))
             .when(k3 == 1, F.concat(F.lit("EP_"), (pid % 30).cast("string"), F.lit("_Other_Title")))
             .otherwise(F.concat(F.lit("page_"), pid.cast("string"))))
    return p.select("page_id", source.alias("source"), folder.alias("folder"), stem.alias("stem"))


@plan("episode_title", "WITH " + _PATHS_SQL + r"""
SELECT page_id,
  coalesce(NULLIF(trim(replace(coalesce(source, ''), ' transcript', '')), ''),
           CASE WHEN regexp_matches(stem, '^ep_\d+_.+', 'i')
                THEN trim(replace(replace(regexp_extract(stem, '^ep_\d+_(.+)', 1, 'i'), '_transcript', ''), '_', ' '))
           END,
           stem) AS title
FROM paths
""")
def episode_title(spark, sf_dir):
    p = _paths(spark, sf_dir)
    return p.select("page_id", fd.episode_title("source", "stem").alias("title"))


@plan("season_episode_from_path", "WITH " + _PATHS_SQL + r"""
SELECT page_id,
       CAST(regexp_extract(folder, '^Season (\d+) Transcripts', 1, 'i') AS INTEGER) AS season,
       CAST(coalesce(NULLIF(regexp_extract(stem, 'ep_(\d+)_', 1, 'i'), ''), '0') AS INTEGER) AS episode
FROM paths WHERE regexp_matches(folder, '^Season (\d+) Transcripts', 'i')
""")
def season_episode_from_path(spark, sf_dir):
    p = _paths(spark, sf_dir)
    out = p.select("page_id", fd.season_from_folder("folder").alias("season"),
                   fd.episode_from_stem("stem").alias("episode"))
    return out.filter(F.col("season").isNotNull())


# B6 / B8 -----------------------------------------------------------------------------
@plan("valid_ratings", "WITH " + CONV_SCENES_SQL + """
SELECT scene_id, funny, sad FROM conv_scenes WHERE funny BETWEEN 1 AND 5 AND sad BETWEEN 1 AND 5
""")
def valid_ratings(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    return s.filter(fd.valid_ratings("funny", "sad")).select("scene_id", "funny", "sad")


@plan("source_rating", "WITH " + CONV_SCENES_SQL + """
SELECT scene_id, CASE WHEN conv_id % 2 = 0 THEN 'labels' ELSE 'model' END AS source,
       CASE WHEN conv_id % 2 = 0 THEN funny ELSE CAST(length(text) % 6 AS INTEGER) END AS rating
FROM conv_scenes
""")
def source_rating(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir).withColumn(
        "source", F.when(F.col("conv_id") % 2 == 0, F.lit("labels")).otherwise(F.lit("model"))) \
        .withColumn("predicted_funny", (F.length("text") % 6).cast("int"))
    return s.select("scene_id", "source", fd.source_rating("source", "funny", "predicted_funny").alias("rating"))


# B7 ----------------------------------------------------------------------------------
@plan("cast_label_types", r"""
WITH t AS (
  SELECT doc_id,
    CASE doc_id % 4 WHEN 0 THEN ' ' || (quality + 1) || ' ' WHEN 1 THEN 'x' WHEN 2 THEN (quality + 1) || '.0'
                    ELSE CAST(quality + 1 AS VARCHAR) END AS funny,
    CAST(toxic + 1 AS VARCHAR) AS sad,
    CASE doc_id % 3 WHEN 0 THEN '0.5' WHEN 1 THEN ' 1 ' ELSE 'n/a' END AS position
  FROM labels
)
SELECT doc_id,
  CASE WHEN regexp_full_match(trim(funny), '[+-]?[0-9]+') THEN TRY_CAST(trim(funny) AS INTEGER) END AS funny,
  CASE WHEN regexp_full_match(trim(sad), '[+-]?[0-9]+') THEN TRY_CAST(trim(sad) AS INTEGER) END AS sad,
  TRY_CAST(trim(position) AS DOUBLE) AS position
FROM t
""")
def cast_label_types(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    k4, k3 = F.col("doc_id") % 4, F.col("doc_id") % 3
    q = (F.col("quality") + 1).cast("string")
    t = lab.select(
        "doc_id",
        F.when(k4 == 0, F.concat(F.lit(" "), q, F.lit(" "))).when(k4 == 1, F.lit("x"))
         .when(k4 == 2, F.concat(q, F.lit(".0"))).otherwise(q).alias("funny"),
        (F.col("toxic") + 1).cast("string").alias("sad"),
        F.when(k3 == 0, F.lit("0.5")).when(k3 == 1, F.lit(" 1 ")).otherwise(F.lit("n/a")).alias("position"))
    return fd.cast_label_types(t)


# B9 ----------------------------------------------------------------------------------
@plan("season_episode_code", "WITH " + CONV_SCENES_SQL + r"""
SELECT DISTINCT episode_id, 'S' || season || '.E' || episode AS code,
       regexp_replace('S' || season || '.E' || episode, 'S(\d+)\.E(\d+)', '\1_\2') AS season_episode,
       printf('%d_%02d', season, episode) AS padded
FROM conv_scenes
""")
def season_episode_code(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir).select(
        "episode_id", F.concat(F.lit("S"), F.col("season").cast("string"), F.lit(".E"),
                               F.col("episode").cast("string")).alias("code")).distinct()
    se = fd.season_episode_code("code")
    return s.select("episode_id", "code", se.alias("season_episode"), fd.pad_episode_id(se).alias("padded"))


# B11 ---------------------------------------------------------------------------------
@plan("project_labeled", "WITH " + CONV_SCENES_SQL + """
SELECT episode_id, scene_id, funny, sad, text,
       coalesce(lag(text) OVER (PARTITION BY episode_id ORDER BY scene_idx), '') AS prev_scene_text,
       round(CASE WHEN count(*) OVER (PARTITION BY episode_id) > 1
                  THEN scene_idx / (count(*) OVER (PARTITION BY episode_id) - 1) ELSE 0.0 END, 4) AS position
FROM conv_scenes
""")
def project_labeled(spark, sf_dir):
    from moodframe.operators import sequence
    s = conversation_scenes(spark, sf_dir)
    s = sequence.dense_index(s, ["episode_id"], ["scene_idx"], index_col="i", count_col="n")
    s = sequence.prev_scene_text(s, "episode_id", "scene_idx", "text")
    s = s.withColumn("position", sequence.scene_position("i", "n")).withColumn("updated_at", F.current_timestamp())
    return fd.project_labeled(s)


# B12 ---------------------------------------------------------------------------------
@plan("split_errors", """
WITH r AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 2) ELSE props END AS props FROM events),
p AS (SELECT event_id, CASE WHEN json_valid(props) THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
      FROM r)
SELECT event_id, k, CASE WHEN k IS NULL THEN 'malformed record' END AS error FROM p
""")
def split_errors(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    props = F.when(F.col("event_id") % 10 == 0, F.expr("substr(props, 2)")).otherwise(F.col("props"))
    parsed = F.from_json(props, "k long")
    d = e.select("event_id", parsed["k"].alias("k"))
    d = d.withColumn("error", F.when(F.col("k").isNull(), F.lit("malformed record")))
    good, bad = fd.split_errors(d)
    return good.unionByName(bad)


# B14 ---------------------------------------------------------------------------------
@plan("one_based_labels", """
SELECT doc_id, quality + 1 AS funny, toxic + 1 AS sad, quality AS funny_class, toxic AS sad_class FROM labels
""")
def one_based_labels(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    r = lab.select("doc_id", fd.to_rating("quality").alias("funny"), fd.to_rating("toxic").alias("sad"))
    return r.select("doc_id", "funny", "sad", fd.to_class("funny").alias("funny_class"),
                    fd.to_class("sad").alias("sad_class"))


# B15 ---------------------------------------------------------------------------------
@plan("model_name_parts", r"""
WITH g AS (
  SELECT p_partkey, 'org/' || replace(lower(p_brand), '#', '-') AS backbone,
         CASE WHEN p_size % 2 = 0 THEN 'AdamW' ELSE 'SGD' END AS optimizer,
         p_partkey % 2 = 0 AS dropout,
         CASE WHEN p_size % 3 = 0 THEN 'cls' ELSE 'mean_pooling' END AS encoding
  FROM part
),
n AS (
  SELECT p_partkey, translate(backbone, '-/', '__') || '_' || optimizer || '_' ||
         CASE WHEN dropout THEN 'with_dropout' ELSE 'without_dropout' END || '_' || encoding || '_results' AS model
  FROM g
)
SELECT p_partkey, model,
  regexp_extract(model, '^(.*)_([A-Za-z]+)_(with|without)_dropout_(cls|mean_pooling)_results$', 1) AS backbone,
  regexp_extract(model, '^(.*)_([A-Za-z]+)_(with|without)_dropout_(cls|mean_pooling)_results$', 2) AS optimizer,
  regexp_extract(model, '^(.*)_([A-Za-z]+)_(with|without)_dropout_(cls|mean_pooling)_results$', 3) = 'with' AS dropout,
  regexp_extract(model, '^(.*)_([A-Za-z]+)_(with|without)_dropout_(cls|mean_pooling)_results$', 4) AS encoding
FROM n
""")
def model_name_parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    g = p.select("p_partkey",
                 F.concat(F.lit("org/"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-"))).alias("backbone"),
                 F.when(F.col("p_size") % 2 == 0, F.lit("AdamW")).otherwise(F.lit("SGD")).alias("optimizer"),
                 (F.col("p_partkey") % 2 == 0).alias("dropout"),
                 F.when(F.col("p_size") % 3 == 0, F.lit("cls")).otherwise(F.lit("mean_pooling")).alias("encoding"))
    n = g.select("p_partkey", fd.model_name("backbone", "optimizer", "dropout", "encoding").alias("model"))
    return n.select("p_partkey", "model", *fd.parse_model_name("model"))

"""Plans for ordered sequences and episode roll-ups (F1, F2, F4, F6, E1, E2,
H1, H3) on ``conversations`` (episodes of scenes) and ``events`` (long
per-user sequences)."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.operators import metrics, sequence
from moodframe.plans.registry import plan
from moodframe.plans.tables import (CONV_SCENES_SQL, EVENT_RATINGS_SQL, conversation_scenes,
                                    event_ratings)


def _r(c, places=6):
    return F.round(F.col(c), places).alias(c)


METRIC_COLS = ["funny_mean", "funny_var", "funny_change", "sad_mean", "sad_var", "sad_change"]

_METRICS_SQL_TAIL = """
flagged AS (
  SELECT *, (funny BETWEEN 1 AND 5 AND sad BETWEEN 1 AND 5) AS ok FROM {src}
),
lagged AS (
  SELECT *,
    lag(funny) OVER w AS pf, lag(sad) OVER w AS ps, lag(ok) OVER w AS pok
  FROM flagged WINDOW w AS (PARTITION BY {keys} ORDER BY {order})
)
SELECT {keys},
  round(avg(funny), 6) AS funny_mean,
  round(var_samp(funny), 6) AS funny_var,
  round(avg(CASE WHEN pok THEN abs(funny - pf) END), 6) AS funny_change,
  round(avg(sad), 6) AS sad_mean,
  round(var_samp(sad), 6) AS sad_var,
  round(avg(CASE WHEN pok THEN abs(sad - ps) END), 6) AS sad_change
FROM lagged WHERE ok
GROUP BY {keys}
"""


# E2 (flagship) ------------------------------------------------------------------
def episode_rating_metrics_conv(spark, sf_dir):
    scenes = conversation_scenes(spark, sf_dir)
    m = metrics.episode_rating_metrics(scenes, keys=["episode_id"], order="scene_idx")
    return m.select("episode_id", *[_r(c) for c in METRIC_COLS])


plan("episode_rating_metrics", "WITH " + CONV_SCENES_SQL + "," + _METRICS_SQL_TAIL.format(
    src="conv_scenes", keys="episode_id", order="scene_idx"))(episode_rating_metrics_conv)


# E2 at scale: one long sequence per user ordered by time ----------------------------
@plan("episode_rating_metrics_events", "WITH " + EVENT_RATINGS_SQL + "," + _METRICS_SQL_TAIL.format(
    src="event_ratings", keys="user_id", order="ts"))
def episode_rating_metrics_events(spark, sf_dir):
    ev = event_ratings(spark, sf_dir)
    m = metrics.episode_rating_metrics(ev, keys=["user_id"], order="ts")
    return m.select("user_id", *[_r(c) for c in METRIC_COLS])


# F1 ---------------------------------------------------------------------------------
@plan("prev_scene_text", "WITH " + CONV_SCENES_SQL + """
SELECT episode_id, scene_id, scene_idx,
       coalesce(lag(text) OVER (PARTITION BY episode_id ORDER BY scene_idx), '') AS prev_scene_text
FROM conv_scenes
""")
def prev_scene_text(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    out = sequence.prev_scene_text(s, "episode_id", "scene_idx", "text")
    return out.select("episode_id", "scene_id", "scene_idx", "prev_scene_text")


# F2 ---------------------------------------------------------------------------------
@plan("abs_change", "WITH " + EVENT_RATINGS_SQL + """,
f AS (SELECT *, (funny BETWEEN 1 AND 5 AND sad BETWEEN 1 AND 5) AS ok FROM event_ratings),
l AS (SELECT *, lag(funny) OVER w AS pf, lag(sad) OVER w AS ps, lag(ok) OVER w AS pok
      FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, event_id, funny, sad,
       CAST(CASE WHEN ok AND pok THEN abs(funny - pf) END AS INTEGER) AS funny_change,
       CAST(CASE WHEN ok AND pok THEN abs(sad - ps) END AS INTEGER) AS sad_change
FROM l
""")
def abs_change(spark, sf_dir):
    from moodframe.functions.fields import valid_ratings
    ev = event_ratings(spark, sf_dir)
    out = sequence.abs_change(ev, ["user_id"], ["ts"], ["funny", "sad"], valid_ratings("funny", "sad"))
    return out.select("user_id", "event_id", "funny", "sad",
                      F.col("funny_change").cast("int").alias("funny_change"),
                      F.col("sad_change").cast("int").alias("sad_change"))


# F4 ---------------------------------------------------------------------------------
@plan("scene_index", """
SELECT user_id, event_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS scene_no,
       CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS n_scenes
FROM events
""")
def scene_index(spark, sf_dir):
    from moodframe.plans.tables import table
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    out = sequence.dense_index(ev, ["user_id"], ["ts"], index_col="scene_no", count_col="n_scenes",
                               base=1)
    return out.select("user_id", "event_id", "scene_no", "n_scenes")


# F6 ---------------------------------------------------------------------------------
@plan("durbin_watson", """
WITH r AS (SELECT event_type, ts, value - avg(value) OVER (PARTITION BY event_type) AS e FROM events),
l AS (SELECT event_type, e, e - lag(e) OVER (PARTITION BY event_type ORDER BY ts) AS d FROM r)
SELECT event_type, round(sum(d * d) / sum(e * e), 6) AS durbin_watson FROM l GROUP BY event_type
""")
def durbin_watson(spark, sf_dir):
    from moodframe.plans.tables import table
    ev = table(spark, sf_dir, "events").select("event_type", "ts", "value")
    means = ev.groupBy("event_type").agg(F.avg("value").alias("__m"))
    r = ev.join(means, "event_type").select(
        "event_type", "ts", (F.col("value") - F.col("__m")).alias("e"))
    dw = sequence.durbin_watson(r, "e", ["ts"], keys=["event_type"])
    return dw.select("event_type", _r("durbin_watson"))


# E1 ---------------------------------------------------------------------------------
@plan("scenes_per_episode", "WITH " + CONV_SCENES_SQL + """
SELECT episode_id, CAST(count(*) OVER (PARTITION BY episode_id) AS BIGINT) AS n_scenes,
       CAST(row_number() OVER (PARTITION BY episode_id ORDER BY scene_idx) - 1 AS INTEGER) AS pos,
       scene_id
FROM conv_scenes
""")
def scenes_per_episode(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    e = metrics.scenes_per_episode(s, keys=["episode_id"], order="scene_idx", cols=["scene_id"])
    return e.select("episode_id", "n_scenes", F.posexplode("scenes").alias("pos", "sc")) \
            .select("episode_id", "n_scenes", F.col("pos").cast("int").alias("pos"), "sc.scene_id")


# H1 ---------------------------------------------------------------------------------
@plan("union_sources", "WITH " + CONV_SCENES_SQL + """,
u AS (
  SELECT 'labels' AS source, episode_id, scene_idx, funny, sad FROM conv_scenes
  UNION ALL
  SELECT 'model_a' AS source, episode_id, scene_idx,
         CAST(length(text) % 6 AS INTEGER) AS funny, CAST((scene_idx + length(role)) % 6 AS INTEGER) AS sad
  FROM conv_scenes
),
flagged AS (SELECT *, (funny BETWEEN 1 AND 5 AND sad BETWEEN 1 AND 5) AS ok FROM u),
lagged AS (SELECT *, lag(funny) OVER w AS pf, lag(sad) OVER w AS ps, lag(ok) OVER w AS pok
           FROM flagged WINDOW w AS (PARTITION BY source, episode_id ORDER BY scene_idx))
SELECT source, episode_id,
  round(avg(funny), 6) AS funny_mean, round(var_samp(funny), 6) AS funny_var,
  round(avg(CASE WHEN pok THEN abs(funny - pf) END), 6) AS funny_change,
  round(avg(sad), 6) AS sad_mean, round(var_samp(sad), 6) AS sad_var,
  round(avg(CASE WHEN pok THEN abs(sad - ps) END), 6) AS sad_change
FROM lagged WHERE ok GROUP BY source, episode_id
""")
def union_sources(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    labels = s.select("episode_id", "scene_idx", "funny", "sad")
    model_a = s.select("episode_id", "scene_idx",
                       (F.length("text") % 6).cast("int").alias("predicted_funny"),
                       ((F.col("scene_idx") + F.length("role")) % 6).cast("int").alias("predicted_sad"))
    u = metrics.union_sources({"labels": labels, "model_a": model_a})
    m = metrics.episode_rating_metrics(u, keys=["source", "episode_id"], order="scene_idx")
    return m.select("source", "episode_id", *[_r(c) for c in METRIC_COLS])


# H3 ---------------------------------------------------------------------------------
@plan("distinct_episodes", "WITH " + CONV_SCENES_SQL + """
SELECT DISTINCT episode_id, season, episode FROM conv_scenes
""")
def distinct_episodes(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    return metrics.distinct_values(s, ["episode_id", "season", "episode"])

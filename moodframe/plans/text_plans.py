"""Parsing plans (C10-C15) on strings built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.functions import parse as ps
from moodframe.functions import text as tx
from moodframe.operators import evaluate as ev
from moodframe.operators import sequence
from moodframe.plans.registry import plan
from moodframe.plans.tables import CONV_SCENES_SQL, conversation_scenes, table


# C10 -------------------------------------------------------------------------------
@plan("extract_numbered_titles", r"""
WITH c AS (
  SELECT p_partkey, printf('%d. "%s" and %d.  " %s "', p_size, p_name, p_partkey % 100, p_type) AS cell
  FROM part
),
z AS (SELECT p_partkey, regexp_extract_all(cell, '(\d+)\.\s*"(.+?)"', 1) AS ns,
             regexp_extract_all(cell, '(\d+)\.\s*"(.+?)"', 2) AS ts FROM c)
SELECT p_partkey, CAST(ns[i] AS INTEGER) AS number, trim(ts[i]) AS title
FROM (SELECT p_partkey, ns, ts, unnest(range(1, len(ns) + 1)) AS i FROM z)
""")
def extract_numbered_titles(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    cell = F.format_string('%d. "%s" and %d.  " %s "', "p_size", "p_name", F.col("p_partkey") % 100, "p_type")
    out = p.select("p_partkey", F.inline(ps.numbered_titles(cell)))
    return out.orderBy("number", "title")


# C11 -------------------------------------------------------------------------------
@plan("parse_histogram", r"""
WITH bars AS (
  SELECT user_id, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS INTEGER) AS star,
         count(*) AS votes
  FROM events GROUP BY ALL
),
lab AS (
  SELECT user_id, star, votes,
         CASE WHEN star % 3 = 0 THEN upper(printf('%d %d-star reviews', votes * 1000 + 234, star))
              ELSE printf('  %d  %d-star reviews', votes, star) END AS label
  FROM bars
)
SELECT user_id,
       CAST(replace(regexp_extract(label, '(?i)(\d{1,3}(?:,\d{3})+|\d+)\s+(\d+)-star\s+reviews', 1), ',', '') AS BIGINT) AS votes,
       CAST(regexp_extract(label, '(?i)(\d{1,3}(?:,\d{3})+|\d+)\s+(\d+)-star\s+reviews', 2) AS INTEGER) AS stars
FROM lab
""")
def parse_histogram(spark, sf_dir):
    from moodframe.plans.stats_plans import event_histogram
    h = event_histogram(spark, sf_dir)
    label = F.when(F.col("star") % 3 == 0,
                   F.upper(F.format_string("%d %d-star reviews", F.col("votes") * 1000 + 234, "star"))) \
             .otherwise(F.format_string("  %d  %d-star reviews", "votes", "star"))
    votes, stars = ps.histogram_bar(label)
    bars = h.select("user_id", votes.alias("votes"), stars.alias("stars"))
    # last bar wins per star: one bar per star here, so the max-by is exact
    return bars.groupBy("user_id", "stars").agg(F.max("votes").alias("votes")).select("user_id", "votes", "stars")


# C12 -------------------------------------------------------------------------------
PROMPT = "at {position}\nbefore: {prev_scene_text}\nnow: {text}\ngive two numbers\n"
_PROMPT_SQL = PROMPT.replace("'", "''").replace("\n", "' || chr(10) || '")


@plan("render_prompt", "WITH " + CONV_SCENES_SQL + f""",
s AS (
  SELECT scene_id, text,
         coalesce(lag(text) OVER (PARTITION BY episode_id ORDER BY scene_idx), '') AS prev_scene_text,
         round(CASE WHEN count(*) OVER (PARTITION BY episode_id) > 1
                    THEN (row_number() OVER (PARTITION BY episode_id ORDER BY scene_idx) - 1)
                         / (count(*) OVER (PARTITION BY episode_id) - 1) ELSE 0.0 END, 4) AS position
  FROM conv_scenes
)
SELECT scene_id,
       replace(replace(replace('{_PROMPT_SQL}', '{{position}}', CAST(round(position, 3) AS VARCHAR)),
               '{{prev_scene_text}}', prev_scene_text), '{{text}}', text) AS prompt
FROM s
""")
def render_prompt(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    s = sequence.dense_index(s, ["episode_id"], ["scene_idx"], index_col="i", count_col="n")
    s = sequence.prev_scene_text(s, "episode_id", "scene_idx", "text")
    s = s.withColumn("position", sequence.scene_position("i", "n"))
    return s.select("scene_id", ps.render_prompt(PROMPT).alias("prompt"))


# C13 -------------------------------------------------------------------------------
_REPLY_SQL = """
r AS (
  SELECT conv_id, turn,
    CASE conv_id % 8
      WHEN 0 THEN ''
      WHEN 1 THEN 'Funny: ' || (turn % 6)
      WHEN 2 THEN 'Funny: ' || (turn % 6) || chr(10) || chr(10) || 'Sad: ' || (length(text) % 6)
      WHEN 3 THEN 'Funny: 4.5' || chr(10) || 'Sad: ' || (length(text) % 6)
      WHEN 4 THEN 'Funny:' || (turn % 6) || chr(10) || 'Sad: ' || (length(text) % 6)
      WHEN 5 THEN 'Funny: ' || (turn % 7 + 1) || chr(10) || 'Sad:  ' || (length(text) % 6) || ' '
      WHEN 6 THEN NULL
      ELSE 'Funny: ' || (turn % 6) || chr(10) || 'Sad: ' || (length(text) % 6)
    END AS reply
  FROM conversations
)"""


@plan("parse_response", "WITH " + _REPLY_SQL + r""",
p AS (
  SELECT conv_id, turn, reply,
    trim(string_split(string_split(reply, chr(10))[1], ': ')[2]) AS a,
    trim(string_split(string_split(reply, chr(10))[2], ': ')[2]) AS b
  FROM r
),
q AS (
  SELECT conv_id, turn, reply IS NULL OR reply = '' AS empty,
    CASE WHEN regexp_full_match(a, '[+-]?[0-9]+') THEN TRY_CAST(a AS INTEGER) END AS f,
    CASE WHEN regexp_full_match(b, '[+-]?[0-9]+') THEN TRY_CAST(b AS INTEGER) END AS s
  FROM p
)
SELECT conv_id, turn,
  CASE WHEN empty OR f IS NULL OR s IS NULL THEN 0 ELSE f END AS predicted_funny,
  CASE WHEN empty OR f IS NULL OR s IS NULL THEN 0 ELSE s END AS predicted_sad,
  NOT empty AND (f IS NULL OR s IS NULL) AS parse_error
FROM q
""")
def parse_response(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    t6 = (F.col("turn") % 6).cast("string")
    l6 = (F.length("text") % 6).cast("string")
    nl = F.lit("\n")
    k = F.col("conv_id") % 8
    reply = (F.when(k == 0, F.lit(""))
              .when(k == 1, F.concat(F.lit("Funny: "), t6))
              .when(k == 2, F.concat(F.lit("Funny: "), t6, nl, nl, F.lit("Sad: "), l6))
              .when(k == 3, F.concat(F.lit("Funny: 4.5"), nl, F.lit("Sad: "), l6))
              .when(k == 4, F.concat(F.lit("Funny:"), t6, nl, F.lit("Sad: "), l6))
              .when(k == 5, F.concat(F.lit("Funny: "), (F.col("turn") % 7 + 1).cast("string"), nl,
                                     F.lit("Sad:  "), l6, F.lit(" ")))
              .when(k == 6, F.lit(None).cast("string"))
              .otherwise(F.concat(F.lit("Funny: "), t6, nl, F.lit("Sad: "), l6)))
    f, s, bad = ps.parse_reply(reply)
    return c.select("conv_id", "turn", f.alias("predicted_funny"), s.alias("predicted_sad"),
                    bad.alias("parse_error"))


# C14 -------------------------------------------------------------------------------
@plan("safe_name", """
WITH o AS (
  SELECT DISTINCT 'funny' AS axis, CAST((l_orderkey + l_linenumber) % 5 + 1 AS INTEGER) AS label,
         CASE WHEN (l_orderkey + l_linenumber) % 5 + 1 = l_partkey % 6 THEN 'Classified Correctly'
              WHEN l_partkey % 6 = 0 THEN 'Not Classified'
              WHEN l_partkey % 6 > (l_orderkey + l_linenumber) % 5 + 1 THEN 'Classified Too High'
              ELSE 'Classified Too Low' END AS outcome
  FROM lineitem
)
SELECT axis, label, outcome,
       axis || '_' || label || '_' || regexp_replace(replace(outcome, ' ', '_'), '[()]', '', 'g') || '.json' AS file_name
FROM o
""")
def safe_name(spark, sf_dir):
    from moodframe.plans.evaluation_plans import predictions
    rows, _ = ev.with_outcome(ev.axis_rows(predictions(spark, sf_dir), keep=[], axes=["funny"]))
    d = rows.select("axis", "label", "outcome").distinct()
    return d.withColumn("file_name", F.concat_ws("_", "axis", F.col("label").cast("string"),
                                                 F.concat(tx.safe_name("outcome"), F.lit(".json"))))


# C15 -------------------------------------------------------------------------------
@plan("truncate_tokens", r"""
WITH t AS (
  SELECT doc_id, regexp_replace(text, '^[\t\n\f\r ]+|[\t\n\f\r ]+\z', '', 'g') AS tt FROM documents
),
k AS (SELECT doc_id, CASE WHEN tt = '' THEN []::VARCHAR[] ELSE string_split_regex(tt, '[\t\n\f\r ]+') END AS toks FROM t)
SELECT doc_id, array_to_string(toks[1:512], ' ') AS kept_text, CAST(len(toks[1:512]) AS INTEGER) AS n_kept,
       CAST(len(toks) AS INTEGER) AS n_tokens
FROM k
""")
def truncate_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    kept, n_kept, n_all = tx.truncate_tokens("text", tx.MAX_TOKENS, unicode=False)
    return d.select("doc_id", kept.alias("kept_text"), n_kept.alias("n_kept"), n_all.alias("n_tokens"))

"""Plans of the operators for sizes that the plain forms do not reach: long
documents (C8), filtered backlogs (D4, J9), wide vectors (E12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.functions import text as tx
from moodframe.operators import backlog_filter as bf
from moodframe.operators.gram import vector_correlations
from moodframe.operators.long_segment import segment_long_documents as segment_lines
from moodframe.plans.registry import ORACLE, plan
from moodframe.plans.scoring_plans import doc_scenes, existing_predictions
from moodframe.plans.segment_plans import _lines
from moodframe.plans.tables import table

DIMENSIONS = 64


@plan("segment_long_documents", ORACLE["segment_scenes"])
def segment_long_documents(spark, sf_dir):
    return segment_lines(_lines(spark, sf_dir, 6), ws=tx.WS_ASCII)


@plan("filtered_backlog", ORACLE["scoring_backlog"])
def filtered_backlog(spark, sf_dir):
    scored = existing_predictions(spark, sf_dir)
    # two runs' ids: the second is merged into the first one's stored filter
    early = F.pmod(F.xxhash64("scene_id"), F.lit(2)) == 0
    path = bf.write_filter(spark, scored.filter(early))
    path = bf.write_filter(spark, scored.filter(~early), old=path)
    return bf.filtered_backlog(doc_scenes(spark, sf_dir), scored, spark.read.parquet(path)).select("scene_id")


@plan("vector_correlations", f"""
WITH v AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT unnest(range(0, {DIMENSIONS})) AS d)
SELECT CAST(a.d AS INTEGER) AS dim_a, CAST(b.d AS INTEGER) AS dim_b, round(corr(v[a.d + 1], v[b.d + 1]), 6) AS corr
FROM v, d a, d b GROUP BY a.d, b.d
""")
def correlations_of_dimensions(spark, sf_dir):
    c = vector_correlations(table(spark, sf_dir, "embeddings"), "embedding", DIMENSIONS)
    return c.select("dim_a", "dim_b", F.round("corr", 6).alias("corr"))

"""Source and sink plans (A1-A10, H2): each writes derived data to a fresh
folder under the shared checkpoint directory and reads it back with the
library readers; the result is compared with SQL on the original tables."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodframe.operators import evaluate as ev
from moodframe.operators import sequence
from moodframe.plans.evaluation_plans import PRED_SQL, SUMMARY_SQL, predictions
from moodframe.plans.registry import plan
from moodframe.plans.tables import CONV_SCENES_SQL, conversation_scenes, table
from moodframe.session import scratch_path
from moodframe.sources import readers as rd
from moodframe.sources import writers as wr

_POS_SQL = "WITH " + CONV_SCENES_SQL + """,
sp AS (SELECT *, round(CASE WHEN count(*) OVER (PARTITION BY episode_id) > 1
                            THEN scene_idx / (count(*) OVER (PARTITION BY episode_id) - 1) ELSE 0.0 END, 4) AS position
       FROM conv_scenes)"""


def _scenes_with_position(spark, sf_dir):
    s = conversation_scenes(spark, sf_dir)
    s = sequence.dense_index(s, ["episode_id"], ["scene_idx"], index_col="__i", count_col="__n")
    return s.withColumn("position", sequence.scene_position("__i", "__n")).withColumn("source", F.lit("wiki"))


def _write_episodes(spark, sf_dir):
    path = scratch_path(spark, "episodes")
    wr.write_episodes(_scenes_with_position(spark, sf_dir), path)
    return path


@plan("read_episodes", _POS_SQL + """
SELECT season, episode, CAST(scene_idx AS INTEGER) AS scene_idx, scene_id, position, text FROM sp
""")
def read_episodes(spark, sf_dir):
    path = _write_episodes(spark, sf_dir)
    e = rd.read_episodes(spark, f"{path}/*/*.json", multiline=False)
    return e.select("season", "episode", "scene_idx", "scene_id", "position", "text")


@plan("write_episodes", "WITH " + CONV_SCENES_SQL + """
SELECT season, episode_id, CAST(count(*) AS INTEGER) AS n_scenes FROM conv_scenes GROUP BY season, episode_id
""")
def write_episodes(spark, sf_dir):
    path = _write_episodes(spark, sf_dir)
    docs = spark.read.schema(rd.EPISODE_DOC.add("season_dir", T.IntegerType())) \
        .json(path).withColumn("season", F.regexp_extract(F.col("_metadata.file_path"), r"/season=(\d+)/", 1).cast("int"))
    return docs.select("season", "episode_id", F.size("scenes").alias("n_scenes"))


@plan("read_labels_json", "SELECT CAST(doc_id AS VARCHAR) AS scene_id, quality + 1 AS funny, toxic + 1 AS sad FROM labels")
def read_labels_json(spark, sf_dir):
    path = scratch_path(spark, "labels-json")
    lab = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("scene_id"), (F.col("quality") + 1).cast("string").alias("funny"),
        (F.col("toxic") + 1).cast("string").alias("sad"), F.lit(None).cast("string").alias("updated_at"))
    wr.write_records_json(lab, path)
    return rd.read_labels_json(spark, path).select("scene_id", "funny", "sad")


PRED_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("l_orderkey",)] +
                           [T.StructField("l_linenumber", T.IntegerType())] +
                           [T.StructField(c, T.IntegerType()) for c in
                            ("true_funny", "predicted_funny", "true_sad", "predicted_sad")])


def _two_dirs(spark, sf_dir):
    base = scratch_path(spark, "prediction-dirs")
    p = predictions(spark, sf_dir)
    p.filter(F.substring("model", 1, 1) != "R").write.partitionBy("model").json(f"{base}/llm")
    p.filter(F.substring("model", 1, 1) == "R").write.partitionBy("model").json(f"{base}/encoder")
    return rd.read_predictions(spark, [f"{base}/llm", f"{base}/encoder"], PRED_SCHEMA, model_from="partition")


@plan("read_predictions", "WITH " + PRED_SQL + """
SELECT model, l_orderkey, l_linenumber, true_funny, predicted_funny, true_sad, predicted_sad FROM p
""")
def read_predictions(spark, sf_dir):
    return _two_dirs(spark, sf_dir).select("model", "l_orderkey", "l_linenumber", "true_funny", "predicted_funny",
                                           "true_sad", "predicted_sad")


@plan("union_prediction_dirs", "WITH " + SUMMARY_SQL + " SELECT * FROM summary")
def union_prediction_dirs(spark, sf_dir):
    return ev.evaluation_summary(_two_dirs(spark, sf_dir))


@plan("read_histograms", """
SELECT event_type AS episode_id, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS INTEGER) AS star,
       count(*) AS votes
FROM events GROUP BY ALL
""")
def read_histograms(spark, sf_dir):
    from moodframe.plans.stats_plans import event_histogram
    path = scratch_path(spark, "histograms")
    h = event_histogram(spark, sf_dir, "event_type")
    # one record per episode with a {star: votes} map (at most 10 entries)
    rec = h.groupBy("event_type").agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("star").cast("string"), F.col("votes")))).alias("ratings_histogram"))
    wr.write_records_json(rec.withColumnRenamed("event_type", "episode_id"), path)
    return rd.read_histograms(spark, path)


@plan("read_url_list", """
SELECT trim(url) AS url FROM pages
""")
def read_url_list(spark, sf_dir):
    path = scratch_path(spark, "url-list")
    p = table(spark, sf_dir, "pages")
    lines = p.select(F.concat(F.lit("  "), F.col("url"), F.lit(" ")).alias("value")).unionByName(
        p.filter(F.col("page_id") % 5 == 0).select(F.lit("   ").alias("value")))
    lines.write.text(path)
    return rd.read_url_list(spark, path)


_REPLY = """CASE WHEN page_id % 7 = 0 THEN '{"batchcomplete": ""}'
     ELSE '{"query": {"categorymembers": [{"title": "Category:Season ' || (page_id % 6 + 1) ||
          ' Transcripts"}, {"title": "' || url || '"}]}, "continue": {"cmcontinue": "p' || page_id || '"}}' END"""


@plan("explode_members", f"""
WITH r AS (SELECT page_id, {_REPLY} AS reply FROM pages),
m AS (SELECT page_id, json_extract_string(reply, '$.query.categorymembers[*].title') AS titles,
             json_extract_string(reply, '$.continue.cmcontinue') AS cmcontinue FROM r)
SELECT page_id, CAST(u.i - 1 AS INTEGER) AS member_no, u.t AS title, cmcontinue
FROM m, unnest(m.titles) WITH ORDINALITY AS u(t, i)
""")
def explode_members(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    reply = F.when(pid % 7 == 0, F.lit('{"batchcomplete": ""}')).otherwise(F.concat(
        F.lit('{"query": {"categorymembers": [{"title": "Category:Season '), (pid % 6 + 1).cast("string"),
        F.lit(' Transcripts"}, {"title": "'), F.col("url"), F.lit('"}]}, "continue": {"cmcontinue": "p'),
        pid.cast("string"), F.lit('"}}')))
    return rd.explode_members(p.select("page_id", reply.alias("reply")), "reply", keep=["page_id"]).select(
        "page_id", F.col("member_no").cast("int").alias("member_no"), "title", "cmcontinue")


@plan("write_records_json", "WITH " + CONV_SCENES_SQL + " SELECT scene_id, funny, sad, text FROM conv_scenes")
def write_records_json(spark, sf_dir):
    path = scratch_path(spark, "records")
    s = conversation_scenes(spark, sf_dir).select("scene_id", "funny", "sad", "text")
    wr.write_records_json(s, path)
    return spark.read.schema(s.schema).json(path)


@plan("write_outcome_slices", "WITH " + PRED_SQL + """,
models AS (SELECT DISTINCT model FROM p),
dom AS (
  SELECT m.model, a.axis, l.label, oc.outcome
  FROM models m
  CROSS JOIN (SELECT unnest(['funny', 'sad']) AS axis) a
  CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS label) l
  CROSS JOIN (SELECT unnest(['Classified Correctly', 'Classified Too High', 'Classified Too Low',
                             'Not Classified']) AS outcome) oc
),
cnt AS (SELECT model, axis, label, outcome, count(*) AS n FROM o GROUP BY ALL)
SELECT d.model, d.axis, d.label, replace(d.outcome, ' ', '_') AS outcome_key,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_written, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM dom d LEFT JOIN cnt c USING (model, axis, label, outcome)
""")
def write_outcome_slices(spark, sf_dir):
    path = scratch_path(spark, "outcome-slices")
    rows, _ = ev.with_outcome(ev.axis_rows(predictions(spark, sf_dir), keep=["model", "l_orderkey", "l_linenumber"]))
    wr.write_outcome_slices(rows, ev.outcome_counts(rows), path)
    written = spark.read.json(f"{path}/slices").groupBy("model", "axis", "label", "outcome_key") \
        .agg(F.count(F.lit(1)).alias("n_written"))
    counts = spark.read.schema("model string, axis string, label int, outcome string, n long, outcome_key string") \
        .json(f"{path}/_counts")
    # the dense count table (<= models x 40 rows) is the driving side of the join
    out = counts.join(written, ["model", "axis", "label", "outcome_key"], "left")
    return out.select("model", "axis", F.col("label").cast("int").alias("label"), "outcome_key",
                      F.coalesce("n_written", F.lit(0)).cast("long").alias("n_written"), "n")


@plan("write_summary_csv", "WITH " + SUMMARY_SQL + " SELECT * FROM summary")
def write_summary_csv(spark, sf_dir):
    path = scratch_path(spark, "summary-csv")
    wr.write_summary_csv(ev.evaluation_summary(predictions(spark, sf_dir)), path)
    schema = "model string, funny_or_sad string, true_label string, accuracy double, precision double, " \
             "recall double, f1 double"
    return spark.read.schema(schema).option("header", True).csv(path)


# Readers on folders with spaces, indented arrays and broken records ------------------
def _indented(df, columns):
    """One indented JSON array of all rows of a (small) group, as one line of text."""
    item = F.to_json(F.struct(*columns), {"pretty": "true"})
    return F.concat(F.lit("[\n"), F.array_join(F.collect_list(item), ",\n"), F.lit("\n]"))


def _write_as_files(df, path, folder, name):
    """Each row's ``value`` as one file ``folder/name`` below ``path``, through the
    file system of the path (a fixture: one file per season or model)."""
    spark = df.sparkSession
    rows = df.select(folder.alias("folder"), name.alias("name"), "value").collect()  # one row per season or model: a few
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in rows:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{r.folder}", r.name)
        out = p.getFileSystem(conf).create(p)
        out.write(bytearray(r.value, "utf-8"))
        out.close()


def _write_arrays(df, path, split=False):
    """Rows (folder, name, item) as files ``folder/name`` below ``path``, each an
    indented array of the items of one batch. Tasks write them: with ``split``
    into a folder per batch (of 10,000 rows at most), so that files of one name
    are of bounded size; else each (folder, name) must be one row."""
    def run(batches):
        files = 0
        for k, b in enumerate(batches):
            fs, base = FileSystem.from_uri(path)
            groups = {}
            for folder, name, item in zip(*(b.column(c).to_pylist() for c in ("folder", "name", "item")), strict=True):
                groups.setdefault((folder, name), []).append(item)
            for (folder, name), items in groups.items():
                at = f"{base}/{folder} {TaskContext.get().partitionId()}-{k}" if split else f"{base}/{folder}"
                fs.create_dir(at, recursive=True)
                # in whole or not at all, also when a task is run again
                unfinished = f"{at}/_{TaskContext.get().taskAttemptId()}-{files}"
                with fs.open_output_stream(unfinished) as out:
                    out.write(("[\n" + ",\n".join(items) + "\n]").encode())
                fs.move(unfinished, f"{at}/{name}")
                files += 1
        yield pa.RecordBatch.from_pydict({"files": [files]})

    path = re.sub("^file:/*", "file:///", path)
    df.select("folder", "name", "item").mapInArrow(run, "files long").agg(F.sum("files")).collect()


def _season_files(spark, sf_dir):
    path = scratch_path(spark, "season-files")
    s = _scenes_with_position(spark, sf_dir)
    docs = s.groupBy("season", "episode").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("scene_idx", "scene_id", "position", "text"))),
        lambda x: F.struct(x["scene_id"], x["position"], x["text"])).alias("scenes"))
    docs = docs.withColumn("source", F.lit("My Thing transcript")).withColumn("episode", F.col("episode").cast("string"))
    item = F.to_json(F.struct("source", "episode", "scenes"), {"pretty": "true"})
    _write_arrays(docs.select(F.format_string("Season %d Transcripts", "season").alias("folder"),
                              F.format_string("ep_%02d_My_Thing.json", F.col("episode").cast("int")).alias("name"), item.alias("item")), path)
    # an object as episode, a broken record, and a file outside of the season folders for each season
    season, notes = F.format_string("Season %d Transcripts", "season"), F.format_string("Notes %d", "season")
    files = [(season, "ep_07_Object.json", '[{"episode": {"n": 4}, "scenes": [{"text": "object"}]}]'),
             (season, "ep_08_Broken.json", '[{"scenes": '), (notes, "ep_01_A.json", '[{"scenes": []}]')]
    extra = docs.select("season").distinct().select(F.inline(F.array(*(
        F.struct(folder.alias("folder"), F.lit(name).alias("name"), F.lit(value).alias("value")) for folder, name, value in files))))
    _write_as_files(extra, path, F.col("folder"), F.col("name"))
    return path


@plan("read_season_folders", _POS_SQL + """
SELECT season, episode, 'My Thing' AS title, CAST(scene_idx AS INTEGER) AS scene_idx, scene_id, position, text FROM sp
UNION ALL SELECT DISTINCT season, 0, 'Object', 0, season || '_00_1', NULL::DOUBLE, 'object' FROM sp
""")
def read_season_folders(spark, sf_dir):
    e = rd.read_episodes(spark, f"{_season_files(spark, sf_dir)}/*/*.json")
    return e.select("season", "episode", "title", "scene_idx", "scene_id", "position", "text")


@plan("episode_rejects", """
WITH s AS (SELECT DISTINCT conv_id % 6 + 1 AS season FROM conversations)
SELECT 'Season ' || season || ' Transcripts' AS folder, 'ep_08_Broken' AS stem, 'broken record' AS reason FROM s
UNION ALL SELECT 'Notes ' || season, 'ep_01_A', 'not in a season folder' FROM s
""")
def episode_rejects(spark, sf_dir):
    from moodframe.functions.fields import path_parts
    r = rd.episode_rejects(spark, f"{_season_files(spark, sf_dir)}/*/*.json")
    folder, stem = path_parts("path")
    return r.select(folder.alias("folder"), stem.alias("stem"), "reason")


@plan("read_indented_predictions", "WITH " + PRED_SQL + """
SELECT 'model ' || model AS model, l_orderkey, l_linenumber, true_funny, predicted_funny, true_sad, predicted_sad
FROM p
""")
def read_indented_predictions(spark, sf_dir):
    return _indented_predictions(spark, sf_dir)


def _indented_predictions(spark, sf_dir):
    """All predictions, written to indented arrays and read again."""
    path = scratch_path(spark, "indented-predictions")
    p = predictions(spark, sf_dir)
    item = F.to_json(F.struct(*(c for c in p.columns if c != "model")), {"pretty": "true"})
    _write_arrays(p.select(F.lit("all").alias("folder"), F.format_string("model %s.json", "model").alias("name"), item.alias("item")),
                  path, split=True)
    return rd.read_predictions(spark, [f"{path}/*"], PRED_SCHEMA, multiline=True)


@plan("read_indented_histograms", """
SELECT event_type AS episode_id, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS INTEGER) AS star,
       count(*) AS votes
FROM events GROUP BY ALL
""")
def read_indented_histograms(spark, sf_dir):
    from moodframe.plans.stats_plans import event_histogram
    path = scratch_path(spark, "indented-histograms")
    rec = event_histogram(spark, sf_dir, "event_type").groupBy(F.col("event_type").alias("episode_id")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("star").cast("string"), F.col("votes")))).alias("ratings_histogram"))
    arrays = rec.agg(_indented(rec, rec.columns).alias("value"))  # one record per event type
    _write_as_files(arrays, path, F.lit("all"), F.lit("ratings.json"))
    return rd.read_histograms(spark, f"{path}/all", multiline=True)

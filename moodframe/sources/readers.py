"""Readers. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodframe.functions import fields as fd
from moodframe.functions.text import explode_positions, utrim

SCENE = T.StructType([T.StructField("scene_id", T.StringType()), T.StructField("position", T.DoubleType()),
                      T.StructField("text", T.StringType())])
EPISODE_DOC = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("episode_id", T.StringType()),
    T.StructField("season", T.StringType()), T.StructField("episode", T.StringType()),
    T.StructField("scenes", T.ArrayType(SCENE)),
])
LABEL_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("scene_id", "funny", "sad", "updated_at")])
CATEGORY_REPLY = T.StructType([
    T.StructField("query", T.StructType([T.StructField("categorymembers", T.ArrayType(
        T.StructType([T.StructField("title", T.StringType())])))])),
    T.StructField("continue", T.StructType([T.StructField("cmcontinue", T.StringType())])),
])


# A1 --------------------------------------------------------------------------
def _episode_docs(spark: SparkSession, path: str, multiline: bool, schema: T.StructType) -> DataFrame:
    """Episode documents with season, episode and title, and the ``reason`` why
    a document cannot be used (NULL if it can)."""
    read = T.StructType([*schema.fields, T.StructField("__broken", T.StringType())])
    df = (spark.read.schema(read).option("multiLine", multiline).option("columnNameOfCorruptRecord", "__broken").json(path)
          .withColumn("__path", F.col("_metadata.file_path")))
    folder, stem = fd.path_parts("__path")
    part = F.regexp_extract(F.col("__path"), r"/season=(\d+)/", 1)
    folder_season = F.coalesce(fd.season_from_folder(folder), F.when(part != "", part.cast("int")))
    # an episode that is an object says nothing about the number
    doc_episode = F.when(F.ltrim("episode").startswith("{"), F.lit(0)).otherwise(F.expr("try_cast(episode AS INT)"))
    return df.select(
        F.coalesce(F.expr("try_cast(season AS INT)"), folder_season).alias("season"),
        F.coalesce(doc_episode, fd.episode_from_stem(stem)).alias("episode"),
        fd.episode_title(F.col("source"), stem).alias("title"), "scenes", F.col("__path").alias("path"),
        F.when(F.col("__broken").isNotNull(), F.lit("broken record"))
         .when(folder_season.isNull(), F.lit("not in a season folder"))
         .when(F.col("scenes").isNull(), F.lit("no scenes")).alias("reason"))


def read_episodes(spark: SparkSession, path: str, multiline: bool = True,
                  schema: T.StructType = EPISODE_DOC) -> DataFrame:
    """Episode documents below season folders -> one row per scene.

    Season comes from the document, else from a ``Season N Transcripts``
    folder (any case) or a ``season=N`` partition folder. Episode comes from the
    document (0 if it is an object there), else ``ep_<n>_`` in the file name,
    else 0. Scene ids are re-assigned as ``S_EE_n``. Files in other folders and
    broken records are left to ``episode_rejects``."""
    d = _episode_docs(spark, path, multiline, schema).filter(F.col("reason").isNull())
    s = explode_positions(d, "scenes", ["season", "episode", "title"], "scene_idx", "scene")
    return s.select(
        "season", "episode", "title", F.col("scene_idx").cast("int").alias("scene_idx"),
        fd.episode_id_build("season", "episode").alias("episode_id"),
        fd.scene_id_build("season", "episode", F.col("scene_idx") + 1).alias("scene_id"),
        F.col("scene.position").alias("position"), F.col("scene.text").alias("text"))


def episode_rejects(spark: SparkSession, path: str, multiline: bool = True,
                    schema: T.StructType = EPISODE_DOC) -> DataFrame:
    """(path, reason) of the documents that ``read_episodes`` leaves out."""
    return _episode_docs(spark, path, multiline, schema).filter(F.col("reason").isNotNull()).select("path", "reason")


# A2 --------------------------------------------------------------------------
def read_labels_json(spark: SparkSession, path: str, schema: T.StructType = LABEL_TEXT,
                     multiline: bool = False) -> DataFrame:
    """Label records whose values are all text, cast to their types (bad
    values become NULL)."""
    df = spark.read.schema(schema).option("multiLine", multiline).json(path)
    out = fd.cast_label_types(df, int_cols=[c for c in ("funny", "sad") if c in schema.fieldNames()],
                              float_cols=())
    if "updated_at" in schema.fieldNames():
        out = out.withColumn("updated_at", F.expr("try_cast(updated_at AS TIMESTAMP_NTZ)"))
    return out


# A3 --------------------------------------------------------------------------
def read_predictions(spark: SparkSession, dirs: Sequence[str], schema: T.StructType,
                     model_from: str = "stem", multiline: bool = False) -> DataFrame:
    """Every file of the given folders; ``model`` = file stem (one file per
    model), the ``folder`` a file lies in, or the ``model=`` partition folder.
    ``multiline`` reads indented arrays. A record that does not parse is an
    error, never a row of NULLs."""
    out = None
    for d in dirs:
        df = spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(d)
        if "model" in df.columns and "model" not in schema.fieldNames():
            df = df.drop("model")  # discovered partition column; re-derived below
        if model_from == "stem":
            model = fd.path_parts(F.col("_metadata.file_path"))[1]
        elif model_from == "folder":
            model = fd.path_parts(F.col("_metadata.file_path"))[0]
        else:
            model = F.regexp_extract(F.col("_metadata.file_path"), r"/model=([^/]+)/", 1)
        df = df.withColumn("model", model)
        # H2: the folders are chained one after the other
        out = df if out is None else out.unionByName(df)
    return out


# A4 --------------------------------------------------------------------------
def read_histograms(spark: SparkSession, path: str, key: str = "episode_id",
                    map_col: str = "ratings_histogram", multiline: bool = False) -> DataFrame:
    """Records with a ``{star: votes}`` map whose keys are text -> rows
    ``(key, star int, votes long)``. ``multiline`` reads indented arrays; a
    record that does not parse is an error."""
    schema = T.StructType([T.StructField(key, T.StringType()),
                           T.StructField(map_col, T.MapType(T.StringType(), T.LongType()))])
    df = spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)
    e = df.select(key, F.explode(map_col).alias("__k", "votes"))
    return e.select(key, F.expr("try_cast(__k AS INT)").alias("star"), "votes")


# A5 --------------------------------------------------------------------------
def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """Text file, one URL per line: trimmed, blank lines dropped."""
    t = spark.read.text(path).select(utrim("value").alias("url"))
    return t.filter(F.col("url") != "")


# A6 --------------------------------------------------------------------------
def explode_members(replies: DataFrame, reply_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Paged category replies (JSON text) -> one row per member title, with
    the continuation token. A reply without the expected keys gives no rows."""
    r = replies.withColumn("__r", F.from_json(reply_col, CATEGORY_REPLY))
    members = F.coalesce(F.col("__r.query.categorymembers"),
                         F.array().cast(T.ArrayType(CATEGORY_REPLY["query"].dataType["categorymembers"].dataType.elementType)))
    d = r.select(*keep, F.col("__r.continue.cmcontinue").alias("cmcontinue"), members.alias("__m"))
    e = explode_positions(d, "__m", [*keep, "cmcontinue"], "member_no", "m")
    return e.select(*keep, "member_no", F.col("m.title").alias("title"), "cmcontinue")

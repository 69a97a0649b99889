"""Label tables: newest-wins reads, upserts, validation, migration, lookups
(SURVEY D1, D7, B13, F3, G1, G2, G3, I1-I3).

Newest-wins is a group-by with ``max(struct(...))``, not a
``row_number()`` window: the aggregate is combined map-side, so a scene that
received a third of all posts still costs one small partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodframe.functions.fields import RATING_MAX, RATING_MIN
from moodframe.operators.sequence import _listify

LABEL_COLUMNS = ["scene_id", "funny", "sad", "updated_at"]


# F3 --------------------------------------------------------------------------
def latest_per_key(df: DataFrame, key, time_col: str = "updated_at", tie=None,
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key: ``ORDER BY time DESC NULLS LAST, tie DESC``, first
    row kept. A NULL time loses to any known time; ties go to the larger
    tie-breaker column(s)."""
    keys = _listify(key)
    tie = _listify(tie)
    cols = [c for c in (cols or df.columns) if c not in keys]
    order = [F.col(time_col).isNotNull().alias("__known"), F.col(time_col).alias("__t")] + \
            [F.col(t).alias(f"__tie{i}") for i, t in enumerate(tie)]
    best = F.max(F.struct(*order, *[F.col(c).alias(c) for c in cols])).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__best")[c].alias(c) for c in cols])


# I1 --------------------------------------------------------------------------
def upsert_labels(current: DataFrame, posts: DataFrame, key: str = "scene_id",
                  time_col: str = "updated_at", tie=None) -> DataFrame:
    """Insert new keys, replace ratings and time of existing ones (newest
    wins). Batch form of ``INSERT ... ON CONFLICT DO UPDATE``: union, then
    newest per key. Write the result to a new path (no in-place table format
    is assumed)."""
    u = current.unionByName(posts, allowMissingColumns=True)
    return latest_per_key(u, key, time_col, tie)


def stamp_now(posts: DataFrame, time_col: str = "updated_at") -> DataFrame:
    """Give posts the current UTC time (naive), as a label server does."""
    return posts.withColumn(time_col, F.to_timestamp_ntz(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                      "yyyy-MM-dd HH:mm:ss.SSSSSS")))


# I2 --------------------------------------------------------------------------
def validate_labels(posts: DataFrame, key: str = "scene_id", funny: str = "funny",
                    sad: str = "sad", check_unique: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reason``). Rules: key present, both
    ratings present, integer and in 1..5; optionally the key is unique in
    the batch (a primary-key check by count, no self-join of rows)."""
    def whole(c):
        """The integer that a number or text stands for; NULL for 4.5 as for "x"."""
        number = F.expr(f"try_cast(`{c}` AS DOUBLE)")
        return F.when(number == F.floor(number), number.try_cast("int"))

    f, s = whole(funny), whole(sad)
    reason = (F.when(F.col(key).isNull(), F.lit("missing scene_id"))
               .when(F.col(funny).isNull() | F.col(sad).isNull(), F.lit("missing rating"))
               .when(f.isNull() | s.isNull(), F.lit("rating not an integer"))
               .when(~f.between(RATING_MIN, RATING_MAX) | ~s.between(RATING_MIN, RATING_MAX),
                     F.lit("rating outside 1..5")))
    d = posts.withColumn("reason", reason)
    if check_unique:
        dup = posts.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1) \
                   .select(key, F.lit(True).alias("__dup"))
        d = d.join(dup, key, "left").withColumn(
            "reason", F.coalesce(F.col("reason"), F.when(F.col("__dup"), F.lit("duplicate scene_id"))))
        d = d.drop("__dup")
    good = d.filter(F.col("reason").isNull()).drop("reason") \
            .withColumn(funny, f).withColumn(sad, s)
    bad = d.filter(F.col("reason").isNotNull())
    return good, bad


# I3 --------------------------------------------------------------------------
def migrate_labels(table: DataFrame, key: str = "scene_id", time_col: str = "updated_at",
                   tie=None, user_col: str = "username") -> DataFrame:
    """Old per-user table -> one row per scene (newest); a current table is
    returned unchanged."""
    if user_col not in table.columns:
        return table
    latest = latest_per_key(table, key, time_col, tie)
    return latest.select(*[c for c in LABEL_COLUMNS if c in latest.columns])


# D1 --------------------------------------------------------------------------
def labeled_scenes(labels: DataFrame, scenes: DataFrame, key: str = "scene_id",
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Inner equi-join of labels and scenes (duplicates multiply), projected
    to the labeled-scene columns (B11)."""
    from moodframe.functions.fields import LABELED_COLUMNS
    cols = list(columns or LABELED_COLUMNS)
    j = labels.join(scenes, key, "inner")
    return j.select(*[c for c in cols if c in j.columns])


# B13 -------------------------------------------------------------------------
def label_status(scenes: DataFrame, labels: DataFrame, key: str = "scene_id",
                 time_col: str = "updated_at") -> DataFrame:
    """Per scene: its label if any and a ``labeled`` flag."""
    lab = labels.withColumn("__has", F.lit(True))
    j = scenes.join(lab, key, "left")
    return j.withColumn("labeled", F.coalesce(F.col("__has"), F.lit(False))).drop("__has")


# D7 / G2 ---------------------------------------------------------------------
def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup; a missing key gives no row. The filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def labels_for_scene(labels: DataFrame, scene_id, key: str = "scene_id",
                     time_col: str = "updated_at") -> DataFrame:
    return lookup(labels, key, scene_id).orderBy(F.col(time_col).asc_nulls_first())


# G1 / G3 ---------------------------------------------------------------------
def sorted_by(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Global sort (range-partitioned by Spark, no single-task sort)."""
    return df.orderBy(*cols)

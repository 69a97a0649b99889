"""Scoring scenes with a user model, only where no score exists yet
(SURVEY D4-D6, J8, J9).

The scorer runs in Arrow batches (``mapInPandas``): the model is loaded once
per Python worker and sees whole batches, never single rows. The backlog
anti-join is placed *before* the scorer by construction (Catalyst does not
push an anti-join below ``mapInPandas``), so known scenes are never scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodframe.operators.sequence import _listify

Scorer = Callable[[pd.DataFrame], pd.DataFrame]
PRED_COLS = ("predicted_funny", "predicted_sad")


def length_scorer(text_col: str = "text") -> Scorer:
    """Deterministic stand-in model (vectorised): funny = characters mod 6,
    sad = lines mod 6. 0 means 'no answer', as with a failed model reply."""
    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pdf[text_col].fillna("")
        return pd.DataFrame({
            "predicted_funny": (t.str.len() % 6).astype("int32"),
            "predicted_sad": ((t.str.count("\n") + 1) % 6).astype("int32"),
        })
    return score


# J8 --------------------------------------------------------------------------
def score_rows(df: DataFrame, scorer: Scorer | Callable[[], Scorer] | None = None,
               keep: Sequence[str] | None = None, text_col: str = "text",
               factory: bool = False) -> DataFrame:
    """Apply ``scorer`` to Arrow batches, keep the row metadata and add
    ``predicted_funny`` / ``predicted_sad`` (ints). With ``factory=True``
    ``scorer`` is called once per task to build the model. Without a scorer the
    stand-in reads ``text_col``."""
    scorer = scorer or length_scorer(text_col)
    keep = list(keep or [c for c in df.columns])
    cols = list(dict.fromkeys(keep + [text_col]))
    schema_in = df.select(*cols).schema
    out_fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema_in.fields if f.name in keep]
    out_schema = ", ".join(out_fields + ["predicted_funny int", "predicted_sad int"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = scorer() if factory else scorer
        for pdf in batches:
            pred = fn(pdf)
            out = pdf[keep].reset_index(drop=True)
            for c in PRED_COLS:
                out[c] = pd.to_numeric(pred[c], errors="coerce").fillna(0).astype("int32").values
            yield out

    return df.select(*cols).mapInPandas(run, out_schema)


# D4 --------------------------------------------------------------------------
def scoring_backlog(scenes: DataFrame, scored: DataFrame, key="scene_id") -> DataFrame:
    """Scenes that have no prediction yet (left anti join on the key)."""
    keys = _listify(key)
    return scenes.join(scored.select(*keys), keys, "left_anti")


# D5 --------------------------------------------------------------------------
def merge_predictions(existing: DataFrame, new: DataFrame, key="scene_id", order_col: str | None = None) -> DataFrame:
    """Existing predictions plus new ones, one row per key, existing wins.
    Columns missing on one side (``true_*`` on new rows) become NULL. Of several
    rows of one side with a key, the highest ``order_col`` wins, then the
    highest values. One shuffle: both sides meet in one partial aggregate."""
    return prefer_by_priority([existing, new], key, order_col)


# D6 --------------------------------------------------------------------------
def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists on its file system (a driver-side metadata
    call; no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def prefer_source(spark: SparkSession, primary: str, fallback: str,
                  reader: Callable[[str], DataFrame], key="scene_id", order_col: str | None = None) -> DataFrame:
    """Read ``primary`` when it exists, else ``fallback``. One row per key: the
    highest ``order_col`` wins (rows have no order of their own), then the
    highest values. Only a missing path falls back (a broken file is an error,
    not a silent switch)."""
    src = primary if path_exists(spark, primary) else fallback
    return prefer_by_priority([reader(src)], key, order_col)


def prefer_by_priority(frames: Sequence[DataFrame], key="scene_id", order_col: str | None = None) -> DataFrame:
    """Row-level form of D6: stack the sources with a priority (first frame
    wins) and keep the best row per key. Partial aggregation: no window."""
    keys = _listify(key)
    u = None
    for i, f in enumerate(frames):
        f = f.withColumn("__prio", F.lit(-i))
        u = f if u is None else u.unionByName(f, allowMissingColumns=True)
    cols = [c for c in u.columns if c not in keys and c != "__prio"]
    order = [F.col("__prio")] + ([F.col(order_col).alias("__order")] if order_col else [])
    best = F.max(F.struct(*order, *[F.col(c).alias(c) for c in cols])).alias("__b")
    return u.groupBy(*keys).agg(best).select(*keys, *[F.col("__b")[c].alias(c) for c in cols])


# J9 --------------------------------------------------------------------------
def incremental_scores(spark: SparkSession, scenes: DataFrame, out_path: str,
                       scorer: Scorer | None = None, key="scene_id",
                       keep: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Score only the backlog and append it as a new part of ``out_path``.
    Safe to restart: a rerun finds the appended keys and scores nothing new.
    The reference rewrites the whole file after each scene (O(n^2)); here
    each run appends once."""
    keys = _listify(key)
    todo = prefer_by_priority([scenes], keys)  # a repeated scene is scored once
    if path_exists(spark, out_path):
        existing = spark.read.format(fmt).option("mergeSchema", "true").load(out_path)
        todo = scoring_backlog(todo, existing, keys)
    scored = score_rows(todo, scorer, keep=keep)
    scored.write.mode("append").format(fmt).save(out_path)
    # parts written by different runs may differ in nullable extra columns
    return spark.read.format(fmt).option("mergeSchema", "true").load(out_path)

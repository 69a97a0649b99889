"""Episode roll-ups: scene lists, rating metrics, histogram moments and the
join between them (SURVEY E1-E3, D2, H1-H3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodframe.functions.fields import valid_ratings
from moodframe.operators.sequence import _listify, abs_change


# H1 --------------------------------------------------------------------------
def union_sources(frames: Mapping[str, DataFrame], source_col: str = "source",
                  label_source: str = "labels", funny: str = "funny", sad: str = "sad",
                  predicted_prefix: str = "predicted_") -> DataFrame:
    """Stack several rating frames under one ``source`` column, with the
    rating of each source in ``funny``/``sad`` (human labels for the label
    source, ``predicted_*`` for models: B8)."""
    out = None
    for name, df in frames.items():
        if name != label_source and predicted_prefix + funny in df.columns:
            df = (df.drop(*[c for c in (funny, sad) if c in df.columns])
                    .withColumnRenamed(predicted_prefix + funny, funny)
                    .withColumnRenamed(predicted_prefix + sad, sad))
        df = df.withColumn(source_col, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


# H2 --------------------------------------------------------------------------
def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# H3 --------------------------------------------------------------------------
def distinct_values(df: DataFrame, cols) -> DataFrame:
    return df.select(*_listify(cols)).distinct()


# E1 --------------------------------------------------------------------------
def scenes_per_episode(scenes: DataFrame, keys=("source", "episode_id"), order: str = "scene_idx",
                       cols=("scene_id", "text")) -> DataFrame:
    """Ordered scene list per episode. An episode's scenes are cut from one
    page, so the list is never larger than the page row it came from."""
    keys, cols = _listify(keys), _listify(cols)
    item = F.struct(F.col(order).alias(order), *[F.col(c) for c in cols])
    return scenes.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("scenes"),
                                     F.count(F.lit(1)).alias("n_scenes"))


# E2 --------------------------------------------------------------------------
def episode_rating_metrics(scenes: DataFrame, keys=("source", "episode_id"), order="scene_idx",
                           funny: str = "funny", sad: str = "sad", long_groups: bool = False) -> DataFrame:
    """Per episode, over the valid scenes (both ratings in 1..5): mean, sample
    variance and mean absolute change of both ratings. Change needs the scene
    just before to be valid too (lag before the filter). Too few values give
    NULL rather than an error. Partial aggregation keeps hot episodes cheap."""
    keys = _listify(keys)
    d = scenes.withColumn("__valid", valid_ratings(funny, sad))
    d = abs_change(d, keys, order, [funny, sad], F.col("__valid"), long_groups=long_groups)
    d = d.filter(F.col("__valid"))
    return d.groupBy(*keys).agg(
        F.avg(funny).alias(f"{funny}_mean"),
        F.var_samp(funny).alias(f"{funny}_var"),
        F.avg(f"{funny}_change").alias(f"{funny}_change"),
        F.avg(sad).alias(f"{sad}_mean"),
        F.var_samp(sad).alias(f"{sad}_var"),
        F.avg(f"{sad}_change").alias(f"{sad}_change"),
    )


# E3 --------------------------------------------------------------------------
def histogram_metrics(hist: DataFrame, keys, star: str = "star", votes: str = "votes",
                      prefix: str = "imdb_rating_") -> DataFrame:
    """Mean, population variance and the shares of 1 and 10 stars of a vote
    histogram ``(keys, star, votes)``. Weighted sums: the votes are never
    expanded to one row each. The variance numerator ``N*S2 - S1^2`` is
    computed exactly in decimal, so there is no cancellation."""
    keys = _listify(keys)
    s = F.col(star).cast("long")
    v = F.col(votes).cast("long")
    agg = hist.groupBy(*keys).agg(
        F.sum(v).alias("__n"),
        F.sum(s * v).alias("__s1"),
        F.sum((s * s * v).cast("decimal(38,0)")).alias("__s2"),
        F.sum(F.when(s == 1, v).otherwise(0)).alias("__n1"),
        F.sum(F.when(s == 10, v).otherwise(0)).alias("__n10"),
    ).filter(F.col("__n") > 0)
    n = F.col("__n").cast("decimal(38,0)")
    s1 = F.col("__s1").cast("decimal(38,0)")
    num = (n * F.col("__s2") - s1 * s1).cast("double")
    nd = F.col("__n").cast("double")
    return agg.select(
        *keys,
        (F.col("__s1") / nd).alias(f"{prefix}mean"),
        (num / (nd * nd)).alias(f"{prefix}variance"),
        (F.col("__n1") / nd).alias(f"{prefix}share_1"),
        (F.col("__n10") / nd).alias(f"{prefix}share_10"),
    )


# D2 --------------------------------------------------------------------------
def attach_histogram_metrics(metrics: DataFrame, hist_metrics: DataFrame, on) -> tuple[DataFrame, DataFrame]:
    """(metrics joined to their histogram metrics, keys with no histogram).

    The reference fails on a missing key; here the missing keys come back as a
    second frame (a left-anti join) so the caller can raise or report."""
    on = _listify(on)
    joined = metrics.join(hist_metrics, on, "inner")
    missing = metrics.select(*on).distinct().join(hist_metrics.select(*on), on, "left_anti")
    return joined, missing

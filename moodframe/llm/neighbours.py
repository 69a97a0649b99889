"""The next row in a global descending order, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodframe.llm.common import parallelism

_LOWEST = -(2 ** 63)


def _bounds_passed(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds are <= key: a binary search in the row."""
    if not bounds:
        return F.lit(0)
    array, n = F.lit(bounds), len(bounds)
    steps = [1 << k for k in reversed(range(n.bit_length()))]
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(array, at + step - 1) <= key), at + step).otherwise(at))


def with_next(df: DataFrame, id_col: str, carried: list[str], tie: str) -> DataFrame:
    """``df`` with a struct column ``next``: the ``carried`` columns of the row
    with the next lower ``id_col`` (a long); the last row gets the first row's.

    Rows are dealt into ranges of ids by approximate quantiles, one range per
    shuffle partition, so each task sorts its own range. The driver holds one
    bound and one highest id per range, nothing that grows with the rows. The
    first row of each range is also sent to the range above, where it closes
    that range. Null ids count as the lowest; equal ids are ordered by ``tie``.
    The rows are shuffled once.
    """
    key = F.coalesce(F.col(id_col), F.lit(_LOWEST))
    parts = parallelism(df.sparkSession)
    shares = [k / parts for k in range(1, parts)]
    bounds = df.select(F.percentile_approx(key, shares, 10_000)).first()[0] if shares else None
    bucket = _bounds_passed(sorted(set(bounds or [])), key)
    heads = {r.b: r.top for r in df.select(bucket.alias("b"), key.alias("k")).groupBy("b")
             .agg(F.max("k").alias("top")).collect()}
    if not heads:
        return df.withColumn("next", F.lit(None).cast(df.select(F.struct(*carried)).schema[0].dataType))
    order = sorted(heads)
    above = dict(zip(order, [*order[1:], order[0]], strict=True))
    size = order[-1] + 1
    tops = F.lit([heads.get(b, 0) for b in range(size)])
    targets = F.lit([above.get(b, 0) for b in range(size)])

    placed = df.select("*", key.alias("__key"), bucket.alias("__b"))
    own = F.struct(F.col("__b").alias("part"), F.lit(0).alias("extra"))
    closing = F.struct(F.get(targets, F.col("__b")).alias("part"), F.lit(1).alias("extra"))
    dealt = placed.select(*df.columns, "__key", F.explode(F.when(
        F.get(tops, F.col("__b")) == F.col("__key"), F.array(own, closing)).otherwise(F.array(own))).alias("__at"))
    # plain columns only: whatever a window has to compute is shuffled as a further copy
    flat = dealt.select(*df.columns, "__key", F.col("__at.part").alias("__part"), F.col("__at.extra").alias("__extra"))
    w = Window.partitionBy("__part").orderBy("__extra", F.desc("__key"), tie)
    led = flat.select("*", *(F.lead(c).over(w).alias(f"__next_{c}") for c in carried)).filter("__extra = 0")
    return led.select(*df.columns, F.struct(*(F.col(f"__next_{c}").alias(c) for c in carried)).alias("next"))

"""D4 / J9 with a Bloom filter over the scored ids.

The filter is a table of 64-bit words: an id sets ``BITS`` bits of the one word
that its hash picks. It is built by partial aggregation (``bit_or``), so every
task sends a word at most once, and a new run's ids are merged into a stored
filter the same way. The number of words is chosen when a filter is built, never
above ``MAX_WORDS``, which bounds the broadcast to every task.

A scene whose bits are not all set has no score for sure and goes straight to
the backlog, in the task that read it. Only the others, the scored scenes and
the few that share bits by chance, are shuffled into the exact anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodframe.operators.scoring import scoring_backlog
from moodframe.operators.sequence import _listify
from moodframe.session import scratch_path

#: Bits that an id sets, ids that share a word when a filter is built, and words of the largest filter.
BITS, IDS_PER_WORD, MAX_WORDS = 4, 4, 1 << 20


def _word(keys: list[str], words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(words))


def _mask(keys: list[str]) -> Column:
    """The bits that an id sets: four places of six bits each from one hash."""
    h = F.xxhash64(F.lit(2), *keys)
    mask = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def build_filter(scored: DataFrame, key="scene_id", words: int | None = None) -> DataFrame:
    """(word, bits, words): the filter over the keys of ``scored``; null keys are
    left out, as no key equals them."""
    keys = _listify(key)
    ids = scored.select(*keys).dropna()
    if words is None:
        words = min(MAX_WORDS, max(64, -(-ids.count() // IDS_PER_WORD)))
    return ids.select(_word(keys, words).alias("word"), _mask(keys).alias("bits")).groupBy("word").agg(
        F.bit_or("bits").alias("bits")).withColumn("words", F.lit(words).cast("long"))


def write_filter(spark: SparkSession, scored: DataFrame, key="scene_id", old: str | None = None) -> str:
    """Write the filter of ``scored``, merged with the stored filter ``old`` (a
    folder), to a new folder and return it. The old one stays as it is."""
    path = scratch_path(spark, "scored-filter")
    if old is None:
        build_filter(scored, key).write.parquet(path)
        return path
    before = spark.read.parquet(old)
    words = before.agg(F.max("words")).first()[0]
    new = build_filter(scored, key, words or None)
    before.unionByName(new).groupBy("word", "words").agg(F.bit_or("bits").alias("bits")).write.parquet(path)
    return path


def split_by_filter(scenes: DataFrame, filter_: DataFrame, key="scene_id") -> tuple[DataFrame, DataFrame]:
    """(new, doubtful): scenes that are in no filter for sure, and the rest."""
    keys = _listify(key)
    words = filter_.agg(F.max("words")).first()[0]
    if not words:
        return scenes, scenes.limit(0)
    held = F.broadcast(filter_.select(F.col("word").alias("__word"), F.col("bits").alias("__bits")))  # at most MAX_WORDS rows
    mask = _mask(keys)
    probed = scenes.withColumn("__word", _word(keys, words)).join(held, "__word", "left")
    known = F.coalesce(F.col("__bits").bitwiseAND(mask) == mask, F.lit(False))
    for k in keys:
        known = known & F.col(k).isNotNull()
    return probed.filter(~known).select(*scenes.columns), probed.filter(known).select(*scenes.columns)


def filtered_backlog(scenes: DataFrame, scored: DataFrame, filter_: DataFrame, key="scene_id") -> DataFrame:
    """The rows of ``scoring_backlog``, most of them without a shuffle. ``filter_``
    must hold all keys of ``scored``; keys that it holds beside them cost work only."""
    new, doubtful = split_by_filter(scenes, filter_, key)
    return new.unionByName(scoring_backlog(doubtful, scored, key))

"""C8 on documents longer than a task: scenes by pointer doubling.

The greedy fold of ``segment.with_scenes`` reads a document from its first line
to its last. Here every line is a row, and the fold becomes a jump table: the
scene that begins at a line ends before the first line that no longer fits, and
that line is the jump. Scene starts are the orbit of line 0. Jumps of 2^k lines
of starts are composed by a join of the table with itself, and the starts known
so far are doubled by a join with the table, so a document of s scenes takes
log2(s) + 1 rounds, whatever its length.

The texts are written once and wait; up to the last steps only numbers are
moved. No array holds a document. Groups are bounded: ``BLOCK`` lines for prefix sums,
``max_words`` word counts for the jumps, one scene for its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodframe.functions import text as tx
from moodframe.operators import sequence
from moodframe.session import scratch_path

#: Lines whose words are summed in one task.
BLOCK = 4_096


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sums_before(df: DataFrame, key: str, at: str, value: str, out_col: str) -> DataFrame:
    """The sum of ``value`` over the earlier rows of a key, whose rows are
    numbered from 0 by ``at``. Inside blocks of rows by a window, across blocks
    by one row per block."""
    d = df.withColumn("__block", F.floor(F.col(at) / BLOCK))
    inside = Window.partitionBy(key, "__block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = d.groupBy(key, "__block").agg(F.sum(value).alias("__total"))
    blocks = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(key).alias("__key"), F.col("__block").alias("__of"),
                            F.coalesce(F.sum("__total").over(blocks), F.lit(0)).alias("__offset"))
    joined = d.join(offsets, d[key].eqNullSafe(offsets["__key"]) & (d["__block"] == offsets["__of"]))
    return joined.select(*df.columns, (F.col("__inside") + F.col("__offset")).alias(out_col))


def _jumps(lines: DataFrame, max_words: int) -> DataFrame:
    """(doc, idx, next): the first line after ``idx`` that does not fit into the
    scene that begins at ``idx``; no row if all lines after it fit."""
    # the words up to and with a line, in buckets of max_words words; line -1 stands for the beginning
    sums = lines.select("doc", "idx", (F.col("before") + F.col("words")).alias("sum")).unionByName(
        lines.filter("idx = 0").select("doc", (F.col("idx") - 1).alias("idx"), F.lit(0).cast("long").alias("sum")))
    least = sums.groupBy("doc", "sum").agg(F.min("idx").alias("idx"))
    buckets = least.groupBy("doc", F.floor(F.col("sum") / max_words).alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("sum", "idx"))).alias("held"))
    # a bucket's two successors, from sorted ranges in falling order
    buckets = buckets.withColumn("__down", -F.col("bucket")).withColumn("first", F.struct("bucket", F.col("held")[0].alias("low")))
    led = sequence.prev_values(buckets, ["doc"], ["__down"], ["bucket", "held", "first"], prefix="n1_", long_groups=True)
    led = sequence.prev_values(led, ["doc"], ["__down"], ["n1_first"], prefix="n2_", long_groups=True)
    found = lines.select("doc", "idx", "before", F.floor(F.col("before") / max_words).alias("bucket")).join(
        led.select("doc", "bucket", "n1_bucket", "n1_held", F.col("n2_n1_first").alias("beyond")), ["doc", "bucket"])
    fits = F.filter("n1_held", lambda x: x["sum"] > F.col("before") + max_words)
    target = F.when(F.col("n1_bucket").isNull(), None).otherwise(F.coalesce(F.get(fits, 0)["idx"], F.col("beyond.low.idx")))
    # a line that is too long by itself is a scene of its own
    return found.select("doc", "idx", F.greatest(target, F.col("idx") + 1).alias("next"), target.isNull().alias("none")).filter(
        "not none").select("doc", "idx", "next")


def scene_starts(lines: DataFrame, max_words: int) -> DataFrame:
    """(doc, idx) of the lines at which scenes begin, from rows (doc, idx, words, before)."""
    size = lines.groupBy("doc").agg(F.count("*").alias("n"))
    jumps = _stored(_jumps(lines, max_words).join(size, "doc").filter("next < n").drop("n"), "jumps")
    starts = lines.filter("idx = 0").select("doc", "idx")
    while not jumps.isEmpty():
        ahead = starts.join(jumps, ["doc", "idx"]).select("doc", F.col("next").alias("idx"))
        starts = _stored(starts.unionByName(ahead), "starts")
        after = jumps.select("doc", F.col("idx").alias("next"), F.col("next").alias("beyond"))
        jumps = _stored(jumps.join(after, ["doc", "next"]).select("doc", "idx", F.col("beyond").alias("next")), "jumps")
    return starts


def segment_long_documents(lines: DataFrame, doc: str = "doc_id", order: str = "line_no", line: str = "line",
                           max_words: int = tx.MAX_WORDS, ws: str = tx.WS) -> DataFrame:
    """Rows (doc, scene_idx, n_scenes, n_words, text) from rows (doc, order,
    line), as ``segment.with_scenes`` packs the lines of a document. ``order``
    need not be dense but must not repeat in a document; a null doc is a document
    of its own. Lines are taken as they are (null counts as empty). An empty
    table gives an empty result."""
    d = lines.select(F.struct(F.col(doc).alias("id")).alias("doc"), F.col(order).alias("at"), F.coalesce(line, F.lit("")).alias("line"))
    d = _stored(d.withColumns({"words": tx.word_count("line", ws).cast("long"), "row": F.monotonically_increasing_id()}), "lines")
    # the texts wait in that table: up to the last steps only numbers are moved
    numbers = sequence.dense_index(d.drop("line"), ["doc"], ["at", "row"], index_col="idx", count_col=None, long_groups=True)
    numbers = _stored(sums_before(numbers.drop("at"), "doc", "idx", "words", "before"), "numbers")
    starts = scene_starts(numbers.drop("row"), max_words).withColumn("start", F.lit(1))
    marked = numbers.select("doc", "row", "idx").join(starts, ["doc", "idx"], "left").withColumn("start", F.coalesce("start", F.lit(0)))
    placed = sums_before(marked, "doc", "idx", "start", "earlier").select(
        "row", "idx", (F.col("earlier") + F.col("start") - 1).cast("int").alias("scene_idx"))
    scenes = d.select("doc", "row", "words", "line").join(placed, "row").groupBy("doc", "scene_idx").agg(
        F.sum("words").cast("int").alias("n_words"), F.sort_array(F.collect_list(F.struct("idx", "line"))).alias("held"))
    count = starts.groupBy("doc").agg(F.count("*").cast("int").alias("n_scenes"))
    return scenes.join(count, "doc").select(F.col("doc.id").alias(doc), "scene_idx", "n_scenes", "n_words",
                                            F.array_join(F.transform("held", lambda x: x["line"]), "\n").alias("text"))

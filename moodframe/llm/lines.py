"""Line dedup: repeated runs of lines, found by prefix doubling.

A document is a sequence of line ids (64-bit hashes), and suffixes are compared
line by line. Round k names the first 2**k lines of every suffix: two names of
round k - 1, 2**(k-1) lines apart, are joined into one. A suffix whose name
occurs once shares that many lines with no other; it is dropped, so later rounds
handle repeated runs only. The suffixes that share a name are an interval of the
suffix array whose common prefix has 2**k lines; the interval for a prefix of n
lines follows from two overlapping names of the largest 2**k <= n.

A run qualifies from ``min_words`` words. For every start the shortest
qualifying prefix is looked up; its interval holds all copies of that run, of
which the first (lowest id, then line) stays. The deleted windows of neighbouring
starts join up to the whole maximal run, whatever its length.

Names are counted with partial aggregation before any shuffle, so a line that a
third of all documents share costs a row per task; the joins are equi-joins
whose hot partitions adaptive execution splits. Rounds are written to the shared
folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodframe.llm.common import WORD, stored

#: Words of a repeated run from which its later copies are deleted.
MIN_WORDS = 8


def split_lines(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _repeated(rows: DataFrame) -> DataFrame:
    """The rows whose name occurs at least twice. The names are stored, so that
    the join shuffles both sides and a hot name's rows can be split."""
    many = rows.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name")
    return rows.join(stored(many, "names"), "name")


def _with_lengths(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """A row per line of a run: the lines that its shortest prefix of
    ``min_words`` words has, 0 if the run ends before."""
    for b in batches:
        for doc, lines in zip(b.column("doc").to_pylist(), b.column("lines").to_pylist(), strict=True):
            ends = np.cumsum([x["words"] for x in lines])
            begins = ends - [x["words"] for x in lines]
            last = np.searchsorted(ends, begins + min_words)
            n = np.where(last < len(lines), last - np.arange(len(lines)) + 1, 0)
            n[[x["words"] == 0 for x in lines]] = 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc] * len(lines), b.column("doc").type), pa.array([x["pos"] for x in lines], pa.int32()),
                 pa.array([x["name"] for x in lines], pa.int64()), pa.array(n, pa.int32())], names=["doc", "pos", "name", "n"])


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, pos) of the lines that lie in a later copy of a qualifying run,
    from rows (doc, pos, name, words). Rows with one doc and pos are one line."""
    in_doc = Window.partitionBy("doc").orderBy("pos")
    run = _repeated(lines).dropDuplicates(["doc", "pos"]).withColumn("run", F.col("pos") - F.row_number().over(in_doc))
    runs = run.groupBy("doc", "run").agg(F.sort_array(F.collect_list(F.struct("pos", "name", "words"))).alias("lines"))
    schema = runs.select("doc").schema.add("pos", "integer").add("name", "long").add("n", "integer")
    level = stored(runs.mapInArrow(lambda x: _with_lengths(x, min_words), schema), "lines")
    longest = level.agg(F.max("n")).first()[0] or 0

    wanted = level.filter("n > 0").select("doc", "pos", "n", F.expr("cast(floor(log2(n)) as int)").alias("k"))
    wanted = wanted.withColumn("tail", F.expr("pos + n - cast(shiftleft(1, k) as int)"))
    level, k, found = level.select("doc", "pos", "name"), 0, []
    while longest:
        here = wanted.filter(F.col("k") == k)
        found.append(here.join(level, ["doc", "pos"]).withColumnRenamed("name", "head").join(
            level.select("doc", F.col("pos").alias("tail"), F.col("name").alias("end")), ["doc", "tail"]
        ).select("doc", "pos", "n", "head", "end"))
        if 2 << k > longest:
            break
        ahead = Window.partitionBy("doc").orderBy("pos").rangeBetween(1 << k, 1 << k)
        level = level.withColumn("next", F.first("name").over(ahead)).filter("next is not null")
        level = stored(_repeated(level.select("doc", "pos", F.xxhash64("name", "next").alias("name"))), "lines")
        k += 1
    if not found:
        return level.select("doc", "pos")
    windows = found[0]
    for x in found[1:]:
        windows = windows.unionByName(x)
    windows = stored(windows, "lines")
    key = ["n", "head", "end"]
    first = stored(windows.groupBy(key).agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("copies")).filter("copies > 1"), "lines")
    # an overlapping copy in the same document leaves the first copy whole
    begin = F.when(F.col("first.doc") == F.col("doc"), F.greatest("pos", F.col("first.pos") + F.col("n"))).otherwise(F.col("pos"))
    return (windows.join(first, key).filter(F.struct("doc", "pos") != F.col("first"))
            .select("doc", begin.alias("begin"), (F.col("pos") + F.col("n") - 1).alias("end"))
            .filter("begin <= end").select("doc", F.explode(F.sequence("begin", "end")).alias("pos")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                counts: tuple[str, str] = ("lines", "lines_removed")) -> DataFrame:
    """``docs`` with the later copies of repeated runs of lines deleted from the
    text, plus two columns named by ``counts``: lines before, lines removed.

    Lines end at ``\\n``. The first copy is the one with the lowest id (null ids
    count as the lowest; the ids must be orderable), then the lowest line. Rows with the
    same id and text are one document and share its result. Null and empty texts
    stay as they are; a text all of whose lines go is empty. Other columns are
    kept, unless they are called like ``counts``: choose other names to keep
    those. An empty table gives an empty result.
    """
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    lines = docs.select(doc.alias("doc"), F.posexplode_outer(F.transform(
        split_lines(F.col(text_col)),
        lambda x: F.struct(F.xxhash64(x).alias("name"), F.regexp_count(x, F.lit(WORD)).alias("words")))).alias("pos", "x")
    ).select("doc", "pos", "x.name", "x.words")
    gone = later_copies(lines, min_words).groupBy("doc").agg(F.collect_set("pos").alias("gone"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(doc).alias("key"), doc.alias("doc"))
    joined = keyed.alias("d").join(gone.select(F.xxhash64("doc").alias("key"), "doc", "gone").alias("g"),
                                   (F.col("d.key") == F.col("g.key")) & F.col("d.doc").eqNullSafe(F.col("g.doc")), "left")
    text = F.col(f"row.`{text_col}`")
    left = F.filter(split_lines(text), lambda x, i: ~F.array_contains(F.col("gone"), i))
    cleaned = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(left, "\n"))
    kept = [c for c in docs.columns if c.lower() not in [n.lower() for n in counts]]
    return joined.select(*(cleaned.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in kept),
                         F.size(split_lines(text)).cast("long").alias(counts[0]),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(counts[1]))

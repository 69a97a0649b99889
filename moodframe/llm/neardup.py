"""Near duplicates by order MinHash.

* A text's k-mers are its windows of five words, labelled with how often the
  same window came before, so that all labelled k-mers of a text differ.
* A sketch takes the ``RETAINED`` labelled k-mers with the lowest hashes and
  keeps their order in the text. Texts agree in a sketch if they share these
  k-mers in the same order, which edits make unlikely and copies certain.
  ``TABLES`` sketches with independent hashes miss a pair at the threshold with
  probability (1 - 0.8 ** RETAINED) ** TABLES, about 3e-6.
* Texts that share a sketch are compared, but not all with all: within a bucket
  each with the text whose buckets are the fullest (the original that many are
  copies of) and with its neighbours in an order by the next sketches.
  The components of the links found are formed, and where a bucket still holds
  several, texts that stand for them are compared, with new draws every round,
  until a round finds no new link.
* What is still in buckets of several components is joined by prefixes, which
  loses no pair: with all k-mers in one order, rarest first, two similar texts
  share one of the first ninth of the shorter's k-mers and the first fifth of the
  longer's. Passages that many texts share come last in that order, so they make
  no candidates until they alone make texts similar.
* A candidate pair is verified by aligning the two k-mer sequences inside a band
  around the diagonal: the longest chain of common k-mers in the order of both.
  Its length over the number of distinct k-mers of both is the similarity.

Exact copies are one node from the start, so thousands of copies cost one row
per bucket. Links and components stay distributed.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodframe.llm.common import stored
from moodframe.llm.components import components

WORDS, THRESHOLD = 5, 0.8
TABLES, RETAINED = 24, 4
#: Further sketches by which a bucket is ordered.
NEAR = 6
#: Texts whose k-mers are counted for the order of the prefixes, and counters that
#: their k-mers share by a hash. Any order finds all pairs, counts save work.
COUNTED, COUNTERS = 5_000, 1 << 19
_FULL = np.uint64(2 ** 64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_kmers(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Labelled k-mers of all texts in a row, and how many each text has. A text
    of fewer than ``words`` words has one k-mer of all its words, a text without
    words none."""
    tokens = [list(map(zlib.crc32, (t or "").encode().split())) for t in texts]
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    flat = np.fromiter((w for t in tokens for w in t), dtype=np.uint64, count=int(sizes.sum()))
    counts = np.where(sizes == 0, 0, np.maximum(sizes - words + 1, 1))
    # k-mer i of a text begins at its word i; a short text's only k-mer is padded with zeros
    padded = np.concatenate([flat, np.zeros(words, dtype=np.uint64)])
    owner = np.repeat(np.arange(len(texts)), counts)
    begins = np.cumsum(sizes) - sizes
    first = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(len(owner))
    ends = np.repeat(begins + sizes, counts)
    h = np.zeros(len(owner), dtype=np.uint64)
    for k in range(words):
        at = first + k
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.where(at < ends, padded[at] + np.uint64(1), np.uint64(0)))
    keyed = _mix(h ^ _mix(owner.astype(np.uint64)))
    order = np.argsort(keyed, kind="stable")
    ordered = keyed[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, dtype=bool)
    group = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0)) if len(order) else order
    label = np.empty(len(order), dtype=np.uint64)
    label[order] = (np.arange(len(order)) - group).astype(np.uint64)
    return _mix(h + label * np.uint64(0xD6E8FEB86659FD93)), counts


def sketches(kmers: np.ndarray, counts: np.ndarray, tables: int = TABLES, retained: int = RETAINED) -> np.ndarray:
    """One row per text with k-mers, one column per table."""
    counts = counts[counts > 0]
    begins = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    out = np.empty((len(counts), tables), dtype=np.uint64)
    for t in range(tables):
        v = _mix(kmers ^ _mix(np.array([t + 1], dtype=np.uint64)))
        at, value = np.empty((retained, len(counts)), dtype=np.int64), np.empty((retained, len(counts)), dtype=np.uint64)
        for r in range(retained):
            least = np.minimum.reduceat(v, begins)
            hit = np.flatnonzero(v == np.repeat(least, counts))
            hit = hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]]
            used_up = least == _FULL  # fewer k-mers than the sketch retains
            at[r] = np.where(used_up, np.iinfo(np.int64).max - retained + r, hit)
            value[r] = np.where(used_up, np.uint64(0), kmers[hit])
            v[hit] = _FULL
        value = np.take_along_axis(value, np.argsort(at, axis=0), axis=0)
        key = np.full(len(counts), t, dtype=np.uint64)
        for r in range(retained):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + value[r])
        out[:, t] = key
    return out


def similarity(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Aligned share of two sequences of distinct k-mers, 0 if below the threshold."""
    need = int(np.ceil(threshold * (len(x) + len(y)) / (1 + threshold) - 1e-9))
    if need > min(len(x), len(y)) or not need:
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if len(i) < need:
        return 0.0
    order = np.argsort(i)
    i, j = i[order], j[order]
    j = j[np.abs(i - j) <= len(x) + len(y) - 2 * need]  # the band that a similar pair cannot leave
    if len(j) >= need and not np.all(j[1:] > j[:-1]):
        chain: list[int] = []
        for p in j.tolist():
            at = bisect_left(chain, p)
            chain[at:at + 1] = [p]
        j = np.array(chain)
    return len(j) / (len(x) + len(y) - len(j)) if len(j) >= need else 0.0


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            b = batch.slice(at, 500)
            kmers, counts = labelled_kmers(b.column("text").to_pylist())
            if not len(kmers):
                continue
            found = sketches(kmers, counts).view(np.int64)
            node = b.column("node").take(pa.array(np.flatnonzero(counts)))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * TABLES, pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([node, keys], names=["node", "keys"])


def _kmers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            b = batch.slice(at, 500)
            kmers, counts = labelled_kmers(b.column("text").to_pylist())
            parts = np.split(kmers.astype("<u8"), np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([p.tobytes() for p in parts], pa.binary())], names=["node", "kmers"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"))
                 for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
        keep = pa.array([s > 0 for s in found])
        yield pa.RecordBatch.from_arrays(
            [b.column("u").filter(keep), b.column("v").filter(keep), pa.array([s for s in found if s > 0], pa.float64())],
            names=["u", "v", "similarity"])


def _verified(pairs: DataFrame, kmers: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar, with their similarity."""
    both = (pairs.join(kmers.select(F.col("node").alias("u"), F.col("kmers").alias("x")), "u")
            .join(kmers.select(F.col("node").alias("v"), F.col("kmers").alias("y")), "v"))
    return both.select("u", "v", "x", "y").mapInArrow(_verify, "u binary, v binary, similarity double")


def _ordered(u, v) -> list:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def similar_texts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, classes): the verified links (u, v, similarity) between different
    texts, and (node, component) of every text that has a link. A node is the
    MD5 of a text."""
    texts = docs.select(F.unhex(F.md5(text_col)).alias("node"), F.col(text_col).alias("text")).filter("text is not null")
    sketched = stored(texts.mapInArrow(_buckets, "node binary, keys array<long>").dropDuplicates(["node"]), "sketches")
    # most buckets hold one text: the other keys join a text's rows once those are gone
    rows = sketched.select("node", F.posexplode("keys").alias("t", "key"))
    bucket = ["t", "key"]
    sizes = rows.groupBy(bucket).agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(rows.join(sizes, bucket), "buckets")
    # the text whose buckets are the fullest is the one that the others are copies of
    rank = shared.groupBy("node").agg(F.sum("n").alias("rank"))
    ranked = shared.join(rank, "node")
    leaders = ranked.groupBy(bucket).agg(F.max(F.struct("rank", "node")).alias("top"))
    near = F.transform(F.sequence(F.lit(1), F.lit(NEAR)), lambda k: F.get("keys", (F.col("t") + k) % TABLES)).alias("near")
    members = stored(ranked.join(sketched, "node").select(*bucket, "node", "rank", near).join(leaders, bucket).select(
        *bucket, "node", "near", "rank", F.col("top.node").alias("leader")), "buckets")
    chain = Window.partitionBy(bucket).orderBy("near", "node")
    ahead = members.select("node", "leader", F.lag("node", 1).over(chain).alias("one"), F.lag("node", 2).over(chain).alias("two"))
    pairs = ahead.select("node", F.explode(F.array("leader", "one", "two")).alias("other")).filter("other is not null").select(
        *_ordered(F.col("node"), F.col("other"))).filter("u <> v").distinct()
    done = stored(pairs, "pairs")
    wanted = members.select("node").distinct()
    kmers = stored(texts.join(wanted, "node").dropDuplicates(["node"]).mapInArrow(_kmers, "node binary, kmers binary"), "kmers")
    links = stored(_verified(done, kmers), "links")
    classes = stored(components(links), "classes")
    open_, round_ = members.select(*bucket, "node", "rank"), 0
    while True:
        open_ = stored(_open_buckets(open_, classes, bucket), "buckets")
        new = stored(_between_components(open_, bucket, round_).join(done, ["u", "v"], "left_anti"), "pairs")
        found = stored(_verified(new, kmers), "links")
        if found.isEmpty():
            break
        done, links = stored(done.unionByName(new), "pairs"), stored(links.unionByName(found), "links")
        classes = stored(_merged(classes, found), "classes")
        open_, round_ = open_.select(*bucket, "node", "rank"), round_ + 1
    if open_.isEmpty():
        return links, classes
    rest = stored(_prefix_pairs(open_, kmers).join(done, ["u", "v"], "left_anti"), "pairs")
    found = stored(_verified(rest, kmers), "links")
    return links.unionByName(found), stored(_merged(classes, found), "classes")


def _open_buckets(members: DataFrame, classes: DataFrame, bucket: list[str]) -> DataFrame:
    """The members, with their components, of buckets that hold two or more components."""
    named = members.join(classes, "node", "left").select(*bucket, "node", "rank", F.coalesce("component", "node").alias("component"))
    several = named.groupBy(bucket).agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return named.join(several.select(bucket), bucket)


def _between_components(members: DataFrame, bucket: list[str], round_: int) -> DataFrame:
    """Pairs of texts that stand for different components of a bucket: in the
    first round the highest ranked, later one drawn anew for each bucket and
    round. In a random order each meets those 1, 2, 4 and 8 places on."""
    draw = F.struct(F.xxhash64(F.lit(round_), *bucket, "node") if round_ else -F.col("rank"), "node")
    picked = members.groupBy(*bucket, "component").agg(F.min_by("node", draw).alias("node"))
    ring = Window.partitionBy(bucket).orderBy(F.xxhash64(F.lit(round_), "component"), "component")
    others = picked.select("node", *(F.lead("node", d).over(ring).alias(f"at{d}") for d in (1, 2, 4, 8)))
    met = others.select("node", F.explode(F.array("at1", "at2", "at4", "at8")).alias("other"))
    return met.filter("other is not null").select(*_ordered(F.col("node"), F.col("other"))).distinct()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counters, those that are not 0."""
    total = np.zeros(COUNTERS, dtype=np.int64)
    for b in batches:
        for x in b.column("kmers").to_pylist():
            total += np.bincount((np.frombuffer(x, "<u8") % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["counter", "n"])


def _counters(sets: DataFrame, nodes: int) -> np.ndarray:
    """How often the k-mers of a sample of the texts fall on each counter: one
    array of fixed size, whatever the corpus."""
    share = int(min(1.0, COUNTED / max(nodes, 1)) * 1_000_000)
    sample = sets.filter(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < share).select("kmers")
    found = sample.mapInArrow(_counted, "counter long, n long").groupBy("counter").agg(F.sum("n").cast("int").alias("n")).select(
        F.col("counter").cast("int").alias("counter"), "n").toArrow()
    table = np.zeros(COUNTERS, dtype=np.int32)
    table[found.column("counter").to_numpy()] = found.column("n").to_numpy()
    return table


def prefixes(x: np.ndarray, times: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, int]:
    """The first k-mers of a text in the order of (count, k-mer), as many as it
    needs as the longer text of a pair, and how many it needs as the shorter."""
    seen = times[(x % np.uint64(len(times))).astype(np.int64)]
    longer = len(x) - int(np.ceil(threshold * len(x) - 1e-9)) + 1
    shorter = len(x) - int(np.ceil(2 * threshold / (1 + threshold) * len(x) - 1e-9)) + 1
    return x[np.lexsort((x, seen))[:longer]], shorter


def _prefix_pairs(members: DataFrame, kmers: DataFrame) -> DataFrame:
    """All pairs of texts of different components that can be similar, by the
    k-mers that their prefixes share."""
    nodes = stored(members.select("node", "component").distinct(), "nodes")
    sets = kmers.join(nodes, "node")
    times = _counters(sets, nodes.count())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                b = batch.slice(at, 500)
                size, kept, first, short = [], [], [], []
                for raw in b.column("kmers").to_pylist():
                    x = np.frombuffer(raw, "<u8")
                    head, shorter = prefixes(x, times)
                    size.append(len(x))
                    kept.append(len(head))
                    first.append(head)
                    short.append(np.arange(len(head)) < shorter)
                row = pa.array(np.repeat(np.arange(len(b)), kept))
                yield pa.RecordBatch.from_arrays(
                    [b.column("node").take(row), b.column("component").take(row), pa.array(np.repeat(size, kept), pa.int32()),
                     pa.array(np.concatenate([np.arange(k) for k in kept]), pa.int32()), pa.array(np.concatenate(first).view(np.int64)),
                     pa.array(np.concatenate(short))], names=["node", "component", "size", "pos", "kmer", "short"])

    rows = sets.select("node", "component", "kmers").mapInArrow(
        cut, "node binary, component binary, size int, pos int, kmer long, short boolean")
    rows = stored(rows, "prefixes")
    several = rows.groupBy("kmer").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("short").alias("any")).filter(
        "low <> high and any")
    rows = stored(rows.join(several.select("kmer"), "kmer"), "prefixes")
    # no k-mer before the first that two prefixes share is common to both, so a row's place bounds the other text's size
    rows = rows.withColumn("reach", (F.col("size") - F.col("pos")) * ((1 + THRESHOLD) / THRESHOLD) - F.col("size") + 1e-6)
    # components first, so that the texts of a large one are not paired with each other
    held = rows.groupBy("kmer", "component").agg(
        F.min(F.when(F.col("short"), F.col("size"))).alias("least"), F.max(F.when(F.col("short"), F.col("reach"))).alias("reach_x"),
        F.min("size").alias("low"), F.max("size").alias("high"), F.max("reach").alias("reach_y"))
    cx = held.filter("least is not null").select("kmer", F.col("component").alias("cx"), "least", "reach_x")
    cy = held.select("kmer", F.col("component").alias("cy"), "low", "high", "reach_y")
    between = cx.join(cy, "kmer").filter("cx <> cy and least <= high and least <= reach_y and low <= reach_x").select(
        "kmer", "cx", "cy", "low", "high", "reach_y")
    x = rows.filter("short").select("kmer", *(F.col(c).alias(n) for c, n in (("component", "cx"), ("node", "x"), ("size", "nx"), ("reach", "rx"))))
    y = rows.select("kmer", *(F.col(c).alias(n) for c, n in (("component", "cy"), ("node", "y"), ("size", "ny"), ("reach", "ry"))))
    met = between.join(x, ["kmer", "cx"]).filter("nx <= high and nx <= reach_y and low <= rx")
    able = met.join(y, ["kmer", "cy"]).filter("(nx < ny or nx = ny and x < y) and ny <= rx and nx <= ry")
    return able.select(*_ordered(F.col("x"), F.col("y"))).distinct()


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after further links, by the components of the components."""
    ends = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    every = classes.unionByName(ends.join(classes, "node", "left_anti").select("node", F.col("node").alias("component")))
    name = every.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    between = links.select("u", "v").join(name, "u").join(name.select(F.col("u").alias("v"), F.col("cu").alias("cv")), "v")
    roots = components(between.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    return every.join(roots.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select(
        "node", F.coalesce("root", "component").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``class_id`` (the lowest id of the group
    of texts that links connect, a text's exact copies included) and ``kept``
    (true for one row of each class, the one with the lowest id).

    Null texts are in no class: their ``class_id`` is null and they are kept.
    Texts without words are alike only if equal. Of rows with one id and text,
    one is kept. Null ids count as the highest. Other columns are not read. An
    empty table gives an empty result.
    """
    judged = _judged(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    return judged.select(F.col("id").alias(id_col), F.col("first.id").alias("class_id"), "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all columns."""
    return _judged(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("row"))
                   ).filter("kept").select("row.*")


def _judged(docs: DataFrame) -> DataFrame:
    """Rows (id, text, ...) with ``first``, the lowest (id, node) of the class, and ``kept``."""
    _, classes = similar_texts(docs)
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    named = docs.withColumn("node", F.unhex(F.md5("text")))
    members = named.filter("node is not null").select("id", "node").distinct().join(classes, "node", "left").withColumn(
        "class", F.coalesce("component", "node"))
    firsts = members.groupBy("class").agg(F.min(rank).alias("first"))
    members = members.join(firsts, "class").select("node", _id_key("id"), "first", (rank == F.col("first")).alias("leads"))
    # rows are numbered and joined by the same two columns, so they are shuffled once
    w = Window.partitionBy("node", "id_key").orderBy(F.lit(1))
    numbered = named.withColumn("id_key", _id_key("id")).withColumn("nth", F.row_number().over(w))
    return numbered.join(members, ["node", "id_key"], "left").withColumn(
        "kept", F.col("node").isNull() | (F.col("leads") & (F.col("nth") == 1)))


def _id_key(id_col: str):
    """A string for an id that is never null, so that joins on it stay plain."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("id_key")

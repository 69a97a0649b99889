"""Removal of byte strings that occur more than once in the corpus.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is
found exactly. The order of work is that of a difference-cover suffix sort, with
a cover chosen by content:

1. *Sample.* Of every window of ``length`` bytes the position with the lowest
   hash of its ``GRAM`` bytes is sampled. Like a difference cover, the sample
   meets equal windows at equal offsets, but it has one position in about
   ``(length - GRAM) / 2`` instead of two in three. Each sampled position owns the
   run of windows that chose it.
2. *Name the samples.* Samples are named by their gram; a name that occurs once
   belongs to no repeated window, and its windows are done.
3. *Recurse on names.* A sample's second name covers the whole string that its
   windows cover. Samples that share it are repeated with all their windows.
4. *Merge the rest.* Where samples share the first name but not the second, the
   match ends inside their strings. Their windows are named one by one, sorted,
   and neighbours compared: equal neighbours start the same ``length`` bytes.

Names are 64-bit hashes, compared only below equal grams, that is 128 bits. Texts
never meet in a group: step 2 and 3 shuffle a few numbers per sample, step 4 one
short string per distinct second name. A gram with more than ``HOT`` second names
is not gathered in a task: its windows become rows that are counted with partial
aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodframe.llm.common import parallelism, stored

LENGTH, GRAM, HOT = 400, 32, 10_000
#: Strings whose windows a task holds at a time, and strings that are gathered in a task.
HELD, GATHERED = 2_000, 20_000
#: Bytes that are hashed at a time; positions within take 24 bits of a sort key.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


class Hasher:
    """Hashes of substrings of a chunk, from prefix sums of byte x base ** place."""

    def __init__(self, size: int):
        self.table = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.up, self.down = _powers(_BASE, size + 1), _powers(_INVERSE, size + 1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=out[1:])
        return out

    def span(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[begin]) * self.down[begin])

    def every(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Of all substrings of one length."""
        n = max(0, len(sums) - length)
        return _mix((sums[length:] - sums[:n]) * self.down[:n])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    n = len(keys) - width + 1
    full = -(-len(keys) // width) * width
    blocks = np.concatenate([keys, np.full(full - len(keys), np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def samples(data: np.ndarray, hasher: Hasher, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram name, windows before it, windows after it, name of the string that
    its windows cover, position) of the sampled positions of one text."""
    sums = hasher.sums(data)
    grams = hasher.every(sums, gram)
    place = np.arange(len(grams), dtype=np.uint64)
    chosen = (_lowest((grams >> np.uint64(24) << np.uint64(24)) | place, length - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[first[1:] - 1, len(chosen) - 1]
    at = chosen[first]
    return grams[at], at - first, last - at, hasher.span(sums, first, last + length), at


def _pieces(text: str | None, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of a text in chunks that share length - 1 bytes, so that
    every window lies in one chunk."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    for at in range(0, max(len(data) - length + 1, 0), CHUNK):
        yield at, data[at:at + CHUNK + length - 1]


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc, begin, end) of byte spans that repeated strings cover, from rows
    (doc, text). Rows with one doc hold the same text and count as often as they occur."""
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(CHUNK + length)
        for b in batches:
            for i, text in enumerate(b.column("text").to_pylist()):
                for offset, data in _pieces(text, length):
                    g, before, after, name, at = samples(data, hasher, length, gram)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc").take(pa.array(np.full(len(g), i))), pa.array(at + offset, pa.int64()), pa.array(g.view(np.int64)),
                         pa.array(before, pa.int32()), pa.array(after, pa.int32()), pa.array(name.view(np.int64))],
                        names=["doc", "at", "gram", "before", "after", "name"])

    kind = texts.schema["doc"].dataType.simpleString()
    columns = f"doc {kind}, at long, gram long, before int, after int, name long"
    found = stored(texts.mapInArrow(sampled, columns), "samples")
    # stored, so that the join shuffles both sides and a hot gram's rows can be split
    many = stored(found.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "grams")
    found = stored(found.join(many, "gram"), "samples")
    key = ["gram", "before", "after", "name"]
    names = found.groupBy(key).agg(F.count("*").alias("copies"), F.min(F.struct("doc", "at")).alias("one"))
    names = stored(names, "names")
    whole = found.join(names.filter("copies > 1").select(key), key).select(
        "doc", (F.col("at") - F.col("before")).alias("begin"), (F.col("at") + F.col("after") + length).alias("end"))
    mixed = names.groupBy("gram").agg(F.count("*").alias("names"), F.count_if(F.col("copies") == 1).alias("singles")).filter(
        "names > 1 and singles > 0").select("gram", "names")
    rest = names.join(mixed, "gram").select(
        F.col("one.doc").alias("doc"), F.struct(F.col("one.at").alias("at"), "gram", "before", "after", "copies", "names").alias("s"))
    wanted = rest.groupBy("doc").agg(F.collect_list("s").alias("wanted"))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The string that each sample's windows cover."""
        for b in batches:
            for doc, text, todo in zip(*(b.column(c).to_pylist() for c in ("doc", "text", "wanted")), strict=True):
                data = text.encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(todo), b.column("doc").type), pa.array([s["at"] - s["before"] for s in todo], pa.int64()),
                     *(pa.array([s[c] for s in todo], t) for c, t in (
                         ("gram", pa.int64()), ("before", pa.int32()), ("copies", pa.int64()), ("names", pa.int64()))),
                     pa.array([data[s["at"] - s["before"]:s["at"] + s["after"] + length] for s in todo], pa.binary())],
                    names=["doc", "begin", "gram", "before", "copies", "names", "bytes"])

    # rows with one doc are alike; the windows of one of them are enough here
    cut = texts.join(wanted, "doc").dropDuplicates(["doc"]).select("doc", "text", "wanted").mapInArrow(
        strings, f"doc {kind}, begin long, gram long, before int, copies long, names long, bytes binary")
    cut = stored(cut, "strings")

    def windows(table: pa.Table) -> tuple[np.ndarray, ...]:
        """(row, window's place in the row's string, gram name, distance to the gram, name) of all windows."""
        hasher = Hasher(length + 2 * length)
        row, place, name = [], [], []
        for i, data in enumerate(table.column("bytes").to_pylist()):
            h = hasher.every(hasher.sums(np.frombuffer(data, dtype=np.uint8)), length)
            row.append(np.full(len(h), i))
            place.append(np.arange(len(h)))
            name.append(h)
        row, place = np.concatenate(row), np.concatenate(place)
        return (row, place, table.column("gram").to_numpy()[row], table.column("before").to_numpy()[row] - place,
                np.concatenate(name).view(np.int64))

    def runs(table: pa.Table, row: np.ndarray, place: np.ndarray) -> pa.Table:
        """Marked windows, sorted by row and place, as spans of their documents."""
        fresh = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]) if len(row) else np.zeros(0, int)
        last = np.r_[fresh[1:] - 1, len(row) - 1] if len(row) else fresh
        begin = table.column("begin").to_numpy()[row[fresh]]
        return pa.Table.from_arrays([table.column("doc").combine_chunks().take(pa.array(row[fresh])), pa.array(begin + place[fresh], pa.int64()),
                                     pa.array(begin + place[last] + length, pa.int64())], names=["doc", "begin", "end"])

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("gram").combine_chunks()
        grams = table.column("gram").to_numpy()
        ends = np.r_[np.flatnonzero(grams[1:] != grams[:-1]) + 1, len(grams)]
        found, begin = [], 0
        for k, end in enumerate(ends):  # whole grams, about HELD strings at a time
            if k + 1 == len(ends) or ends[k + 1] - begin > HELD:
                found.append(marked_runs(table.slice(begin, end - begin)))
                begin = end
        return pa.concat_tables(found)

    def marked_runs(table: pa.Table) -> pa.Table:
        row, place, g, distance, name = windows(table)
        order = np.lexsort((name, distance, g))
        same = (g[order[1:]] == g[order[:-1]]) & (distance[order[1:]] == distance[order[:-1]]) & (name[order[1:]] == name[order[:-1]])
        marked = np.zeros(len(row), dtype=bool)
        marked[order[1:][same]] = True
        marked[order[:-1][same]] = True
        marked &= (table.column("copies").to_numpy() == 1)[row]  # the others are spans already
        return runs(table, row[marked], place[marked])

    # a string has at most 3 * length bytes and a gram at most ``hot`` strings, so a part is bounded
    parts = max(parallelism(texts.sparkSession) * 4, -(-cut.count() // GATHERED))
    spans = f"doc {kind}, begin long, end long"
    small = cut.filter(F.col("names") <= hot).withColumn("part", F.pmod("gram", F.lit(parts))).groupBy("part").applyInArrow(compare, spans)

    def as_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                table = pa.Table.from_batches([batch.slice(at, 1000)])
                row, place, g, distance, name = windows(table)
                take = pa.array(row)
                yield from pa.Table.from_arrays(
                    [table.column("doc").combine_chunks().take(take), pa.array(table.column("begin").to_numpy()[row] + place, pa.int64()), pa.array(g),
                     pa.array(distance, pa.int32()), pa.array(name), table.column("copies").combine_chunks().take(take)],
                    names=["doc", "begin", "gram", "distance", "name", "copies"]).combine_chunks().to_batches()

    each = cut.filter(F.col("names") > hot).mapInArrow(
        as_rows, f"doc {kind}, begin long, gram long, distance int, name long, copies long")
    window = ["gram", "distance", "name"]
    twice = each.groupBy(window).agg(F.count("*").alias("n")).filter("n > 1").select(window)
    large = each.filter("copies = 1").join(twice, window).select("doc", "begin", (F.col("begin") + length).alias("end"))
    return whole.unionByName(small).unionByName(large)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256
    and ``removed``, the maximal removed spans as (begin, end) bytes.

    Strings are judged on the input; overlapping ones count; none crosses a
    document. A null or empty text has no bytes. Repeated rows are documents of
    their own, so their strings occur elsewhere. Null ids are allowed, other
    columns are not read. An empty table gives an empty result.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "doc", F.unhex(F.md5(F.concat_ws(":", F.col("id").cast("string"), "text"))))
    texts = keyed.select("doc", "text").filter(F.octet_length("text") >= length)
    spans = repeated_spans(texts, length, gram, hot).groupBy("doc").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, sizes, hashes = [], [], []
            for text, found in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                data, runs = text.encode(), []
                for s in sorted((s["begin"], s["end"]) for s in found or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                kept, at = hashlib.sha256(), 0
                for begin, end in runs:
                    kept.update(data[at:begin])
                    at = end
                kept.update(data[at:])
                hashes.append(kept.hexdigest())
                sizes.append(len(data))
                removed.append([{"begin": x, "end": y} for x, y in runs])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sizes, pa.int64()), pa.array([sum(r["end"] - r["begin"] for r in x) for x in removed], pa.int64()),
                 pa.array(map(len, removed), pa.int64()), pa.array(hashes, pa.string()),
                 pa.array(removed, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (keyed.join(spans, "doc", "left").select("id", "text", "spans").mapInArrow(
        cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<begin:bigint,end:bigint>>")
        .withColumnRenamed("id", id_col))

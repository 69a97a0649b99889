"""Ranked lexical search over an inverted index whose posting lists are cut into
geometric blocks.

*Index.* A posting is (term, document, impact): the whole-number score that one
occurrence of the term in a query adds. Every document has a signature, the
signs of ``BITS`` random projections of its impacts, so that similar documents
have similar signatures. Documents are dealt into ranges of signatures and
gathered in cells of at most ``DOCS`` documents. In a cell the posting list of
each term, in order of signatures, is cut into blocks of ``BLOCK`` similar
documents. A block's summary is the coordinatewise maximum of its documents'
impacts over all terms that an item asks for beside the list's term, each
rounded up to one of 255 steps and stored with the block. Cells are rows of a
table, at most ``FILE`` of them in a file.

*Search.* A task goes through its cells with the items and holds the k best
documents of each item so far; their k-th score is the item's floor.

1. Terms whose greatest impacts together stay below the floor cannot by
   themselves bring a document into the result, so only the lists of the other
   terms are opened.
2. The inner product of the item and a block's summary bounds the score of all
   its documents. Blocks are taken in order of their bounds, and one is skipped
   only if its bound is below the floor. No block is skipped by estimate.
3. The documents of a block taken are scored exactly, in whole numbers.

The k best of each task and item meet in a ranked window. Items are searched for
in groups of ``ITEMS``, each with cells of its own terms; a group is the only
thing that a task is sent besides its rows. A cell's size is bounded by its
documents and by documents times terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodframe.llm.common import small, stored
from moodframe.session import scratch_path

K, BLOCK, BITS = 20, 256, 24
#: Documents of a cell, and its documents times its terms (bytes while it is built).
DOCS, CELL = 2_048, 1 << 24
#: Cells of a file, so that a reader holds a few at a time.
FILE = 8
#: Items that are searched for in one pass.
ITEMS = 1_000
#: What lies between terms: the ASCII characters but digits and letters.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    """The terms of a text; a null text has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), SEPARATOR, -1), lambda t: t != "")


def query_terms(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(wanted, vocabulary): rows (item, term, times) and (term, word), with a
    number for every distinct word of the items."""
    words = items.select(F.col(id_col).alias("item"), F.explode(terms_of(F.col(text_col))).alias("word"))
    words = stored(words.groupBy("item", "word").agg(F.count("*").alias("times")), "query-words")
    vocabulary = stored(words.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary")
    return stored(words.join(vocabulary, "word").select("item", "term", "times"), "wanted"), vocabulary


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the leading bits of sign(projection): a term's direction is a fixed
    pseudo-random vector of -1 and 1 drawn from its number."""
    bits = np.arange(BITS, dtype=np.uint64)
    for b in batches:
        vectors = b.column("vector")
        offsets = vectors.offsets.to_numpy()
        flat = vectors.flatten()
        terms, impacts = flat.field("term").to_numpy().astype(np.uint64), flat.field("impact").to_numpy().astype(np.float64)
        h = terms * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        base = offsets[0]
        sizes = np.diff(offsets)
        signature = np.zeros(len(b), dtype=np.int64)
        has = np.flatnonzero(sizes)
        begins = (offsets[:-1] - base)[has]
        for k in bits:
            sign = ((h >> k) & np.uint64(1)).astype(np.float64) * 2 - 1
            side = np.add.reduceat(sign * impacts, begins) > 0 if len(has) else np.zeros(0, bool)
            signature[has] |= side.astype(np.int64) << int(k)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(signature)], names=[*b.schema.names, "signature"])


def impacts(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc, id, vector of (term, impact) in order of terms) of the
    documents that hold a word of ``vocabulary``. All documents are counted."""
    spark = docs.sparkSession
    # an empty word stands for the document itself, so that one pass counts both
    named = small(vocabulary.unionByName(spark.createDataFrame([("", -1)], "word string, term long")), "vocabulary")
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(id_col).alias("id"), terms_of(F.col(text_col)).alias("words"))
    rows = rows.select("doc", "id", F.size("words").cast("long").alias("n"), F.explode(F.array_append("words", F.lit(""))).alias("word"))
    found = stored(rows.join(named, "word").groupBy("doc", "id", "n", "term").agg(F.count("*").alias("tf")), "occurrences")
    whole = found.filter("term = -1").agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    count, length = whole[0], max(whole[1], 1)
    held = found.filter("term >= 0")
    weight = F.floor(1000 * F.log((F.lit(2.0 * count + 2)) / (2 * F.col("df") + 1))).cast("long")
    weights = small(held.groupBy("term").agg(F.count("*").alias("df")).select("term", weight.alias("weight")), "weights")
    m = F.expr(f"75L + (25L * n * {count}L) div {length}L")
    impact = F.expr("weight * ((1000000000L * tf) div (1000L * tf + 12L * m))")
    postings = held.join(weights, "term").withColumn("m", m).select("doc", "id", "term", impact.alias("impact")).filter("impact > 0")
    return postings.groupBy("doc", "id").agg(F.sort_array(F.collect_list(F.struct("term", "impact"))).alias("vector"))


#: A cell: its documents, their postings by document (offsets, terms as places
#: in ``vocabulary``, impacts), the blocks (term, offsets, documents) and their
#: summaries (offsets, terms, steps; step s bounds impacts up to
#: scale[0] * exp(scale[1] * (s - 1))). Each is a column of packed numbers.
_CELL = {"docs": np.int64, "vocabulary": np.int64, "begins": np.int32, "terms": np.int32, "impacts": np.int64,
         "block_terms": np.int32, "block_begins": np.int32, "block_docs": np.int32,
         "summary_begins": np.int64, "summary_terms": np.int32, "summary_steps": np.uint8, "scale": np.float64}


class _Beside:
    """The terms that some item asks for together with a term."""

    def __init__(self, asked: list[np.ndarray]):
        self.asked = asked
        self.items: dict[int, list[int]] = {}
        for i, terms in enumerate(asked):
            for t in terms.tolist():
                self.items.setdefault(t, []).append(i)
        self.every = np.unique(np.concatenate(asked)) if asked else np.zeros(0, dtype=np.int64)

    def __getitem__(self, term: int) -> np.ndarray:
        return np.unique(np.concatenate([self.asked[i] for i in self.items[term]]))


def _cell(docs: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impact: np.ndarray, beside: _Beside) -> Iterator[tuple[int, dict]]:
    """(documents, cell) for documents in order of signatures; several cells where
    one would be too large."""
    vocabulary, local = np.unique(terms, return_inverse=True)
    if len(docs) * len(vocabulary) > CELL and len(docs) > 1:
        half, at = len(docs) // 2, int(sizes[:len(docs) // 2].sum())
        yield from _cell(docs[:half], sizes[:half], terms[:at], impact[:at], beside)
        yield from _cell(docs[half:], sizes[half:], terms[at:], impact[at:], beside)
        return
    low, high = float(impact.min()), float(impact.max())
    width = max(np.log(high / low) / 254, 1e-9)
    steps = np.minimum(np.ceil(np.log(impact / low) / width - 1e-6) + 1, 255).astype(np.uint8)
    row = np.repeat(np.arange(len(docs)), sizes)
    dense = np.zeros((len(docs), len(vocabulary)), dtype=np.uint8)
    dense[row, local] = steps
    by_term = np.argsort(local, kind="stable")  # keeps the order of signatures
    list_begins = np.searchsorted(local[by_term], np.arange(len(vocabulary) + 1))
    block_docs = row[by_term]
    block_terms, block_begins, summary_sizes, summary_terms, summary_steps = [], [], [], [], []
    for t in range(len(vocabulary)):
        wanted = np.searchsorted(vocabulary, np.intersect1d(beside[int(vocabulary[t])], vocabulary, assume_unique=True))
        for begin in range(list_begins[t], list_begins[t + 1], BLOCK):
            most = dense[np.ix_(block_docs[begin:min(begin + BLOCK, list_begins[t + 1])], wanted)].max(axis=0)
            has = np.flatnonzero(most)
            block_terms.append(t)
            block_begins.append(begin)
            summary_sizes.append(len(has))
            summary_terms.append(wanted[has])
            summary_steps.append(most[has])
    yield len(docs), {
        "docs": docs, "vocabulary": vocabulary, "begins": np.r_[0, np.cumsum(sizes)], "terms": local, "impacts": impact,
        "block_terms": block_terms, "block_begins": [*block_begins, len(block_docs)], "block_docs": block_docs,
        "summary_begins": np.r_[0, np.cumsum(summary_sizes)], "summary_terms": np.concatenate(summary_terms),
        "summary_steps": np.concatenate(summary_steps), "scale": [low, width]}


def _packed(cell: dict) -> list[pa.Array]:
    return [pa.array([np.asarray(cell[c], dtype=kind).tobytes()], pa.binary()) for c, kind in _CELL.items()]


def sorted_vectors(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents' impacts with signatures."""
    vectors = impacts(docs, vocabulary, id_col, text_col)
    schema = T.StructType([*vectors.schema.fields, T.StructField("signature", T.LongType())])
    return stored(vectors.mapInArrow(_signatures, schema), "vectors")


def build_index(vectors: DataFrame, asked: list[np.ndarray]) -> DataFrame:
    """The index of all documents for a group of items, given by their terms:
    rows of cells (``_CELL``) with the documents' ids."""
    beside = _Beside(asked)
    # copies have one signature: the document's number deals them to several ranges
    dealt = vectors.repartitionByRange("signature", "doc").sortWithinPartitions("signature", "doc")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), DOCS):
                b = batch.slice(at, DOCS)
                row, term, impact = _flat(b.column("vector"), "term", "impact")
                used = np.isin(term, beside.every)
                sizes = np.bincount(row[used], minlength=len(b))
                b, done = b.take(pa.array(np.flatnonzero(sizes))), 0
                if not len(b):
                    continue
                for n, cell in _cell(b.column("doc").to_numpy(), sizes[sizes > 0], term[used], impact[used], beside):
                    ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), b.column("id").slice(done, n))
                    done += n
                    yield pa.RecordBatch.from_arrays([ids, *_packed(cell)], names=["ids", *_CELL])

    kind = vectors.schema["id"].dataType.simpleString()
    path = scratch_path(vectors.sparkSession, "index")
    cells = dealt.mapInArrow(gathered, f"ids array<{kind}>, " + ", ".join(f"{c} binary" for c in _CELL))
    cells.write.option("maxRecordsPerFile", FILE).parquet(path)
    return vectors.sparkSession.read.schema(cells.schema).parquet(path)


def _flat(column: pa.ListArray, *fields: str) -> tuple[np.ndarray, ...]:
    """The row of each element of a list column, and fields of the elements."""
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())), *(flat.field(f).to_numpy() for f in fields)


class _Cell:
    """A row of the index, read for search."""

    def __init__(self, b: pa.RecordBatch, i: int):
        self.ids = b.column("ids")[i].values
        for c, kind in _CELL.items():
            setattr(self, c, np.frombuffer(b.column(c)[i].as_buffer(), dtype=kind))
        low, width = self.scale
        # the bound of a step, with room for the rounding of floating-point numbers; step 0: the term does not occur
        self.bound = np.r_[0.0, low * np.exp(width * np.arange(255)) * (1 + 1e-6)]
        block = np.repeat(np.arange(len(self.block_terms), dtype=np.int64), np.diff(self.summary_begins))
        self.held = block * len(self.vocabulary) + self.summary_terms  # ascending
        self.first_block = np.searchsorted(self.block_terms, np.arange(len(self.vocabulary) + 1))
        most = np.zeros(len(self.vocabulary), dtype=np.int64)
        np.maximum.at(most, self.terms, self.impacts)
        self.most = most

    def bounds(self, blocks: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each block the inner product of its summary and the item."""
        wanted = blocks[:, None] * len(self.vocabulary) + terms
        at = np.minimum(np.searchsorted(self.held, wanted), len(self.held) - 1)
        return np.where(self.held[at] == wanted, self.bound[self.summary_steps[at]], 0.0) @ times.astype(np.float64)

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of documents, from the item's weight on every term."""
        sizes = (self.begins[rows + 1] - self.begins[rows]).astype(np.int64)
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(self.begins[rows], sizes)
        return np.add.reduceat(self.impacts[at] * weight[self.terms[at]], ends - sizes)


def _search_cell(cell: _Cell, terms: np.ndarray, times: np.ndarray, best: list, k: int) -> list:
    """The k best of ``best`` and of the cell's documents, as (-score, id is null,
    id, doc). ``terms``, ``times``: the item's, terms ascending."""
    at = np.minimum(np.searchsorted(cell.vocabulary, terms), len(cell.vocabulary) - 1)
    here = cell.vocabulary[at] == terms
    terms, times = at[here], times[here]
    if not len(terms):
        return best
    floor = -best[k - 1][0] if len(best) >= k else 1
    order = np.argsort(cell.most[terms] * times, kind="stable")
    opened = terms[order][np.cumsum((cell.most[terms] * times)[order]) >= floor]
    blocks = np.concatenate([np.arange(cell.first_block[t], cell.first_block[t + 1]) for t in opened] or [np.zeros(0, dtype=np.int64)])
    bounds = cell.bounds(blocks, terms, times)
    weight = np.zeros(len(cell.vocabulary), dtype=np.int64)
    weight[terms] = times
    seen = np.zeros(len(cell.docs), dtype=bool)
    order, begin, step = np.argsort(-bounds, kind="stable"), 0, 4
    while begin < len(order) and bounds[order[begin]] >= floor:
        taken = [b for b in order[begin:begin + step] if bounds[b] >= floor]
        begin, step = begin + step, step * 2
        rows = np.unique(np.concatenate([cell.block_docs[cell.block_begins[x]:cell.block_begins[x + 1]] for x in blocks[taken]]))
        rows = rows[~seen[rows]]
        if not len(rows):
            continue
        seen[rows] = True
        score = cell.scores(rows, weight)
        good = np.flatnonzero(score >= floor)
        ids = cell.ids.take(pa.array(rows[good])).to_pylist()
        found = [(-s, x is None, x, d) for s, x, d in zip(score[good].tolist(), ids, cell.docs[rows[good]].tolist(), strict=True)]
        best = sorted([*best, *found], key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0, r[3]))[:k]
        floor = -best[k - 1][0] if len(best) >= k else floor
    return best


def search(items: DataFrame, docs: DataFrame, k: int = K, item_col: str = "item_id", query_col: str = "text",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Only scores above 0 count; equal scores are ordered by ascending id, null
    ids last. Null and empty texts have no terms: such documents are in no
    result, such items have none. Repeated rows of ``docs`` are documents of
    their own; rows of ``items`` with one id are one item with the terms of all.
    Other columns are not read. Empty tables give an empty result.
    """
    wanted, vocabulary = query_terms(items, item_col, query_col)
    vectors = sorted_vectors(docs, vocabulary, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    queries = stored(wanted.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", "times"))).alias("query")).withColumn(
        "number", F.monotonically_increasing_id()), "queries")
    passes, found = -(-queries.count() // ITEMS), None
    for k_th in range(passes):  # about ITEMS items each, by a hash
        mine = queries.filter(F.pmod(F.xxhash64("number"), F.lit(passes)) == k_th).select("number", "query")
        asked = [(r.number, np.array([x.term for x in r.query], dtype=np.int64), np.array([x.times for x in r.query], dtype=np.int64))
                 for r in mine.toLocalIterator()]
        cells = build_index(vectors, [terms for _, terms, _ in asked])

        def run(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            best: list[list] = [[] for _ in asked]
            for b in batches:
                for i in range(len(b)):
                    cell = _Cell(b, i)
                    for q, (_, terms, times) in enumerate(asked):
                        best[q] = _search_cell(cell, terms, times, best[q], k)
                    ids = b.column("ids").type.value_type
            if any(best):
                rows = [(asked[q][0], r) for q, found in enumerate(best) for r in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in rows], pa.int64()), pa.array([r[3] for _, r in rows], pa.int64()),
                     pa.array([r[2] for _, r in rows], ids), pa.array([-r[0] for _, r in rows], pa.int64())], names=["number", "doc", "id", "score"])

        part = cells.mapInArrow(run, f"number long, doc long, id {kind}, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], f"number long, doc long, id {kind}, score long")
    by = Window.partitionBy("number").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "doc")
    best = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return best.join(small(queries.select("number", "item"), "items"), "number").select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")

"""Quality rules: an isolation forest over rule statistics.

Each document gets rule statistics (words, symbols, repeated lines, repeated
word triples). Two hard rules fail a document outright. The others are judged
by an isolation forest: points that few random splits set apart have short
paths and are anomalies. The forest is grown on a bounded sample of labelled
rows, and the score from which a document is rejected is calibrated on the same
labelled rows so that at most ``max_good_rejected`` of the good ones are lost.

Statistics and verdicts are per row: one scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the forest may see, and rows and trees of the forest.
MAX_LABELLED = 20_000
TREES, TREE_ROWS, DEPTH = 100, 256, 12
#: Texts that a worker judges at a time.
SLICE = 500
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_CAPITALS = bytes(range(65, 91))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    pair = a[:-1] * len(ids) + a[1:]
    if len(ids) > 2_000_000:  # keeps the product below within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, times = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    inside = np.zeros(n, dtype=bool)
    for shift in range(3):
        inside[shift:n - 2 + shift] |= again
    return int(inside.sum())


def text_counts(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the forest's features of one text."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    n, in_words = len(words), sum(map(len, words))
    word_chars = len(text or "") - (len(raw) - in_words)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    many, rows, chars = max(n, 1), max(len(lines), 1), max(word_chars, 1)
    shouts = len(raw) - len(raw.translate(None, b"!"))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    # repeats are smoothed: one repeated line says little about a short text
    features = [min(symbols / many, 0.5), dup_lines / (rows + 20), repeat / (many + 400), capitals / chars, shouts / many]
    return [n, word_chars, symbols, dup_lines, repeat], features


@dataclass
class Forest:
    """Trees as arrays: split feature (-1 at a leaf), split value, left child
    (the right one follows it), path length at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float

    @staticmethod
    def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS,
             seed: int = 7) -> Forest:
        """Trees over random subsets of ``x``; splits are drawn from the box
        ``low`` to ``high`` and its halves, so that a split can also set apart
        the empty region where anomalies lie."""
        rng = np.random.default_rng(seed)
        rows = min(rows, len(x))
        made = [_tree(x[rng.choice(len(x), rows, replace=False)], low, high, rng) for _ in range(trees)]
        size = max(len(t) for t in made)
        out = np.zeros((4, trees, size))
        out[0] = -1
        for i, t in enumerate(made):
            out[:, i, :len(t)] = np.array(t).T
        return Forest(out[0].astype(np.int64), out[1], out[2].astype(np.int64), out[3], _mean_path(rows))

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for anomalies, below 0.5 for common rows."""
        total = np.zeros(len(x))
        each = np.arange(len(x))
        for feature, value, left, path in zip(self.feature, self.value, self.left, self.path, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                right = x[each, np.maximum(feature[at], 0)] >= value[at]
                at = np.where(inner, left[at] + right, at)
            total += path[at]
        return 2.0 ** (-(total / len(self.feature)) / max(self.norm, 1e-9))


def _mean_path(n: int) -> float:
    """Expected path of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def _tree(x: np.ndarray, low: np.ndarray, high: np.ndarray, rng: np.random.Generator) -> list[list[float]]:
    nodes: list[list[float]] = [[]]
    todo = [(0, x, 0, low, high)]
    while todo:
        k, part, depth, low, high = todo.pop()
        open_ = np.flatnonzero(high > low)
        if depth >= DEPTH or len(part) < 2 or not len(open_):
            nodes[k] = [-1, 0.0, 0, depth + _mean_path(len(part))]
            continue
        f = int(rng.choice(open_))
        v = float(rng.uniform(low[f], high[f]))
        right = part[:, f] >= v
        nodes[k] = [f, v, len(nodes), 0.0]
        edge = np.arange(len(low)) == f
        for side, lo, hi in ((~right, low, np.where(edge, v, high)), (right, np.where(edge, v, low), high)):
            nodes.append([])
            todo.append((len(nodes) - 1, part[side], depth + 1, lo, hi))
    return nodes


@dataclass
class QualityModel:
    """A forest and the score from which a document is rejected (None: the hard
    rules alone decide)."""

    forest: Forest | None = None
    threshold: float | None = None


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeat = counts[:, 0], counts[:, 4]
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_labelled: int = MAX_LABELLED,
                max_good_rejected: float = 0.001, seed: int = 7) -> QualityModel:
    """Grow the forest on good labelled documents and calibrate its threshold.

    At most ``max_labelled`` labelled ids (the lowest by a hash of the id) are
    used; that bound holds whatever the corpus size. A document with several
    labels counts as bad if one of them is 0; null ids, null labels and labels
    without a document are left out. Of several documents with one id, the one
    with the lowest statistics counts, so that a labelled id is one row. Documents
    that the hard rules fail take no part. Without a good labelled document the
    model has no forest.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
              .dropna().groupBy("id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(max_labelled))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id")  # bounded by max_labelled
            .select("id", "label", "text").mapInArrow(_labelled, f"id {kind}, label int, failed boolean, x array<double>")
            .filter("not failed").groupBy("id").agg(F.min("label").alias("label"), F.min("x").alias("x")).select("label", "x").collect())
    good = np.array([r.x for r in rows if r.label > 0])
    if not len(good):
        return QualityModel()
    good = good[np.lexsort(good.T)]  # the order of collected rows must not matter
    every = np.array([r.x for r in rows])
    forest = Forest.grow(good, every.min(axis=0), every.max(axis=0), seed=seed)
    scores = np.sort(forest.score(good))
    limit = scores[len(scores) - 1 - int(max_good_rejected * len(scores))]
    bad = np.sort(forest.score(np.array([r.x for r in rows if r.label <= 0]).reshape(-1, good.shape[1])))
    above = bad[bad > limit]
    # well into the gap between the good rows' limit and the bad rows beyond it
    return QualityModel(forest, float(limit + 0.75 * (above[0] - limit) if len(above) else np.nextafter(limit, 2)))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``SLICE`` rows: what a worker holds as Python objects."""
    for b in batches:
        for at in range(0, len(b), SLICE):
            yield b.slice(at, SLICE)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _slices(batches):
        found = [text_counts(t) for t in b.column("text").to_pylist()]
        failed = base_failed(np.array([c for c, _ in found]).reshape(-1, 5))
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("label").cast(pa.int32()), pa.array(failed), pa.array([x for _, x in found], pa.list_(pa.float64()))],
            names=["id", "label", "failed", "x"])


def judge_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the counts, ``base_failed``, ``score`` (null
    without a forest) and ``kept``.

    A null or empty text has no words and fails the hard rules. Repeated rows
    are judged one by one and alike. Other columns, whatever their names, are
    not read. An empty table gives an empty result.
    """
    forest, threshold = model.forest, model.threshold

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            found = [text_counts(t) for t in b.column("text").to_pylist()]
            counts = np.array([c for c, _ in found], dtype=np.int64).reshape(-1, 5)
            failed = base_failed(counts)
            if forest is None:
                score = pa.nulls(len(found), pa.float64())
                kept = ~failed
            else:
                s = forest.score(np.array([x for _, x in found]).reshape(len(found), -1))
                score, kept = pa.array(s), ~failed & (s < threshold)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), score, pa.array(kept)],
                names=["id", *COUNTS, "base_failed", "score", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(judge, f"id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, "
                               "base_failed boolean, score double, kept boolean")
            .withColumnRenamed("id", id_col))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns.

    Judged inside the row (the whole row travels through the judge as one
    struct), so neither ids nor repeated rows matter and nothing is shuffled.
    """
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    at = [c.lower() for c in docs.columns].index(text_col.lower())  # the text travels inside the row only
    forest, threshold = model.forest, model.threshold

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            found = [text_counts(t) for t in b.column("row").field(at).to_pylist()]
            kept = ~base_failed(np.array([c for c, _ in found], dtype=np.int64).reshape(-1, 5))
            if forest is not None and len(found):
                kept &= forest.score(np.array([x for _, x in found])) < threshold
            yield pa.RecordBatch.from_arrays([b.column("row").filter(pa.array(kept))], names=["row"])

    return whole.mapInArrow(passing, whole.schema).select("row.*")

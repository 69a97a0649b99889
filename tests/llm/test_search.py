from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from helpers import DOCS, awkward, empty
from moodframe.llm import search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(items, docs, k=20):
    """Every document scored for every item: (item, rank) -> (doc_id, score)."""
    held = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in held]
    count, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for c in held for t in c)
    out = {}
    for item, text in items:
        found = []
        for (doc, _), c, n in zip(docs, held, sizes, strict=True):
            m = 100 - 25 + (25 * n * count) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(found, key=lambda r: r[:3])[:k], 1):
            out[item, rank] = doc, -score
    return out


def searched(spark, items, docs, **kw):
    docs = spark.createDataFrame([(*d, None, None, None) for d in docs], DOCS)
    rows = S.search(spark.createDataFrame(items, "item_id long, text string"), docs, **kw).collect()
    assert len({(r.item_id, r.rank) for r in rows}) == len(rows)
    return {(r.item_id, r.rank): (r.doc_id, r.score) for r in rows}


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.3:  # copies and near copies
            t = docs[-1][1].split()
            if t and rng.random() < 0.5:
                t[rng.randrange(len(t))] = rng.choice(words)
        else:
            t = rng.choices(words, weights, k=rng.randint(0, 60))
        docs.append((i, " ".join(t)))
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 15)))) for i in range(12)]
    return items, docs


@pytest.mark.parametrize("seed", range(2))
def test_every_document_scored(spark, seed, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)
    monkeypatch.setattr(S, "ITEMS", 5)  # several passes
    items, docs = corpus(seed, 500)
    assert searched(spark, items, docs) == brute(items, docs)


def test_small_cells(spark, monkeypatch):
    monkeypatch.setattr(S, "DOCS", 40)
    monkeypatch.setattr(S, "CELL", 1_000)  # cells are halved
    items, docs = corpus(7, 300)
    assert searched(spark, items, docs, k=3) == brute(items, docs, 3)


def test_ties_repeats_and_characters(spark):
    docs = [(9, "Hello hello WORLD"), (3, "hello world hello"), (3, "hello world hello"), (None, "hello world hello"), (4, "été Été x\x00y ÉTÉ"),
            (5, None), (6, "12-34 _a_ a"), (7, "")]
    items = [(1, "HELLO world hello"), (2, "été"), (3, "34 a a"), (4, None), (5, "absent"), (6, "É")]
    assert searched(spark, items, docs) == brute(items, docs)


def test_bounds_hold():
    """No block's bound is below the score of one of its documents."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 30, 200)
    vectors = [np.sort(rng.choice(100, n, replace=False)) for n in sizes]
    impacts = rng.integers(1, 10 ** 10, sizes.sum())
    terms, times = np.arange(0, 100, 7), np.arange(1, 16)
    beside = S._Beside([terms, np.setdiff1d(np.arange(100), terms)])
    ((n, cell),) = S._cell(np.arange(200), sizes, np.concatenate(vectors), impacts, beside)
    b = pa.RecordBatch.from_arrays([pa.array([list(range(n))]), *S._packed(cell)], names=["ids", *S._CELL])
    c = S._Cell(b, 0)
    weight = np.zeros(100, dtype=np.int64)
    weight[terms] = times
    scores = c.scores(np.arange(200), weight)
    bounds = c.bounds(np.arange(len(c.block_terms)), terms, times)
    for k, bound in enumerate(bounds):
        if c.block_terms[k] % 7:
            continue  # a list that the item does not open
        assert bound >= scores[c.block_docs[c.block_begins[k]:c.block_begins[k + 1]]].max()


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = spark.createDataFrame([(1, "word th er", 5), (None, "Été 中文", 6)], "item_id long, text string, term int")
    got = {(r.item_id, r.rank): (r.doc_id, r.score) for r in S.search(items, docs).collect()}
    assert got == brute([(1, "word th er"), (None, "Été 中文")], rows)
    assert S.search(items, empty(spark)).count() == 0 and S.search(items.limit(0), docs).count() == 0

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, awkward, empty
from moodframe.llm import substrings


def brute(rows, length):
    """(id, n_bytes, n_removed, n_spans, sha256) by counting every string."""
    data = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(b[p:p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if times[b[p:p + length]] > 1:
                gone[p:p + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(docs, **how):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                   for r in substrings.remove_repeats(docs, **how).collect()), key=repr)


@pytest.mark.parametrize("hot", [1000, 0])
def test_random_texts_with_shared_passages(spark, hot):
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcd é") for _ in range(rng.randint(20, 120))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = ["".join(rng.choice("abcd\n") for _ in range(rng.randint(0, 40))) if rng.random() < 0.5 else rng.choice(passages)
                 for _ in range(rng.randint(0, 6))]
        rows.append((i, "".join(parts), None, None, None))
    rows += [(100, "ab" * 200, None, None, None), (101, "x" * 150, None, None, None), (102, "x" * 149, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    assert got(docs, length=40, gram=8, hot=hot) == brute([r[:2] for r in rows], 40)


def test_planted_at_production_length(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    shared, edge = noise(400), noise(399)
    texts = [noise(300) + shared + noise(90), shared, noise(10) + edge + noise(500), noise(200) + edge, noise(3000)]
    texts += [texts[4][:1500] + "#" + texts[4][1500:]]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    assert got(docs) == brute(list(enumerate(texts)), 400)


def test_chunk_borders(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 64)
    rng = random.Random(6)
    base = "".join(rng.choice("abc") for _ in range(500))
    rows = [(1, base, None, None, None), (2, "zz" + base[100:400], None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    assert got(docs, length=40, gram=8) == brute([r[:2] for r in rows], 40)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()], 400)


def test_empty_table(spark):
    assert got(empty(spark)) == []

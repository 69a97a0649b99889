from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import DOCS, awkward, empty
from moodframe.llm import runs as R


def brute(w, least=12):
    """Every period, every stretch of equal words that far apart."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(rng):
    n, alphabet = rng.randint(0, 90), rng.choice([1, 2, 3, 8, 50])
    w = [rng.randrange(alphabet) for _ in range(n)]
    if n and rng.random() < 0.6:
        p, s = rng.randint(1, max(1, n // 2)), rng.randrange(n)
        for i in range(s + p, min(n, s + p * rng.randint(2, 6))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("seed", range(3))
def test_all_runs(seed):
    rng = random.Random(seed)
    for _ in range(400):
        w = planted(rng)
        assert R.runs(np.array(w, dtype=np.int64)) == brute(w)


def test_grammar_round_trip():
    rng = random.Random(5)
    for _ in range(200):
        w = planted(rng)
        sequence, rules, first = R.repair(w)

        def expand(s, rules=rules, first=first):
            return [s] if s < first else expand(rules[s - first][0]) + expand(rules[s - first][1])

        assert [x for s in sequence for x in expand(s)] == w
        pairs = [p for p in zip(sequence, sequence[1:], strict=False)]
        free = {p: 0 for p in pairs}
        last: dict = {}
        for i, p in enumerate(pairs):
            if last.get(p, -2) < i - 1:
                free[p] += 1
                last[p] = i
        assert all(n < 2 for n in free.values())  # no pair is left that occurs twice


def test_one_word_and_long_texts():
    assert R.runs(np.ones(50_000, dtype=np.int64)) == [(0, 50_000, 1)]
    unit = np.random.default_rng(1).integers(0, 10 ** 6, 10_000)
    assert R.runs(np.tile(unit, 3)) == [(0, 30_000, 10_000)]


def expected(doc_id, text):
    """A row of the contract, word by word."""
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_rows_of_the_query(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{x}" for x in planted(rng))) for i in range(150)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = R.run_digests(R.find_runs(docs, planted=True))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted((expected(*r) for r in rows), key=lambda r: r[0])


def test_awkward_rows(spark):
    docs = awkward(spark)
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    short = docs.filter("doc_id is null or doc_id <> 6")
    got = sorted(map(tuple, R.run_digests(R.find_runs(short, planted=True)).collect()), key=key)
    assert got == sorted((expected(r.doc_id, r.text) for r in short.collect()), key=key)
    assert R.find_runs(docs).count() == docs.count()


def test_empty_table(spark):
    assert R.run_digests(R.find_runs(empty(spark))).count() == 0

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from helpers import DOCS, awkward, empty, prose
from moodframe.llm import neardup
from moodframe.llm.components import components


def kmers(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.random()}"
    return " ".join(w)


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_classes_against_all_pairs(spark):
    rng = random.Random(1)
    rows = []
    for g in range(40):
        base = prose(g, rng.randint(20, 400)).replace("\n", " ")
        rows += [base] + [edited(rng, base, rng.randint(0, 12)) for _ in range(rng.randint(0, 5))]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(rows)], DOCS)
    sets = list(map(kmers, rows))
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert links and got == groups(links, range(len(rows)))


def test_one_large_group_of_near_copies(spark):
    """A chain of small edits: ends are unlike, neighbours alike, one class."""
    rng, text, rows = random.Random(2), prose(7, 300).replace("\n", " "), []
    for i in range(300):
        rows.append((i, text, None, None, None))
        text = edited(rng, text, 1)
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.class_id for r in got} == {0} and [r.doc_id for r in got if r.kept] == [0]


def test_pairs_among_texts_that_share_most_of_their_words(spark):
    """Most of every text is the same: unlike enough for classes of their own,
    but pairs of similar texts may share sketches of that part only."""
    rng, shared, rows = random.Random(3), " ".join(f"s{k}" for k in range(348)), []
    for i in range(200):
        own = [f"w{i}-{k}" for k in range(52)]
        rows.append(" ".join([shared, *own]))
        for k in rng.sample(range(0, 52, 6), 8):
            own[k] = f"new{i}-{k}"
        rows.append(" ".join([shared, *own]))
    sets = list(map(kmers, rows))
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(rows)], DOCS)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert len(links) == 200 and got == groups(links, range(len(rows)))


@pytest.mark.parametrize("common", [0, 50])
def test_similar_texts_share_a_kmer_of_their_prefixes(common):
    rng = np.random.default_rng(4)
    times = np.zeros(64, dtype=np.int32)  # counters that several k-mers share
    times[:common] = np.arange(common) + 2
    for _ in range(300):
        x = rng.permutation(200)[:rng.integers(1, 120)].astype(np.uint64)
        y = np.r_[np.delete(x, rng.integers(0, len(x), rng.integers(0, 13))), rng.integers(1000, 2000, rng.integers(0, 12))].astype(np.uint64)
        y = np.unique(y)
        x, y = sorted((x, y), key=len)
        if len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)):
            (first, shorter), (other, _) = neardup.prefixes(x, times), neardup.prefixes(y, times)
            assert set(first[:shorter].tolist()) & set(other.tolist())


def test_similarity_is_the_aligned_share():
    x = np.arange(100, dtype=np.uint64)
    assert neardup.similarity(x, x) == 1
    assert neardup.similarity(x, np.delete(x, [5, 50])) == pytest.approx(0.98)
    assert neardup.similarity(x, np.r_[x[50:], x[:50]]) == 0  # the same k-mers in another order
    assert neardup.similarity(x, x + 50) == 0 and neardup.similarity(x[:0], x[:0]) == 0


def test_counters_hold_the_sample(spark):
    sets = spark.createDataFrame([(bytes([i]), np.array([5, 7, 5 + neardup.COUNTERS], dtype="<u8").tobytes()) for i in range(9)],
                                 "node binary, kmers binary")
    table = neardup._counters(sets, 9)
    assert (table[5], table[7], table.sum()) == (18, 9, 27) and len(table) == neardup.COUNTERS


def test_the_same_kmers_in_another_order_are_no_duplicates(spark):
    """All labelled k-mers are shared, but not their order."""
    parts = [" ".join(f"p{k}w{i}" for i in range(40)) for k in range(6)]
    a, b = " sep sep sep sep sep ".join(parts), " sep sep sep sep sep ".join(parts[::-1])
    docs = spark.createDataFrame([(1, a, None, None, None), (2, b, None, None, None), (3, a + " end", None, None, None)], DOCS)
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_labels_tell_repeats_apart():
    flat, counts = neardup.labelled_kmers(["a " * 9, "a b", "", None, "a b c d e"])
    assert counts.tolist() == [5, 1, 0, 0, 1] and len(set(flat.tolist())) == 7


def test_components_of_a_path_a_star_and_pairs(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 301), (301, 300), (400, 400)]
    df = spark.createDataFrame([(str(a).zfill(4), str(b).zfill(4)) for a, b in links], "u string, v string")
    got = {r.node: r.component for r in components(df).collect()}
    want = groups([(str(a).zfill(4), str(b).zfill(4)) for a, b in links[:-1]], {str(x).zfill(4) for p in links[:-1] for x in p})
    assert got == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = neardup.near_duplicates(docs)
    assert out.count() == docs.count()
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == out.filter("kept").count()
    texts = [r.text for r in kept.collect()]
    assert texts.count(None) == 2 and len(set(texts) - {None}) == len(texts) - 2


def test_empty_table(spark):
    assert neardup.near_duplicates(empty(spark)).count() == 0
    assert neardup.drop_near_duplicates(empty(spark)).count() == 0


def test_buckets_of_one_text_carry_no_other_keys(spark, monkeypatch):
    tables = []
    plain = neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, name: tables.append((name, plain(df, name))) or tables[-1][1])
    rng = random.Random(4)
    texts = [prose(i, 120) for i in range(30)] + [edited(rng, prose(1, 120), 1) for _ in range(3)]
    neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    first = [(n, t) for n, t in tables if n in ("sketches", "buckets")][:3]
    assert [n for n, _ in first] == ["sketches", "buckets", "buckets"]
    assert first[0][1].count() == len(texts) and first[1][1].columns == ["t", "key", "node", "n"]
    assert {len(r.near) for r in first[2][1].collect()} == {neardup.NEAR} and first[2][1].count() < neardup.TABLES * len(texts)

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from helpers import DOCS, awkward, empty
from moodframe.llm import lines


def brute(rows, min_words):
    """Texts after deletion, by listing every window of every document."""
    seq = {k: (t or "").split("\n") for k, t in sorted(rows)}
    times = Counter(x for v in seq.values() for x in v)
    words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x))
    first, windows = {}, []
    for k, v in seq.items():
        for i, line in enumerate(v):
            total, j = 0, i
            while words(line) and j < len(v) and times[v[j]] > 1:
                total += words(v[j])
                j += 1
                if total >= min_words:
                    run = tuple(v[i:j])
                    first.setdefault(run, (k, i))
                    windows.append((run, k, i))
                    break
    gone = {k: set() for k in seq}
    for run, k, i in windows:
        if first[run] != (k, i):
            doc, at = first[run]
            gone[k] |= set(range(max(i, at + len(run)) if doc == k else i, i + len(run)))
    return {k: "\n".join(x for i, x in enumerate(v) if i not in gone[k]) for k, v in seq.items()}


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = ["a b c", "d", "", "e f g h", "i j", "  ", "k"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"u{rng.random()} w x" for _ in range(rng.randint(0, 14))),
             None, None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs, min_words=6).collect()}
    assert got == brute([r[:2] for r in rows], 6)


def test_long_run_and_overlaps(spark):
    run = [f"line {i} of a passage" for i in range(20)]
    rows = [(1, "\n".join(["one", *run, "two"])), (2, "\n".join(["x", *run[3:]])), (3, "\n".join(["same words in a line here ok yes"] * 5))]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = {r.doc_id: (r.text, r.lines_removed) for r in lines.dedup_lines(docs).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("x", 17), 3: ("same words in a line here ok yes", 4)}


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = lines.dedup_lines(docs)
    assert out.count() == docs.count() and set(out.columns) == {*docs.columns, "lines", "lines_removed"}
    kept = {(r.doc_id, r.text) for r in out.collect()}
    assert (3, None) in kept and (4, "") in kept and (5, " \n\t\n") in kept
    # rows with one id and text are one document; the same text under a higher id is a later copy
    assert out.filter("doc_id = 1 and lines_removed > 0").count() == 0 and out.filter("doc_id = 2 and lines_removed > 0").count() == 1


def test_empty_table(spark):
    assert lines.dedup_lines(empty(spark)).count() == 0

"""Periodic runs of words, found on a grammar.

A run is a stretch of words with smallest period q (words q apart are equal) of
at least ``max(least, 2 * q)`` words that no neighbouring word extends.

1. *Parts.* With ``least`` = 12 a run repeats at least six words in a row, and
   every word of it lies in such a repeated window, so only stretches covered by
   windows of six words that recur inside the stretch can hold runs.
2. *Grammar.* Re-Pair replaces the most frequent pair of symbols by a new
   nonterminal until no pair occurs twice; what is left is paired up evenly.
3. *Boundaries.* A run lies across the boundary between the two halves of the
   lowest nonterminal that derives all of it. For each nonterminal the longest
   common extensions from its boundary, for all periods at once from two
   Z-functions, give the repetitions across it. This is done once per
   nonterminal, however often it occurs.
4. *Positions.* Every nonterminal's repetitions are moved to all positions that
   it derives. What lies inside a longer one of the same period goes: those are
   the parts of a run that smaller nonterminals see.

Work is per document, so there is no shuffle, and a task holds a slice of a
batch and one document's grammar.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12
#: Texts that are looked at together, and their characters, unless one text has more.
SLICE, CHARACTERS = 500, 1 << 22


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _windows(words: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a window of ``size`` words that occurs twice in its owner."""
    n = len(words) - size + 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    if n > 0:
        h = owner[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(size):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n].astype(np.uint64)
        whole = np.flatnonzero(owner[:n] == owner[size - 1:])
        order = whole[np.argsort(h[whole], kind="stable")]
        same = h[order[1:]] == h[order[:-1]]
        found = np.unique(np.r_[order[1:][same], order[:-1][same]])
        np.add.at(covered, found, 1)
        np.add.at(covered, found + size, -1)
    return np.cumsum(covered)[:-1] > 0


def parts(words: np.ndarray, owner: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of words that can hold runs, none across owners."""
    at, owner = np.arange(len(words)), owner
    while len(at):
        keep = np.flatnonzero(_windows(words[at], owner, least // 2))
        smaller = at[keep]
        if not len(smaller):
            return []
        fresh = np.r_[True, (smaller[1:] != smaller[:-1] + 1) | (owner[keep][1:] != owner[keep][:-1])]
        if len(smaller) == len(at) and len(np.unique(owner)) == fresh.sum():
            begins = np.flatnonzero(fresh)
            ends = np.r_[begins[1:], len(smaller)]
            return [(int(smaller[a]), int(smaller[b - 1]) + 1) for a, b in zip(begins, ends, strict=True) if b - a >= least]
        at, owner = smaller, np.cumsum(fresh)  # a window must recur in its own stretch
    return []


def repair(words: list[int]) -> tuple[list[int], list[tuple[int, int]], int]:
    """(sequence, rules, first): symbols from ``first`` on stand for rules."""
    symbols, n = list(words), len(words)
    ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
    first = fresh = max(words, default=-1) + 1
    rules: list[tuple[int, int]] = []
    places: dict[tuple[int, int], set[int]] = {}
    for i in range(n - 1):
        places.setdefault((symbols[i], symbols[i + 1]), set()).add(i)
    queue = [(-len(p), pair) for pair, p in places.items() if len(p) > 1]
    heapify(queue)
    while queue:
        count, pair = heappop(queue)
        found = places.get(pair, ())
        if len(found) < 2:
            continue
        if len(found) != -count:
            heappush(queue, (-len(found), pair))
            continue
        a, b = pair
        at = sorted(found)
        if a == b:  # of overlapping places every other one counts
            free, kept = -1, []
            for i in at:
                if i >= free:
                    kept.append(i)
                    free = ahead[ahead[i]]
            at = kept
        del places[pair]
        if len(at) < 2:
            continue
        rules.append(pair)
        touched = set()
        for i in at:
            j = ahead[i]
            before, after = behind[i], ahead[j]
            if before >= 0:
                old = (symbols[before], a)
                if old in places:
                    places[old].discard(before)
                new = (symbols[before], fresh)
                places.setdefault(new, set()).add(before)
                touched.add(new)
            if after < n:
                old = (b, symbols[after])
                if old in places:
                    places[old].discard(j)
                new = (fresh, symbols[after])
                places.setdefault(new, set()).add(i)
                touched.add(new)
                behind[after] = i
            symbols[i], symbols[j], ahead[i] = fresh, -1, after
        for new in touched:
            if len(places[new]) > 1:
                heappush(queue, (-len(places[new]), new))
        fresh += 1
    return [s for s in symbols if s >= 0], rules, first


def _z(s: list[int]) -> list[int]:
    """For each suffix the length of its common prefix with the whole."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def across(w: list[int], b: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, end, period) of the repetitions in ``w`` across the boundary ``b``,
    as long as ``w`` lets them be, each with its smallest period."""
    n = len(w)
    forward = np.array(_z([*w[b:], -1, *w]))
    backward = np.array(_z([*w[b - 1::-1], -1, *w[::-1]])) if b else np.zeros(n + 2, dtype=int)
    right, left = np.arange(1, n - b + 1), np.arange(1, b + 1)
    # a word and the one a period later, on the right of the boundary; then on its left
    start = np.r_[b - backward[b + 1 + n - b - right], b - left - backward[left]]
    end = np.r_[b + right + forward[right], b + forward[n - b + 1 + b - left]]
    period = np.r_[right, left]
    ok = np.flatnonzero(end - start >= np.maximum(least, 2 * period))
    found: dict[tuple[int, int], int] = {}
    for s, e, q in zip(start[ok].tolist(), end[ok].tolist(), period[ok].tolist(), strict=True):
        if q < found.get((s, e), n + 1):
            found[s, e] = q
    return [(s, e, q) for (s, e), q in found.items()]


def _runs_of_part(words: list[int], least: int) -> list[tuple[int, int, int]]:
    sequence, rules, first = repair(words)
    while len(sequence) > 1:  # the start symbol's own rules: neighbours are paired up level by level
        paired = []
        for i in range(0, len(sequence) - 1, 2):
            rules.append((sequence[i], sequence[i + 1]))
            paired.append(first + len(rules) - 1)
        sequence = paired + sequence[len(paired) * 2:]
    texts: dict[int, list[int]] = {}

    def expand(s: int) -> list[int]:
        return [s] if s < first else texts[s]

    at: dict[int, list] = {sequence[0]: [np.zeros(1, dtype=np.int64)]}
    crossing: dict[int, list[tuple[int, int, int]]] = {}
    for k, (x, y) in enumerate(rules):
        texts[first + k] = w = expand(x) + expand(y)
        if len(w) >= least:
            crossing[first + k] = across(w, len(expand(x)), least)
    found = []
    for k in range(len(rules) - 1, -1, -1):
        s = first + k
        if s not in at or len(texts[s]) < least:
            continue
        places = np.concatenate(at.pop(s))
        x, y = rules[k]
        for child, move in ((x, 0), (y, len(expand(x)))):
            if child >= first:
                at.setdefault(child, []).append(places + move)
        found += [np.stack([places + a, places + e, np.full(len(places), q)]) for a, e, q in crossing[s]]
    if not found:
        return []
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((-end, start, period))
    out, last, reach = [], -1, -1
    for s, e, q in zip(start[order].tolist(), end[order].tolist(), period[order].tolist(), strict=True):
        if q != last:
            last, reach = q, -1
        if e > reach:
            out.append((s, e, q))
            reach = e
    return out


def runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    return sorted((b + s, e - s, q) for b, x in parts(words, np.zeros(len(words), dtype=np.int64), least)
                  for s, e, q in _runs_of_part(words[b:x].tolist(), least))


def repeat_words(words: list[bytes], doc_id) -> list[bytes]:
    """The words of the contract: a tenth of the documents, chosen by a checksum
    of the id, end in a repeated stretch."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(t or "") for t in batch.column("text").to_pylist()])
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and (i - begin >= SLICE or total + size > CHARACTERS):
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if len(sizes):
        yield batch.slice(begin)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, planted: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, ``runs`` (start, length, period) by
    start, then period, and ``collapsed``: the text's words joined by spaces,
    without those that a run contains after its first period.

    Words are separated by ASCII white space. A null or empty text has no runs
    and the empty ``collapsed``. Repeated rows are treated one by one; other
    columns are not read. An empty table gives an empty result. ``planted``:
    texts are first changed by ``repeat_words`` (null ids are left alone).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _slices(batch):
                number = _Numbers()
                texts = [(t or "").encode().split() for t in b.column("text").to_pylist()]
                if planted:
                    texts = [repeat_words(t, i) for t, i in zip(texts, b.column("id").to_pylist(), strict=True)]
                sizes = np.array([len(t) for t in texts], dtype=np.int64)
                begins = np.cumsum(sizes) - sizes
                flat = np.fromiter((number[w] for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
                found: list[list] = [[] for _ in texts]
                for x, y in parts(flat, np.repeat(np.arange(len(texts)), sizes), least):
                    doc = int(np.searchsorted(begins, x, side="right")) - 1
                    while not sizes[doc]:
                        doc -= 1
                    found[doc] += [(x - int(begins[doc]) + s, e - s, q) for s, e, q in _runs_of_part(flat[x:y].tolist(), least)]
                collapsed = []
                for t, spans in zip(texts, found, strict=True):
                    spans.sort(key=lambda r: (r[0], r[2]))
                    if spans:
                        keep = np.ones(len(t), dtype=bool)
                        for s, length, q in spans:
                            keep[s + q:s + length] = False
                        t = [t[i] for i in np.flatnonzero(keep)]
                    collapsed.append(b" ".join(t).decode())
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in x] for x in found]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, _RUNS), pa.array(collapsed, pa.string())],
                                                 names=["id", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string").withColumnRenamed("id", id_col))


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the longest run and digests of the rows of ``find_runs``."""
    longest = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
                       lambda a, r: F.when(a.isNull() | (r["length"] > a["length"]), r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

"""Packing documents into fixed-length token sequences by first-fit decreasing.

Documents are dealt into groups at random (a hash of id and content). Within a
group, whole multiples of the capacity are cut off long documents, and the rest
are placed longest first, each into the first bin that has room. A tournament
tree over the bins' free room (every node holds the larger room of its two
children) finds that bin in logarithmic time. The few bins that stay open give
their pieces away to fill one another, and the last one is cut at powers of two,
so no token is padding: a sequence is full or has a power of two of tokens.

One shuffle moves each document's ids once, as two or four bytes each. A group
has about ``GROUP`` documents, however many there are in all.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, END_ID, GROUP = 4096, 2, 1024
#: Words whose ids a task remembers before it starts anew.
REMEMBERED = 1_000_000
MARKS = ".,;:!?"
ODD = re.compile("[\x1c-\x1f]")


class Ids:
    """Token ids of texts. The tokenizer splits at white space before anything
    else, so a text's ids are its words' ids in turn, and words are remembered.
    It also parts letters from other characters and ignores case, so a new word
    of letters and closing marks is put together from its lower-cased letters
    and its marks; new letter runs are encoded many at a time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.known: dict[str, bytes] = {}
        # words may be put together if the tokenizer keeps letter runs whole and apart from marks
        probe = self.tokenizer.encode("Ab, \u00e9a b.", add_special_tokens=False).word_ids
        self.parts = probe is not None and sorted(set(probe)) == [0, 1, 2, 3, 4] and self._one("Ab") == self._one("ab")

    @staticmethod
    def of_worker(path: str) -> Ids:
        """One per Python worker process, so that later tasks know the words of earlier ones."""
        kept = sys.__dict__.setdefault("_moodframe_ids", {})
        if path not in kept:
            kept[path] = Ids(path)
        return kept[path]

    def _one(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _letters(self, new: set[str]) -> None:
        """Encode letter runs together; each is one word to the tokenizer, and known as one."""
        runs = sorted(new)
        for at in range(0, len(runs), 500):
            part = runs[at:at + 500]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, owner = np.array(e.ids, dtype=self.kind), np.array(e.word_ids)
            ends = np.searchsorted(owner, np.arange(len(part)), side="right").tolist()
            data, size, begin = ids.tobytes(), self.kind.itemsize, 0
            for w, end in zip(part, ends, strict=True):
                self.known[w] = data[begin * size:end * size]
                begin = end

    def _learn(self, new: set[str]) -> None:
        split = {}
        if self.parts:
            for w in new:
                bare = w.rstrip(MARKS)
                run = bare.lower()
                if run.isalpha() and len(run) == len(bare) and "\u03c3" not in run and "\u03c2" not in run and is_normalized("NFC", run):
                    split[w] = run
            self._letters({r for r in split.values() if r not in self.known})
        other = [w for w in new if w not in split]
        for at in range(0, len(other), 10_000):
            part = other[at:at + 10_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, dtype=self.kind).tobytes()
        for w, run in split.items():
            marks = w[len(run):]  # lower case keeps the length, or the run was not taken
            if marks and marks not in self.known:
                self.known[marks] = self._one(marks)
            self.known[w] = self.known[run] + self.known[marks] if marks else self.known[run]

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        # str.split() also splits at \x1c-\x1f, which the tokenizer does not call white space
        split = [[t] if t and ODD.search(t) else (t or "").split() for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new: set[str] = set()
        for words in split:
            new.update(words)
        self._learn(new.difference(self.known))
        end, known = np.array([end_id], dtype=self.kind).tobytes(), self.known.__getitem__
        return [b"".join(map(known, words)) + end for words in split]


class Rooms:
    """Tournament tree of the free room of up to ``n`` bins, all empty at first."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.most = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first bin with room for ``size``; takes the room."""
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            if most[at] < size:
                at += 1
        found = at - self.leaves
        most[at] -= size
        at //= 2
        while at:
            most[at] = max(most[2 * at], most[2 * at + 1])
            at //= 2
        return found


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every token once."""
    done, rests = [], []
    for doc, n in enumerate(lengths):
        cut = n - n % capacity
        done += [[(doc, at, capacity)] for at in range(0, cut, capacity)]
        if n > cut:
            rests.append((doc, cut, n - cut))
    rests.sort(key=lambda p: -p[2])
    rooms, bins = Rooms(len(rests), capacity), []
    for p in rests:
        k = rooms.place(p[2])
        if k == len(bins):
            bins.append([])
        bins[k].append(p)
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda k: -used[k])
    first, last = 0, len(order) - 1
    while first < last:  # the emptiest bin fills the fullest one
        to, giver = order[first], order[last]
        room = capacity - used[to]
        if not room:
            first += 1
        elif not bins[giver]:
            last -= 1
        else:
            doc, at, n = bins[giver].pop()
            if n > room:
                bins[giver].append((doc, at, n - room))
                doc, at, n = doc, at + n - room, room
            bins[to].append((doc, at, n))
            used[to] += n
            used[giver] -= n
    for k in order:
        left = used[k]
        while left:  # the last bin: a full one is a power of two or the capacity
            size = left if left == capacity else 1 << (left.bit_length() - 1)
            part, room = [], size
            while room:
                doc, at, n = bins[k].pop()
                if n > room:
                    bins[k].append((doc, at, n - room))
                    doc, at, n = doc, at + n - room, room
                part.append((doc, at, n))
                room -= n
            done.append(part)
            left -= size
    return done


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, group: int = GROUP, with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start (the document's tokens before it), length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit numbers), doc_tokens
    (with the end id), sequence_id, offset in the sequence, and ``ids`` if asked.

    A null or empty text is its end id alone. Repeated rows and null ids are
    documents of their own; other columns are not read. Documents of equal
    length keep an order by id and content, so reruns over the same files agree.
    An empty table gives an empty result.
    """
    n_groups = max(1, -(-docs.count() // group))
    kind = docs.schema[id_col].dataType.simpleString()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen = Ids.of_worker(tokenizer_path), Counter()
        for batch in batches:
            for at in range(0, len(batch), 1000):
                b = batch.slice(at, 1000)
                names, found = b.column("id").to_pylist(), ids.encode(b.column("text").to_pylist(), end_id)
                place = []
                for name, x in zip(names, found, strict=True):
                    key = xxhash.xxh64_intdigest(x + repr(name).encode())
                    seen[key] += 1  # identical rows go to different groups
                    place.append(xxhash.xxh64_intdigest(f"{key}:{seen[key]}") % n_groups)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(found, pa.binary()), pa.array(place, pa.int64())], names=["id", "ids", "part"])

    def fill(table: pa.Table) -> pa.Table:
        wide = np.dtype("<u4")
        ids = [np.frombuffer(x, dtype=narrow) for x in table.column("ids").to_pylist()]
        keys = [(-len(x), x[:8].tobytes(), repr(n)) for x, n in zip(ids, table.column("id").to_pylist(), strict=True)]
        order = sorted(range(len(ids)), key=keys.__getitem__)
        base, rows, parts = table.column("part")[0].as_py() << 32, [], []
        for k, pieces in enumerate(pack_lengths([len(ids[i]) for i in order], capacity)):
            offset = 0
            for doc, at, n in pieces:
                i = order[doc]
                part = ids[i][at:at + n].astype(wide)
                rows.append((i, at, n, zlib.crc32(part.tobytes()), len(ids[i]), base + k, offset))
                parts.append(part if with_ids else None)
                offset += n
        cols = list(zip(*rows, strict=True))
        out = [table.column("id").combine_chunks().take(pa.array(cols[0])), *(pa.array(c, pa.int64()) for c in cols[1:])]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).astype(np.int32))))
        return pa.Table.from_arrays(out, names=names)

    from tokenizers import Tokenizer

    narrow = np.dtype("<u2") if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else np.dtype("<u4")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"id {kind}, " + ", ".join(f"`{c}` long" for c in names[1:7]) + ", ids array<int>" * with_ids
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(tokenize, f"id {kind}, ids binary, part long")
            .groupBy("part").applyInArrow(fill, schema).withColumnRenamed("id", id_col))

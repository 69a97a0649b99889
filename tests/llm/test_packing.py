from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from moodframe.llm import packing
from tokenizers import Tokenizer

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ids():
    return packing.Ids(PATH)


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("text", [
    None, "", "  ", "Hello, World!", "don't I'LL", "Σας ΟΔΟΣ", "x²½Ⅷ", "İstanbul",
    "Å Å ﬁ", "<|endoftext|>a", "a\x1cb c\x1d d", "中文，x", "it's.,;: !? __a 12,5", "café… 　x y",
])
def test_word_wise_ids_are_the_tokenizers(tokenizer, ids, text):
    assert list(np.frombuffer(ids.encode([text], 2)[0], ids.kind)) == plain(tokenizer, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_ids_of_any_text(texts):
    ids, tokenizer = packing.Ids.of_worker(PATH), Tokenizer.from_file(PATH) if not hasattr(test_ids_of_any_text, "t") else test_ids_of_any_text.t
    test_ids_of_any_text.t = tokenizer
    for text, found in zip(texts, ids.encode(texts, 2), strict=True):
        assert list(np.frombuffer(found, ids.kind)) == plain(tokenizer, text)


def first_fit_decreasing(lengths, capacity):
    """Room by room, without a tree."""
    bins = []
    for n in sorted(lengths, reverse=True):
        for k, room in enumerate(bins):
            if room >= n:
                bins[k] -= n
                break
        else:
            bins.append(capacity - n)
    return [capacity - room for room in bins]


@pytest.mark.parametrize("seed", range(20))
def test_tournament_tree_is_first_fit(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(1, 60))), reverse=True)
    rooms, used = packing.Rooms(len(lengths), 64), defaultdict(int)
    for n in lengths:
        used[rooms.place(n)] += n
    assert [used[k] for k in sorted(used)] == first_fit_decreasing(lengths, 64)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=40))
def test_every_token_once_and_no_padding(lengths):
    sequences = packing.pack_lengths(lengths, 64)
    held = defaultdict(list)
    for s in sequences:
        size = sum(n for _, _, n in s)
        assert size <= 64 and size & (size - 1) == 0
        for doc, at, n in s:
            held[doc] += range(at, at + n)
    assert {d: sorted(x) for d, x in held.items()} == {d: list(range(n)) for d, n in enumerate(lengths)}


def check(df, texts, tokenizer):
    rows = df.collect()
    whole, at = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        whole[r.doc_id].append(r)
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= packing.CAPACITY
    wanted, got = defaultdict(int), defaultdict(int)
    for doc, text in texts:
        for k in plain(tokenizer, text):
            wanted[doc, k] += 1
    for r in rows:
        for k in r.ids:
            got[r.doc_id, k] += 1
    assert got == wanted


def test_awkward_rows(spark, tokenizer):
    docs = awkward(spark)
    check(packing.pack(docs, PATH, group=3), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0


def test_letter_runs_are_remembered_once():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    ids = packing.Ids(path)
    assert ids.parts
    texts = ["Word, word WORD! other.", "word other Words"]
    assert ids.encode(texts, 2) == packing.Ids(path).encode(texts, 2)
    held = [v for v in vars(ids).values() if isinstance(v, dict)]
    assert len(held) == 1 and sum(map(len, held)) == len(set("Word, word WORD! other. other Words words , ! .".split()))

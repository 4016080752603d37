from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from twohop.llm import packing
from twohop.llm.packing import pack_documents, plan
from twohop.llm.queries import BYTE_TOKENS


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 60))
def test_plan_places_all(lengths, size):
    made = plan(Counter(lengths), size)
    placed = Counter()
    for combination, times in made:
        assert times > 0 and sum(combination) <= size
        for x in combination:
            placed[x] += times
    assert placed == Counter(lengths)


def test_exact_complements_fill_sequences():
    counts = {600: 10, 424: 4, 400: 3, 24: 3, 300: 2, 100: 2}  # single, pair and triple complements of 600 in 1024
    made = plan(counts, 1024)
    assert sum(times for c, times in made if sum(c) == 1024) >= 7


def test_close_to_the_bound():
    rng = random.Random(1)
    lengths = Counter(rng.randint(1, 1024) for _ in range(20_000))
    total = sum(length * n for length, n in lengths.items())
    made = plan(lengths, 1024)
    assert sum(times for _, times in made) <= 1.01 * total / 1024
    assert len(made) < 10_000


def _check(docs, rows, size):
    theirs = Tokenizer.from_file(public_tokenizers.path(BYTE_TOKENS))
    want = Counter()
    for doc_id, text in docs:
        ids = [*theirs.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) - size * (-(-len(ids) // size) - 1)
        cuts = [0, *range(first, len(ids) + 1, size)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def test_against_brute_force(docs_of, corpus, monkeypatch):
    docs = [*corpus, corpus[9], corpus[9], (None, corpus[12][1]), (None, None)]
    path = public_tokenizers.path(BYTE_TOKENS)
    rows = pack_documents(docs_of(docs), path, 2).collect()
    n = _check(docs, rows, 1024)
    assert n <= -(-sum(r["length"] for r in rows) // 1024) + 1
    monkeypatch.setattr(packing, "SALT_ROWS", 7)
    rows = pack_documents(docs_of(docs), path, 2, size=64, with_ids=True).collect()
    _check(docs, rows, 64)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)


def test_nothing(docs_of):
    path = public_tokenizers.path(BYTE_TOKENS)
    assert pack_documents(docs_of([]), path, 2).collect() == []
    assert [(r["length"], r["offset"]) for r in pack_documents(docs_of([(1, None)]), path, 2).collect()] == [(1, 0)]

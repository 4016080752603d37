from __future__ import annotations

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from invented import prose, word
from twohop.llm import shingles
from twohop.llm.shingles import near_duplicates, signatures


def _set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def _brute(docs, size=4, percent=85):
    sets = [_set(t, size) for _, t in docs]
    ids = [d for d, _ in docs]
    comp = dict(zip(ids, ids, strict=True))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and None not in (ids[i], ids[j]) and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(ids[i]), find(ids[j])
                comp[max(x, y)] = min(x, y)
    return sorted([(d, len(s), None if d is None else find(d)) for d, s in zip(ids, sets, strict=True)], key=str)


def _run(docs_of, docs):
    return sorted([tuple(r) for r in near_duplicates(docs_of(docs)).collect()], key=str)


@pytest.mark.parametrize("rare", [32, 2, 1])
def test_against_brute_force(docs_of, corpus, monkeypatch, rare):
    """With few rare tokens allowed, the near copies are found by combinations."""
    monkeypatch.setattr(shingles, "RARE", rare)
    docs = [*corpus, corpus[-1], (None, corpus[-4][1]), (None, None)]
    found = _run(docs_of, docs)
    assert found == _brute(docs)
    assert sum(r[0] != r[2] for r in found) > 10


def test_chain_of_near_copies(docs_of, monkeypatch):
    """Neighbours in the chain link, its ends do not; all share a passage with texts that link with nothing."""
    import random

    monkeypatch.setattr(shingles, "RARE", 3)
    monkeypatch.setattr(shingles, "BLOCK_TOKENS", 800)
    rng = random.Random(3)
    words = [word(rng) for _ in range(120)]
    chain = []
    for i in range(30):
        words[(i * 7) % 120] = word(rng)
        chain.append((i, " ".join(words)))
    apart = [(100 + i, " ".join(words[:50]) + " " + prose(rng, 60)) for i in range(20)]
    docs = [*chain, *apart]
    assert _run(docs_of, docs) == _brute(docs)


def test_small_groups_and_buckets(docs_of, corpus, monkeypatch):
    monkeypatch.setattr(shingles, "GROUP_BYTES", 6_000)
    monkeypatch.setattr(shingles, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(shingles, "BLOCK_TOKENS", 300)
    assert _run(docs_of, corpus) == _brute(corpus)


def test_nothing(docs_of):
    assert _run(docs_of, []) == []
    assert _run(docs_of, [(2, None), (1, " "), (3, "a b"), (4, "A  b"), (5, "b a")]) == [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (5, 1, 5)]


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 260), st.data())
def test_similar_sets_share_an_entry(n, data):
    """Any two sets at or above the threshold meet, whatever the classes of their tokens."""
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    lost = data.draw(st.integers(0, int(n * 0.16)))
    both = rng.integers(0, 2**63, n - lost, dtype=np.uint64)
    a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, k, dtype=np.uint64)])) for k in (lost, data.draw(st.integers(0, lost))))
    shared = len(np.intersect1d(a, b))
    if 100 * shared < 85 * (len(a) + len(b) - shared):
        return
    share = data.draw(st.sampled_from([0.0, 0.3, 0.9, 1.0]))
    found = []
    for own in (a, b):
        frequent = (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) / 2**24 < share
        alone = ~np.isin(own, both) & ~frequent & (own % np.uint64(2) == 0)
        found.append(set(signatures(int(alone.sum()), own[~frequent & ~alone], own[frequent]).tolist()))
    assert found[0] & found[1]


def test_group_of_which_few_link(docs_of, monkeypatch):
    """Copies with many changes each: all share entries, few are similar enough, and not to the first."""
    import random

    monkeypatch.setattr(shingles, "RARE", 4)
    monkeypatch.setattr(shingles, "BLOCK_TOKENS", 700)
    rng = random.Random(9)
    base = prose(rng, 100).split(" ")
    docs = []
    for i in range(40):
        copy = list(base)
        for _ in range(rng.choice([1, 3, 5, 7])):
            copy[rng.randrange(100)] = word(rng)
        docs.append((i, " ".join(copy)))
    found = _run(docs_of, docs)
    assert found == _brute(docs)
    assert 1 < len({r[2] for r in found}) < 40


@pytest.mark.parametrize("small", range(9, 16))
@pytest.mark.parametrize("all_frequent", [True, False])
def test_sizes_around_single_tokens_share_an_entry(small, all_frequent):
    """Every size of partner of a small set, with frequent tokens only or one rare or unique token that the partner lacks."""
    keys = np.sort(np.random.default_rng(small).integers(0, 2**63, 40, dtype=np.uint64))
    for large in range(small, small + 4):
        if 100 * small >= 85 * large:
            a, b = (set(signatures(0, keys[:0], keys[:n]).tolist()) for n in (small, large))
            assert a & b
    if not all_frequent and 100 * (small - 1) >= 85 * (small + 1):
        for one in ((1, keys[:0]), (0, keys[30:31])):
            a, b = set(signatures(*one, keys[: small - 1]).tolist()), set(signatures(0, keys[:0], keys[:small]).tolist())
            assert a & b


def test_small_texts_of_frequent_tokens_only(docs_of):
    """Sets of 12 shingles whose only partners are sets of 13 and 14, all of whose shared tokens are frequent."""
    import random

    rng = random.Random(12)
    base = [word(rng) for _ in range(15)]
    docs = [(1, " ".join(base))]
    docs += [(10 + i, " ".join([*base, *[word(rng) for _ in range(1 + i % 2)]])) for i in range(40)]
    found = _run(docs_of, docs)
    assert found == _brute(docs)
    assert {r[2] for r in found} == {1}


def _templates(n):
    """Short texts of one form with two slots: all share tokens, none is similar to another."""
    return [f"welcome to city{a} we hope that you enjoy month{b}" for a in range(n) for b in range(n)]


def test_many_short_texts_of_one_form(docs_of, monkeypatch):
    monkeypatch.setattr(shingles, "BLOCK_DOCS", 60)
    texts = [*_templates(24), *(f"welcome to city{a} we hope that you enjoy month1 and all of its many long days" for a in range(3))]
    texts += [t + " indeed" for t in texts[-2:]]
    docs = list(enumerate(texts))
    found = _run(docs_of, docs)
    assert found == _brute(docs)
    assert sum(r[0] != r[2] for r in found) == 2


def test_a_block_is_compared_in_strips():
    """35 bytes a cell would be 315 MB here."""
    texts = _templates(55)[:3000]
    n = len(texts)
    table = pa.table({
        "b1": [1] * n, "b2": [1] * n, "doc_id": range(n), "component": range(n), "text": texts, "second": pa.array([False] * n),
    })
    compare = shingles._compare_blocks(4, 85)
    tracemalloc.start()
    found = compare(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 0
    assert peak < 60_000_000


def test_sets_that_only_equal_ones_match_are_not_indexed():
    for percent in (80, 85, 100):
        for n in range(1, 40):
            partners = any(100 * min(n, m) >= percent * max(n, m) for m in range(1, 80) if m != n) or 100 * (n - 1) >= percent * (n + 1)
            assert partners == (100 * n >= percent * (n + 1))

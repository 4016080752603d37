from __future__ import annotations

import re

from twohop.llm.decontaminate import build_index, contamination, matches

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, size):
    out = []
    for doc_id, text in docs:
        words, hit, found = _words(text), set(), set()
        for item_id, item in items:
            own = _words(item)
            n = min(size, len(own))
            for s in range(len(own) - n + 1 if n and item_id is not None else 0):
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == own[s : s + n]:
                        hit.update(range(i, i + n))
                        found.add(str(item_id))
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def _run(spark, docs_of, docs, items, size=10):
    table = spark.createDataFrame([(*x, "x") for x in items], "item_id bigint, text string, doc_id string")
    found = contamination(matches(build_index(docs_of(docs)), table, size))
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in found.collect()], key=str)


def test_against_brute_force(spark, docs_of, corpus):
    long = next(t for _, t in corpus if t and len(t.split()) > 5000)
    shared = corpus[-30][1] or "one two"
    items = [(1, " ".join(long.split()[100:130]) + " other words"), (2, "one"), (3, shared.upper()), (4, None), (5, " . "), (None, "one"), (11, "one")]
    docs = [*corpus, corpus[3], (None, corpus[3][1]), (None, None)]
    for size in (3, 10):
        assert _run(spark, docs_of, docs, items, size) == _brute(docs, items, size)


def test_nothing(spark, docs_of):
    assert _run(spark, docs_of, [], [(1, "a b c")]) == []
    assert _run(spark, docs_of, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_phrases_do_not_cross_documents(spark, docs_of):
    assert _run(spark, docs_of, [(1, "a b"), (2, "c d")], [(1, "b c")]) == [(1, 2, 0, []), (2, 2, 0, [])]


def test_spans_of_consecutive_windows(spark, docs_of):
    items = spark.createDataFrame([(7, "p q r s t")], "item_id bigint, text string")
    found = matches(build_index(docs_of([(1, "x p q r s t y")])), items, 3).where("item_id is not null")
    assert [(r["item_start"], r["start"], r["length"]) for r in found.collect()] == [(0, 1, 5)]


def test_proximity(spark, docs_of):
    docs = [(1, "cat sat on the mat"), (2, "mat the on x x x x cat"), (3, "the mat the cat")]
    items = spark.createDataFrame([(1, "cat mat")], "item_id bigint, text string")
    found = matches(build_index(docs_of(docs)), items, 2, reach=4).where("item_id is not null")
    assert {r["doc_id"] for r in found.collect()} == {1, 3}

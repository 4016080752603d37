from __future__ import annotations

import re

from twohop.llm import substring
from twohop.llm.substring import remove_repeats


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _brute(docs, size):
    order = sorted({d for d in docs if d[0] is not None}, key=lambda d: (d[0], d[1] or "", d[1] is not None))
    seen, gone = set(), {}
    for doc in order:
        words, own = _words(doc[1]), set()
        for i in range(len(words) - size + 1):
            gram = tuple(words[i : i + size])
            if gram in seen:
                own.update(range(i, i + size))
            seen.add(gram)
        gone[doc] = own
    out = []
    for doc in docs:
        words, own = _words(doc[1]), gone.get(doc, set())
        out.append((doc[0], len(words), len(own), " ".join(w for i, w in enumerate(words) if i not in own)))
    return sorted(out, key=str)


def _run(docs_of, docs, size):
    found = remove_repeats(docs_of(docs), size).collect()
    for r in found:
        assert sum(x["length"] for x in r["intervals"]) == r["n_removed"]
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found], key=str)


def test_against_brute_force(docs_of, corpus, monkeypatch):
    docs = [*corpus, (None, corpus[-20][1]), (None, None)]
    for size in (3, 20):
        assert _run(docs_of, docs, size) == _brute(docs, size)
    monkeypatch.setattr(substring, "GROUP_BYTES", 4_000)
    monkeypatch.setattr(substring, "BUCKET_WORDS", 700)
    assert _run(docs_of, docs, 20) == _brute(docs, 20)


def test_equal_rows_are_one_document(docs_of):
    text = "a b c d e a b c"
    docs = [(1, text), (1, text), (1, text + " z"), (2, "a b c q")]
    assert _run(docs_of, docs, 3) == _brute(docs, 3)


def test_nothing(docs_of):
    assert _run(docs_of, [], 20) == []
    assert _run(docs_of, [(1, None), (2, "")], 20) == [(1, 0, 0, ""), (2, 0, 0, "")]

from __future__ import annotations

from collections import defaultdict

from twohop.llm.lines import BLANKS, drop_frequent_lines


def _brute(docs, min_chars, min_docs):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(BLANKS))
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def _run(docs_of, docs, min_chars=40, min_docs=5):
    found = drop_frequent_lines(docs_of(docs), min_chars, min_docs).collect()
    return sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in found], key=str)


def test_against_brute_force(docs_of, corpus):
    docs = [*corpus, corpus[5], (None, corpus[-25][1]), (None, None)]
    found = _run(docs_of, docs)
    assert found == _brute(docs, 40, 5)
    assert sum(r[3] for r in found) > 0


def test_short_limits(docs_of):
    docs = [(i, "Same\n\n same \nown" + str(i % 3)) for i in range(6)] + [(9, "İ" * 4), (8, "İ" * 4)]
    for min_chars in (0, 1, 4, 5):
        assert _run(docs_of, docs, min_chars, 2) == _brute(docs, min_chars, 2)


def test_nothing(docs_of):
    assert _run(docs_of, []) == []
    assert _run(docs_of, [(1, None)]) == [(1, "", 1, 0)]


def test_other_columns_are_carried(docs_of):
    row = drop_frequent_lines(docs_of([(1, "a", "en")])).first()
    assert row["others"]["lang"] == "en" and row["others"]["gone"] == "x" and row["others"]["doc_id"] == 1


def test_same_id_with_different_texts(docs_of):
    """A frequent line of one text leaves the line at its place in the other alone."""
    docs = [(i, f"own {i}\ncommon") for i in range(5)] + [(1, "first\nsecond\ncommon"), (1, "common\nlast"), (1, "common\nlast"), (1, None)]
    assert _run(docs_of, docs, 1, 3) == _brute(docs, 1, 3)

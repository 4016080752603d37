from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from twohop.llm import queries, runs
from twohop.llm.runs import collapse_runs, find_runs
from twohop.llm.words import NOT_SPACE, Words


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[:-q])


def _brute(words, least=12):
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q) and _smallest_period(words[i : i + length]) == q:
                found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _texts():
    rng = random.Random(8)
    out = [None, "", " \n", "a", "a " * 11, "a " * 12, "a " * 4000, "a b " * 6, "a b " * 5 + "a", "x " + "a b c d e f " * 2 + "y"]
    out += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 300))) for _ in range(20)]
    out += [" ".join(rng.choice("abcdefg") for _ in range(150)) for _ in range(5)]
    for p in (1, 2, 5, 6, 7, 11, 12, 13, 23, 24, 25, 40, 100):
        unit = [rng.choice("abcxyz") for _ in range(p)]
        body = (unit * 9)[: p * 2 + rng.randint(0, 6 * p)]
        out.append(" ".join([rng.choice("abcxyz") for _ in range(rng.randint(0, 30))] + body + ["q"] * rng.randint(0, 14)))
    nested = (["a"] * 20 + ["b"]) * 5 + ["c"]
    out += [" ".join(nested * 3), "\t".join(nested * 2 + ["é"] * 13), " ".join((["u", "v"] * 7 + ["w"]) * 40)]
    return out


def _found(texts, least=12):
    words = Words(pa.array(texts, pa.string()), NOT_SPACE, fold=False)
    start, length, period = find_runs(words, least)
    row = words.rows[start] if len(start) else np.zeros(0, np.int64)
    out = [[] for _ in texts]
    for r, s, n, q in zip(row, start, length, period, strict=True):
        out[r].append((int(s - words.first[r]), int(n), int(q)))
    return out


def test_runs_against_brute_force(monkeypatch):
    texts = _texts()
    texts = [t for t in texts if len(_words(t)) < 2000]
    for least in (12, 2, 3, 7, 13):
        want = [_brute(_words(t), least) for t in texts]
        assert _found(texts, least) == want
        with monkeypatch.context() as m:
            m.setattr(runs, "STEP_PAIRS", 7)
            assert _found(texts, least) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=70), st.lists(st.sampled_from("abc"), min_size=1, max_size=20), st.integers(0, 5), st.integers(2, 16))
def test_any_words(before, unit, times, least):
    words = before + unit * times + before[:7]
    assert _found([" ".join(words), "z", " ".join(reversed(words))], least) == [_brute(words, least), [], _brute(words[::-1], least)]


def test_one_word_throughout_makes_few_pairs(monkeypatch):
    made = []
    seeds = runs._seeds

    def counted(*args):
        for places, lags in seeds(*args):
            made.append(len(places))
            yield places, lags

    monkeypatch.setattr(runs, "_seeds", counted)
    for n in (2_000, 16_000):
        made.clear()
        assert _found(["a " * n]) == [[(0, n, 1)]]
        assert sum(made) < 3 * n * np.log2(n)  # all pairs would be n^2 / 2


def test_operator(docs_of, corpus):
    docs = [*corpus, *enumerate(_texts(), 1000), (None, "a " * 30), (1, "b c " * 9), (1, "b c " * 9)]
    got = sorted([(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["kept"]) for r in collapse_runs(docs_of(docs)).collect()], key=str)
    want = []
    for i, text in docs:
        words = _words(text)
        found = [(0, len(words), 1)] if len(words) > 11 and len(set(words)) == 1 else _brute(words) if len(words) < 4000 else []
        want.append((i, len(words), found, _kept(words, found)))
    assert got == sorted(want, key=str)
    assert collapse_runs(docs_of([])).collect() == []


def test_query(spark, docs_of, corpus, tmp_path):
    rng = random.Random(3)
    docs = [*corpus, *enumerate(_texts(), 1000), *((i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 90)))) for i in range(3000, 3120))]
    docs_of(docs).write.parquet(str(tmp_path / "documents.parquet"))
    want, looped = [], 0
    for i, text in docs:
        words = _words(text)
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if x < a else words[a + (x - a) % p] for x, w in enumerate(words)]
            looped += 1
        found = [(0, n, 1)] if n > 11 and len(set(words)) == 1 else _brute(words) if n < 4000 else []
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        shown = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        want.append((i, n, len(found), *shown, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(_kept(words, found).encode()).hexdigest()))
    assert looped > 5
    found = queries.op12_run_detection(spark, str(tmp_path))
    names = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names and {t for _, t in found.dtypes} == {"bigint", "string"}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)

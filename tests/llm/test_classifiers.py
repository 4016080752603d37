from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from invented import prose
from pyspark.sql import functions as F

from twohop.llm.language import Parser, identify, keep_identified, language_samples, symbols
from twohop.llm.quality import isotonic, score_quality
from twohop.llm.statistics import NAMES, statistics
from twohop.llm import toxicity
from twohop.llm.toxicity import CATEGORIES, FOLDS, RIDGE, Chain, score_toxicity
from twohop.llm.words import text_buffer

ODD = [None, "", " \n", "123 ++", "é", "中文", "x" * 3000]


def _phrases(sample: bytes, text: bytes) -> int:
    """Longest matches with the sample, one after the other; a symbol that it lacks is a phrase."""
    n, at = 0, 0
    while at < len(text):
        length = 1
        while at + length < len(text) + 1 and text[at : at + length] in sample:
            length += 1
        at += max(length - 1, 1)
        n += 1
    return n


def test_parser_against_brute_force():
    rng = random.Random(4)
    sample = bytes(rng.choice(b"abc") for _ in range(120))
    names = np.full(256, 3)
    names[[97, 98, 99]] = [0, 1, 2]
    parser = Parser(sample, names, 4)
    for n in (1, 2, 17, 60):
        text = bytes(rng.choice(b"abcd" if n % 2 else b"abc") for _ in range(n))
        runs = names[np.frombuffer(text, np.uint8)][:, None].astype(np.int32)
        assert parser.phrases(runs, [1] * n).tolist() == [_phrases(sample, text)]


def test_symbols():
    data, bounds = text_buffer(pa.array(["Ab, -c", None, "ÉÀ9é", ""]))
    found, ends = symbols(data, bounds)
    assert [bytes(found[a:b]) for a, b in zip(ends, ends[1:], strict=False)] == [b"ab\0c", b"", "éà".encode() + b"\0" + "é".encode(), b""]


@pytest.fixture(scope="module")
def two_languages():
    rng = random.Random(8)
    one, two = (lambda n: prose(rng, n)), (lambda n: " ".join("".join(rng.choice(["ue", "cho", "zi", "lla", "ñe", "ro"]) for _ in range(3)) for _ in range(n)))
    return [(i, (one if i % 2 else two)(rng.randint(5, 60)), "aa" if i % 2 else "bb") for i in range(80)]


def test_language(docs_of, two_languages):
    docs = [(i, t, lang if i % 4 else None) for i, t, lang in two_languages] + [(200 + i, t, "aa") for i, t in enumerate(ODD)] + [(None, "a", None)] * 2
    found = {r["doc_id"]: r for r in identify(docs_of(docs), F.col("doc_id") < 200).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in two_languages)
    assert [found[200 + i]["lang_pred"] == "und" for i in range(len(ODD))] == [True, True, True, True, False, False, False]
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert identify(docs_of(docs), F.col("doc_id") < 200).count() == len(docs)
    kept = keep_identified(docs_of(docs), F.col("doc_id") < 200)
    assert kept.columns == docs_of(docs).columns and kept.count() == len(docs) - 4


def test_language_without_labels(docs_of):
    assert [r["lang_pred"] for r in identify(docs_of([(1, "word", None)]), F.lit(True)).collect()] == ["und"]
    assert identify(docs_of([]), F.lit(True)).collect() == []


def test_long_text_is_parsed_whole(docs_of, two_languages):
    """A text whose beginning is of one language and the far larger rest of the other."""
    one, two = (" ".join(t for _, t, x in two_languages if x == lang) for lang in ("aa", "bb"))
    docs = [*two_languages, (500, one[:300] + " " + two * 3, None)]
    found = {r["doc_id"]: r["lang_pred"] for r in identify(docs_of(docs), F.col("doc_id") < 200).collect()}
    assert found[500] == "bb"


def test_language_of_long_texts_only(docs_of, two_languages):
    """Long labelled texts are learnt from, whatever stands before their letters and however many labelled texts have none."""
    long = [(i, "1 " * 6000 + " ".join([t] * (9000 // len(t) + 1)), lang) for i, t, lang in two_languages]
    letterless = [(1000 + i, "12 34", lang) for i in range(150) for lang in ("aa", "bb")]
    for labelled in ([x for x in long if x[2] == "aa"] + [x for x in two_languages if x[2] == "bb"], [*long, *letterless]):
        unknown = [(5000 + i, t, None) for i, t, _ in two_languages]
        found = {r["doc_id"]: r["lang_pred"] for r in identify(docs_of([*labelled, *unknown]), F.col("doc_id") < 5000).collect()}
        assert all(found[5000 + i] == lang for i, _, lang in two_languages)
    assert all(len(x) <= 48_000 for _, x in language_samples(docs_of(long).select("doc_id", "text", "lang")))


def test_sample_of_wide_characters_is_cut(docs_of):
    (_, sample), = language_samples(docs_of([(1, "語" * 9000, "zh")]).select("doc_id", "text", "lang"))
    assert sample.decode() == "語" * (8000 // 3)


def test_statistics():
    found = statistics(pa.array([None, "", "Aa aa  AA!\n12", " \t"]))
    assert found.shape == (4, len(NAMES)) and not found[[0, 1, 3]].any() and np.isfinite(found).all()
    row = dict(zip(NAMES, found[2], strict=True))
    assert row["log_words"] == np.log1p(4) and row["upper_share"] == 3 / 6 and row["repeated_next"] == 1 / 4
    assert row["distinct_share"] == 3 / 4 and row["letterless_words"] == 1 / 4 and row["top_share"] == 2 / 4


def test_isotonic():
    knots, shares = isotonic(np.array([4.0, 0, 4, 4, 4]), np.array([0.0, 0, 3, 2, 4]))
    assert (np.diff(shares) > 0).all() and (np.diff(knots) > 0).all()
    assert knots.tolist() == [0, 2.5, 4]


def _labelled(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, stats string")


def test_quality(spark, docs_of):
    rng = random.Random(6)
    docs = [(i, prose(rng, rng.randint(5, 80)) if i % 3 else " ".join(["JUNK!!"] * rng.randint(5, 80))) for i in range(300)]
    labels = [(i, int(i % 3 > 0), None) for i, _ in docs] + [(0, None, 0), (None, 1, 1), (9999, 1, 0), (1, 1, 0)]
    odd = [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (5, docs[5][1])]
    found = score_quality(docs_of([*docs, *odd]), _labelled(spark, labels), F.col("doc_id") % 5 != 0, F.col("doc_id") % 4).collect()
    assert len(found) == len(docs) + len(odd)
    score = {r["doc_id"]: r["score"] for r in found}
    assert all(0 <= s <= 1 for s in score.values())
    held = [i for i, _ in docs if i % 5 == 0]
    assert all((score[i] >= 0.3) == (i % 3 > 0) for i in held)


def test_without_labels(spark, docs_of):
    docs = docs_of([(1, "a"), (2, None)])
    none = _labelled(spark, [])
    assert [r["score"] for r in score_quality(docs, none, F.lit(True), F.lit(0)).collect()] == [0.5, 0.5]
    assert [r["toxic"] for r in score_toxicity(docs, none, F.lit(True)).collect()] == [0.0, 0.0]
    assert score_quality(docs_of([]), none, F.lit(True), F.lit(0)).collect() == []
    assert score_toxicity(docs_of([]), none, F.lit(True)).collect() == []


def test_toxicity(spark, docs_of):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randint(10, 60)).split()
        if i % 4 == 0:
            for _ in range(rng.randint(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["Grubling", "grubter,", "snarkish"]))
        docs.append((i, " ".join(words) if i % 7 else " ".join(w.upper() + "##low" for w in words)))
        labels.append((i, int(i % 7 > 0), int(i % 4 == 0)))
    odd = [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "a"), (3, docs[3][1]), (2000, "so GRUBwort it is")]
    labels += [(1, None, None), (None, 0, 1), (2, 1, 0)]
    found = score_toxicity(docs_of([*docs, *odd]), _labelled(spark, labels), F.col("doc_id") % 5 != 0).collect()
    assert len(found) == len(docs) + len(odd) and set(CATEGORIES) < set(found[0].asDict())
    by_id = {r["doc_id"]: r for r in found}
    assert all((by_id[i]["toxic"] >= 0.5) == (i % 4 == 0) for i in range(0, 400, 5))
    assert by_id[2000]["toxic"] >= 0.5
    assert all((by_id[i]["low_quality"] >= 0.5) == (i % 7 == 0) for i in range(0, 400, 5))
    # A dozen learnt rows carry both labels: the ridge keeps their probabilities low, but above all others.
    both, others = ([by_id[i]["toxic_low_quality"] for i in range(0, 400, 5) if (i % 28 == 0) == own] for own in (True, False))
    assert min(both) > max(others)


def test_chain_against_one_fit_in_memory(spark):
    """Sums by partition give the weights of a plain gradient descent over all rows at once."""
    rng = np.random.default_rng(3)
    x = np.hstack([rng.random((90, 3)) < 0.5, np.ones((90, 1))]).astype(np.float32)
    toxic, low = (x[:, 0] + rng.random(90) > 0.9).astype(int), (x[:, 1] + rng.random(90) > 0.9).astype(int)
    folds = rng.integers(0, FOLDS, 90)
    rows = [(x[i].tobytes(), int(low[i]), int(toxic[i]), int(low[i] * toxic[i]), int(folds[i])) for i in range(90)]
    frame = spark.createDataFrame(rows, "x binary, low_quality int, toxic int, toxic_low_quality int, fold int").repartition(5)
    chain = Chain(frame, 4)

    def fit(own, y):
        w = np.zeros(own.shape[1])
        for _ in range(6000):
            w -= 0.02 * (own.T @ (1 / (1 + np.exp(-own @ w)) - y) + RIDGE * w)
        return w

    own = x.astype(float)
    for j, y in enumerate((low, toxic, low * toxic)):
        assert np.allclose(chain.weights[j], fit(own, y), atol=1e-4)
        held = np.zeros(90)
        for f in range(FOLDS):
            w = fit(own[folds != f], y[folds != f])
            held[folds == f] = 1 / (1 + np.exp(-own[folds == f] @ w))
        own = np.hstack([own, held[:, None]])


def test_many_rows_of_one_labelled_document(spark, docs_of, monkeypatch):
    """What is learnt from is one row a document, however many there are."""
    fitted = []

    class Counting(Chain):
        def __init__(self, rows, width):
            fitted.append(rows.count())
            super().__init__(rows, width)

    monkeypatch.setattr(toxicity, "Chain", Counting)
    docs = [(i, f"word{i % 9} " + ("grub" if i % 2 else "fine")) for i in range(40)] + [(1, f"grub {i}") for i in range(3000)]
    found = score_toxicity(docs_of(docs), _labelled(spark, [(i, 1, i % 2) for i in range(40)]), F.lit(True))
    assert found.count() == 3040 and fitted == [40]

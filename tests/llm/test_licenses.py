from __future__ import annotations

import re

import pytest

from twohop.llm import queries
from twohop.llm.licenses import BASE, NOTICES, evaluate, scan_licenses

ODD = [
    None, "", "  \n", "mit", "MIT", "license mit", "The MIT License.", "Mit License", "mit-license CC_BY cc by by", "CC BY-NC 4.0",
    "GNU General\n\nPublic (License) gnu general public license gnu general public", "summit license", "MIT Licenses", "MIT Licensé",
    "apache license mit license apache license", "x " * 5000 + "Apache License " + "y " * 5000, "Lizenz: größe CC BY", "\x00MIT\x7fLicense\x1f",
]


def _brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in BASE.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [i for i, _ in places]
    others = {label for phrase, label in NOTICES.items() if f" {phrase} " in f" {' '.join(words)} "}
    base = sorted({label for _, label in places})
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), base, sorted(others | set(base)))


def test_against_brute_force(docs_of, corpus):
    docs = [*corpus, *enumerate(ODD, 1000), (None, "MIT License"), (1, "cc by"), (1, "cc by")]
    found = scan_licenses(docs_of(docs)).collect()
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in found]
    assert sorted(got, key=str) == sorted(((d[0], *_brute(d[1])) for d in docs), key=str)
    for r in found:
        assert 0 <= r["score"] < 1 and (r["score"] > 0) == bool(r["labels"]) == bool(r["evidence"])


def test_nothing(docs_of):
    assert scan_licenses(docs_of([])).collect() == []


@pytest.mark.parametrize(
    ("line", "ordered", "labels", "permissive"),
    [
        ("MIT", "MIT", {"mit"}, True),
        ("mit or GPL-2.0-only and Apache-2.0", "(mit OR (GPL-2.0-only AND Apache-2.0))", {"mit", "gpl", "apache"}, True),
        ("(MIT OR GPL-2.0+) AND CC-BY-SA-4.0 */", "((MIT OR GPL-2.0+) AND CC-BY-SA-4.0)", {"mit", "gpl", "cc-by-sa"}, False),
        ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", "((GPL-2.0 WITH Classpath-exception-2.0) AND MIT)", {"gpl", "mit"}, True),
        ("GPL-3.0 with My-own OR AGPL-3.0", "((GPL-3.0 WITH My-own) OR AGPL-3.0)", {"gpl", "agpl"}, False),
        ("MIT OR", "MIT", {"mit"}, True),
        ("MIT AND (", "MIT", {"mit"}, True),
        ("((ISC", "ISC", {"isc"}, True),
        ("BSD-3-Clause Apache-2.0", "BSD-3-Clause", {"bsd"}, True),
        ("MIT) OR GPL-2.0", "MIT", {"mit"}, True),
        ("LicenseRef-Mine AND 0BSD", "(LicenseRef-Mine AND 0BSD)", {"licenseref-mine", "bsd"}, False),
        ("a OR b AND c OR d WITH e", "((a OR (b AND c)) OR (d WITH e))", {"a", "b", "c", "d"}, False),
    ],
)
def test_expressions(line, ordered, labels, permissive):
    worth, text = evaluate(line.encode())
    assert (text, worth.labels, worth.permissive) == (ordered, labels, permissive)
    assert 0 < worth.certainty < 1


def test_no_expression():
    for line in (b"", b"*/", b"AND MIT", b"()", b"(", b"\xc3\xa9"):
        assert evaluate(line) is None


def test_tags(docs_of):
    texts = {
        1: "# SPDX-License-Identifier: MIT OR GPL-2.0-only\nGPL elsewhere",
        2: "spdx license identifier: MIT",
        3: "// spdx-license-identifier:Apache-2.0 WITH LLVM-exception\n",
        4: 'license_expression = "BSD-3-Clause AND MIT"',
        5: "SPDX-License-Identifier:\nMIT",
        6: "Ünder the MIT License. SPDX-License-Identifier: GPL-3.0-or-later",
    }
    found = {r["doc_id"]: r for r in scan_licenses(docs_of(list(texts.items()))).collect()}
    assert [found[i]["labels"] for i in sorted(found)] == [["gpl", "mit"], [], ["apache"], ["bsd", "mit"], [], ["gpl", "mit"]]
    assert [found[i]["permissive"] for i in sorted(found)] == [True, None, True, True, None, False]
    assert found[6]["base_labels"] == ["mit"] and found[6]["score"] > found[1]["score"] - 0.01
    assert [(e["kind"], e["word"]) for e in found[6]["evidence"]] == [("base", 2), ("expression", 4)]


def test_query(spark, docs_of, corpus, tmp_path):
    docs = [*corpus, *enumerate(ODD, 1000)]
    docs_of(docs).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_license_scan(spark, str(tmp_path)).collect()
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in found]
    want = [(i, n, b, f, e, ",".join(bl), ",".join(al)) for i, text in docs for n, b, f, e, bl, al in [_brute(text)]]
    assert sorted(got) == sorted(want)

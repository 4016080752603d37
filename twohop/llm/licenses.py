"""License scans: notice phrases and identifier tags, and the licence expressions behind the tags.

Method: the words of whole texts, A-Z as a-z, go through one Aho-Corasick automaton that holds the notice
phrases and the names of identifier tags. Behind a tag that its raw text confirms, the licence expression is read to the
end of its line: a shunting-yard parser orders ``WITH`` before ``AND`` before ``OR``, parentheses first, and evaluates as it reduces.

A notice is a place where the words of a phrase stand consecutively; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, numbered from 0.
An expression is worth its labels, whether permissive licences alone satisfy it (``OR``: either side, ``AND``: both, ``WITH``: a
known exception to a copyleft licence does), and its certainty (``OR``: the larger, ``AND``: the smaller). It ends before
the first token that cannot continue it; an operator without a right side is dropped, an open parenthesis is closed.

``score`` is the certainty that the text states a licence: over its different labels, one minus the product of what
the best evidence for each leaves open. Each text is read by itself, in pieces of a few MB or one text, and nothing is shuffled.

Defined results: null or empty text has no words, no labels and score 0; a row without ``doc_id`` is scanned like any other; rows
with the same ``doc_id`` are each returned; phrases that overlap all count; a tag without an expression is no evidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from twohop.llm.tables import texts_of
from twohop.llm.words import ALNUM, pieces, text_buffer

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Further notices and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "isc license": "isc",
    "zlib license": "zlib",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution sharealike": "cc-by-sa",
    "creativecommons org licenses by": "cc-by",
    "creativecommons org licenses by nc": "cc-by-nc",
    "creativecommons org licenses by nd": "cc-by-nd",
    "creativecommons org licenses by sa": "cc-by-sa",
    "creativecommons org publicdomain zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

#: Names of identifier tags, as words and as they must stand in the text.
TAGS = {
    "spdx license identifier": rb"spdx-license-identifier[ \t]*:[ \t]*",
    "license expression": rb"license[-_]expression[\"']?[ \t]*[:=][ \t\"']*",
}

#: Families of licence identifiers, and whether they are permissive.
FAMILIES = {
    "0bsd": True, "agpl": False, "apache": True, "artistic": True, "bsd": True, "bsl": True, "cc-by": True, "cc-by-nc": False,
    "cc-by-nd": False, "cc-by-sa": False, "cc0": True, "epl": False, "eupl": False, "gpl": False, "isc": True, "lgpl": False,
    "mit": True, "mpl": False, "ncsa": True, "ofl": True, "postgresql": True, "psf": True, "unlicense": True, "wtfpl": True, "zlib": True,
}
#: Identifier families known under another label, labels of notices that are no family, and exceptions to copyleft.
OTHER_LABELS = {"0bsd": "bsd", "bsl": "boost"}
NOTICE_PERMISSIVE = {"boost": True, "public-domain": True, "all-rights-reserved": False}
EXCEPTIONS = ("classpath-exception", "gcc-exception", "llvm-exception", "linux-syscall-note", "openssl-exception", "autoconf-exception", "bison-exception", "font-exception")

#: Certainty of evidence: a known identifier behind a tag, a base notice, another notice, an identifier not known.
CERTAIN, BASE_NOTICE, OTHER_NOTICE, UNKNOWN = 0.98, 0.9, 0.7, 0.5

_RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, "
    "permissive boolean, score double, evidence array<struct<label:string,kind:string,word:bigint,text:string>>"
)

_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_BINDS = {"or": 1, "and": 2, "with": 3}
_FOLDED = np.where(ALNUM, np.arange(256), 0x20).astype(np.uint8)
_FOLDED[0x41:0x5B] += 32
_FOLDED[0x80:] = 0x7E  # no phrase has such a byte, and one symbol for all keeps the text ASCII


@dataclass(frozen=True)
class Worth:
    """What an expression is worth: its labels, whether permissive licences alone satisfy it, its certainty."""

    labels: frozenset[str]
    permissive: bool
    certainty: float


def identifier(name: str) -> Worth:
    """A licence identifier by the longest family that it begins with; an unknown one is its own label."""
    low = name.lower().rstrip("+")
    stems = low.split("-")
    for n in range(len(stems), 0, -1):
        family = "-".join(stems[:n])
        if family in FAMILIES:
            return Worth(frozenset([OTHER_LABELS.get(family, family)]), FAMILIES[family], CERTAIN)
    return Worth(frozenset([low]), False, UNKNOWN)


def _reduce(operator: str, values: list[Worth], names: list[str]) -> None:
    right, left = values.pop(), values.pop()
    named, names[-2:] = names[-1], [f"({names[-2]} {operator.upper()} {names[-1]})"]
    if operator == "with":
        known = named.lower().startswith(EXCEPTIONS)
        values.append(Worth(left.labels, left.permissive or known, left.certainty if known else min(left.certainty, UNKNOWN)))
    elif operator == "and":
        values.append(Worth(left.labels | right.labels, left.permissive and right.permissive, min(left.certainty, right.certainty)))
    else:
        values.append(Worth(left.labels | right.labels, left.permissive or right.permissive, max(left.certainty, right.certainty)))


def evaluate(line: bytes) -> tuple[Worth, str] | None:
    """The licence expression that ``line`` begins with: its worth, and itself with every pair in parentheses."""
    values: list[Worth] = []
    names: list[str] = []
    operators: list[str] = []
    wants, at = True, 0  # an operand comes next

    def close(down_to: int) -> None:
        while operators and operators[-1] != "(" and _BINDS[operators[-1]] >= down_to:
            _reduce(operators.pop(), values, names)

    while found := _TOKEN.match(line, at):
        token = found[1].decode()
        word = token.lower()
        if wants and token == "(":
            operators.append(token)
        elif wants and word not in _BINDS and token != ")":
            values.append(identifier(token))
            names.append(token)
            wants = False
        elif not wants and word in _BINDS:
            close(_BINDS[word])
            operators.append(word)
            wants = True
        elif not wants and token == ")" and "(" in operators:
            close(0)
            operators.pop()
        else:
            break
        at = found.end()
    if not values:
        return None
    while wants and operators:  # what waits for a right side that does not come
        wants = operators.pop() == "("
    while operators:
        close(0)
        if operators:
            operators.pop()
    return values[-1], names[-1]


class _Scanner:
    """The automaton over ``" word word "``, and the reading of what it finds."""

    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for phrase in {**BASE, **NOTICES, **TAGS}:
            self.automaton.add_word(f" {phrase} ", phrase)
        self.automaton.make_automaton()
        self.tags = {phrase: re.compile(form, re.IGNORECASE) for phrase, form in TAGS.items()}

    def scan(self, column: pa.Array) -> tuple[np.ndarray, dict[int, list[tuple[int, str]]], np.ndarray, np.ndarray, np.ndarray]:
        """Words per row; by row the places ``(word, phrase)`` in order; the bytes, bounds of rows, and where words begin."""
        data, bounds = text_buffer(column)
        folded = _FOLDED[data]
        inside = folded != 0x20
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        firsts = bounds[:-1][bounds[:-1] < len(data)]
        before[firsts] = False
        starts = np.flatnonzero(inside & ~before)
        first = np.searchsorted(starts, bounds)
        # One blank between words, and a mark between rows that no phrase has.
        kept = inside | before
        ends = np.concatenate([[0], np.cumsum(kept)])[bounds]
        stream = np.insert(folded[kept], np.repeat(ends, 3), np.tile(np.array([0x20, 0x0A, 0x20], np.uint8), len(ends)))
        del folded, inside, before, kept
        places: dict[int, list[tuple[int, str]]] = {}
        hits = [(end, phrase) for end, phrase in self.automaton.iter(stream.tobytes().decode("ascii"))]
        if hits:
            blank = (stream == 0x20) | (stream == 0x0A)
            begins = np.flatnonzero(~blank[1:] & blank[:-1])  # the blank before each word
            at = np.searchsorted(begins, np.array([end - len(phrase) - 1 for end, phrase in hits]))
            rows = np.searchsorted(first, at, "right") - 1
            for (_, phrase), word, row in sorted(zip(hits, at.tolist(), rows.tolist(), strict=True), key=lambda x: (x[1], x[0][1])):
                places.setdefault(row, []).append((word - int(first[row]), phrase))
        return first, places, data, bounds, starts

    def read(self, places: list[tuple[int, str]], raw: bytes, word_starts: np.ndarray) -> dict:
        """What the places of one text amount to; ``word_starts``: where its words begin in its bytes."""
        evidence, best, permits = [], {}, {}
        base = [(word, BASE[phrase]) for word, phrase in places if phrase in BASE]
        for word, phrase in places:
            if phrase in TAGS:
                start = int(word_starts[word])
                stop = raw.find(b"\n", start)
                line = raw[start : stop if stop >= 0 else len(raw)]
                tag = self.tags[phrase].match(line)
                found = evaluate(line[tag.end() :]) if tag else None
                if found:
                    worth, text = found
                    for label in sorted(worth.labels):
                        evidence.append((label, "expression", word, text))
                        best[label] = max(best.get(label, 0.0), worth.certainty)
                    permits.setdefault("expressions", []).append(worth.permissive)
            else:
                label = BASE.get(phrase) or NOTICES[phrase]
                evidence.append((label, "base" if phrase in BASE else "notice", word, phrase))
                best[label] = max(best.get(label, 0.0), BASE_NOTICE if phrase in BASE else OTHER_NOTICE)
                permits.setdefault(label, []).append(NOTICE_PERMISSIVE.get(label, FAMILIES.get(label, False)))
        open_left = 1.0
        for label in sorted(best):
            open_left *= 1.0 - best[label]
        starts = [word for word, _ in base]
        return {
            "n_base": len(base),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": sorted({label for _, label in base}),
            "labels": sorted(best),
            "permissive": all(all(x) for x in permits.values()) if permits else None,
            "score": 1.0 - open_left,
            "evidence": [dict(zip(("label", "kind", "word", "text"), x, strict=True)) for x in evidence],
        }


_NOTHING = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": [], "labels": [], "permissive": None, "score": 0.0, "evidence": []}
_EVIDENCE = pa.struct([("label", pa.string()), ("kind", pa.string()), ("word", pa.int64()), ("text", pa.string())])
_KINDS = {
    "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.list_(pa.string()), "labels": pa.list_(pa.string()),
    "permissive": pa.bool_(), "score": pa.float64(), "evidence": pa.list_(_EVIDENCE),
}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = _Scanner()
    for piece in pieces(batches):
        first, places, data, bounds, starts = scanner.scan(piece.column("text"))
        found = [_NOTHING] * piece.num_rows
        for row, own in places.items():
            raw = data[bounds[row] : bounds[row + 1]].tobytes()
            found[row] = scanner.read(own, raw, starts[first[row] : first[row + 1]] - bounds[row])
        columns = {name: pa.array([x[name] for x in found], kind) for name, kind in _KINDS.items()}
        yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "n_words": pa.array(np.diff(first).astype(np.int64)), **columns})


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words``; of the base notices ``n_base, first_word, last_word, base_labels``; of all evidence
    ``labels, permissive`` (NULL without evidence), ``score`` and ``evidence`` (label, kind, word, text) in order of its words."""
    return texts_of(docs).mapInArrow(_scan, _RESULT)

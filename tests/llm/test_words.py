from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from twohop.llm.blocks import pack, unpack
from twohop.llm.words import ALNUM, NOT_SPACE, Words, pieces

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \t\n\x0b\x0c\r.-é中", max_size=30)), max_size=8)


def _cut(text, kept, fold):
    data = (text or "").encode()
    found = re.findall(rb"[^\x20\x09-\x0D]+" if kept is NOT_SPACE else rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", data)
    return [w.lower() if fold else w for w in found]


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_and_keys(rows):
    for kept, fold in ((NOT_SPACE, False), (ALNUM, True)):
        words = Words(pa.array(rows, pa.string()), kept, fold)
        want = [_cut(t, kept, fold) for t in rows]
        assert words.counts.tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        keys = words.keys.tolist()
        assert len(set(keys)) == len(set(flat)) == len(set(zip(flat, keys, strict=True)))


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 4))
def test_windows_stay_in_rows(rows, n):
    words = Words(pa.array(rows, pa.string()), NOT_SPACE, False)
    at, keys = words.windows(n)
    want = [tuple(w[i : i + n]) for w in (_cut(t, NOT_SPACE, False) for t in rows) for i in range(len(w) - n + 1)]
    assert len(at) == len(want)
    assert len(set(keys.tolist())) == len(set(want)) == len(set(zip(want, keys.tolist(), strict=True)))


def test_pieces_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"i": list(range(6)), "text": ["a" * 10, None, "", "b" * 50, "c" * 3, "d" * 3]})
    found = list(pieces([batch], size=12))
    assert [r for p in found for r in p.column("i").to_pylist()] == list(range(6))
    assert max(sum(len(t or "") for t in p.column("text").to_pylist()) for p in found) == 50
    assert list(pieces([batch.slice(0, 0)])) == []


def test_pack():
    for kind in (np.uint64, np.int64, np.int32, np.uint8):
        values = np.array([0, 1, 255, 7], kind)
        assert (unpack(pack(values), kind) == values).all()
        assert len(unpack(pack(values[:0]), kind)) == 0

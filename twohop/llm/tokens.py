"""Token ids of many texts from a public tokenizer file, with a cache of words.

Most words of a corpus are repeats. Where the tokenizer splits a text into words first and treats each
alone, the words are cut out with the same pattern, and only words not seen before go to the tokenizer. The
short cut is taken for texts whose characters it is exact for (printable ASCII and Latin letters); others
go to the tokenizer whole. The cache belongs to the Python worker and is emptied at a fixed size.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from twohop.llm.idle import Kept

CACHED_CHARS = 6_000_000

#: The letters for which the short cut is exact, and the word patterns of the two public tokenizers.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_EXACT = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*")
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_LEVEL = re.compile(rf"{_ENDINGS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_WORD_ENDS = re.compile(rf"{_ENDINGS}|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_BYTE_LEVEL_STEPS = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORD_ENDS_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORD_ENDS_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class _Index(dict):
    """Word to number; a new word gets the next one and waits to be encoded."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """``encode(texts)``: all ids in one array, and the number of ids of each text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        self.special = [t["content"] for t in steps.get("added_tokens") or []]
        before, cut = steps.get("normalizer"), steps.get("pre_tokenizer") or {}
        self.pattern, self.lower, self.between = None, False, ""
        if before is None and cut == _BYTE_LEVEL_STEPS:
            self.pattern, self.between = _BYTE_LEVEL, "\n"
        elif (before or {}).get("normalizers") == _WORD_ENDS_STEPS:
            first = (cut.get("pretokenizers") or [{}])[0]
            if first.get("pattern") == {"Regex": _WORD_ENDS_PATTERN} and first.get("invert"):
                self.pattern, self.lower, self.between = _WORD_ENDS, True, "0"
        self._empty()

    def _empty(self) -> None:
        self.index, self.chars = _Index(), 0
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.index) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.sizes[numbers] = sizes
        self.used += len(ids)

    def _learn(self) -> None:
        new, self.index.new = self.index.new, []
        if not new:
            return
        self.chars += sum(map(len, new))
        numbers = np.arange(len(self.index) - len(new), len(self.index))
        # Words that stay apart beside the mark between them go to the tokenizer as one text, which is far cheaper.
        joined = np.array([bool(self.between) and w[0] != "\0" and not w.isspace() and not w.isdigit() for w in new])
        left = np.flatnonzero(~joined)
        for part in np.array_split(np.flatnonzero(joined), max(int(joined.sum()) // 4000, 1)):
            text = self.between.join([new[i] for i in part.tolist()])
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids if len(part) else [], np.uint32)
            marks = np.flatnonzero(ids == self._mark())
            if len(part) and len(marks) == len(part) - 1:
                sizes = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
                self._keep(numbers[part], np.delete(ids, marks), sizes)
            else:
                left = np.concatenate([left, part])
        texts = [new[i].removeprefix("\0") for i in left.tolist()]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self._keep(numbers[left], np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64))

    def _mark(self) -> int:
        ids = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        return ids[0] if len(ids) == 1 else -1

    def _words(self, text: str) -> list[str]:
        if self.pattern is None or not _EXACT.fullmatch(text) or any(t in text for t in self.special):
            return ["\0" + text]  # no word begins so
        return self.pattern.findall(text.lower() if self.lower else text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if self.chars > CACHED_CHARS:
            self._empty()
        words: list[str] = []
        ends = [0]
        for text in texts:
            words += self._words(text or "")
            ends.append(len(words))
        numbers = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        self._learn()
        starts, sizes = self.starts[numbers], self.sizes[numbers]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(starts - total[:-1], sizes)]
        return ids, np.diff(total[ends])


_encoder = Kept(Encoder)


def encode(path: str, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in one array, and the number of ids of each, by the tokenizer file at ``path``."""
    with _encoder.use(path) as own:
        return own.encode(texts)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1

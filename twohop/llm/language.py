"""Language ID by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton. A text is parsed into phrases, each the
longest match with something in the language's sample; the language that needs the fewest phrases per
symbol wins. The automata are made deterministic and total: where no longer match exists, the transition starts the
next phrase and says so. Runs of ``RUN`` symbols of all texts of a piece are parsed side by side.

Symbols are the bytes of letters, in lower case as far as ASCII and the Latin-1 letters go; everything else is one
separator, repeats of which count once.

Only the sample goes to the driver and the tasks: per language at most ``SAMPLE_DOCS`` texts with a letter, of each at most
``SAMPLE_TEXT`` bytes from its first letter on, in the order of a hash of their ids, and ``SAMPLE_BYTES`` bytes in all, fewer if there are many languages.

Defined results: null text and text without a letter is ``und`` with score 0; so is all text if nothing is labelled; ties
go to the smaller name; each row of ``docs`` gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twohop.llm.idle import Kept
from twohop.llm.tables import bound_batches, texts_of
from twohop.llm.words import pieces, text_buffer

SAMPLE_DOCS = 60
SAMPLE_TEXT = 8_000
SAMPLE_BYTES = 48_000
ALL_SAMPLES = 2_000_000
RUN = 256

_RESULT = "doc_id bigint, lang_pred string, score double"
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SYMBOL[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SYMBOL[0x80:] = np.arange(0x80, 0x100)


def symbols(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of texts, and the bounds of each text's."""
    found = _SYMBOL[data]
    if len(data):
        # The second byte of a Latin-1 capital, after 0xC3, lies 32 below that of the small letter.
        capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
        found[1:][capital] += 32
    keep = found > 0
    keep[1:] |= found[:-1] > 0
    ends = np.concatenate([[0], np.cumsum(keep)])
    return found[keep], ends[bounds]


def _suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``text``; state 0 is the empty one."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in text:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = moves[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                length.append(length[state] + 1)
                while state >= 0 and moves[state].get(symbol) == target:
                    moves[state][symbol] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return moves


class Parser:
    """A language's automaton as a table: next row of the table * 2, + 1 where a phrase begins."""

    def __init__(self, sample: bytes, names: np.ndarray, width: int):
        moves = _suffix_automaton(names[np.frombuffer(sample, np.uint8)].tolist())
        start = np.ones(width, np.int64)  # a symbol that the sample lacks is a phrase of its own and leads to the start
        for symbol, target in moves[0].items():
            start[symbol] = target * width * 2 + 1
        table = np.tile(start, len(moves)).astype(np.int32 if len(moves) * width < 1 << 30 else np.int64)
        states = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
        on = np.array([s for m in moves for s in m], np.int64)
        to = np.array([t for m in moves for t in m.values()], np.int64)
        table[states * width + on] = to * width * 2 + (states == 0)
        self.table = table

    def phrases(self, runs: np.ndarray, active: list[int]) -> np.ndarray:
        """Phrases of each run; ``runs``: a run per column, longest first, ``active`` of them at each step."""
        count = np.zeros(runs.shape[1], np.int32)
        state = np.zeros(runs.shape[1], self.table.dtype)
        for t, n in enumerate(active):
            move = self.table[state[:n] + runs[t, :n]]
            count[:n] += move & 1
            state[:n] = move >> 1
        return count


def _make_parsers(samples: tuple[tuple[str, bytes], ...]) -> tuple[list[str], np.ndarray, list[Parser]]:
    """One numbering of the symbols for all; those in no sample share a number."""
    seen = np.unique(np.frombuffer(b"".join(x for _, x in samples), np.uint8))
    names = np.full(256, len(seen), np.int64)
    names[seen] = np.arange(len(seen))
    parsers = [Parser(x, names, len(seen) + 1) for _, x in samples]
    return [lang for lang, _ in samples], names.astype(np.int32), parsers


_parsers = Kept(_make_parsers)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _judge(samples: tuple[tuple[str, bytes], ...], text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Predicted language and score of each text."""
    with _parsers.use(samples) as (langs, names, parsers):
        return _parse(langs, names, parsers, text)


def _parse(langs: list[str], names: np.ndarray, parsers: list[Parser], text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    known = np.array([*langs, "und"], object)
    data, bounds = text_buffer(text)
    found, ends = symbols(data, bounds)
    found = names[found]
    sizes = np.diff(ends)
    number = -(-sizes // RUN)
    row = np.repeat(np.arange(len(sizes)), number)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    start = ends[row] + nth * RUN
    length = np.minimum(RUN, ends[row + 1] - start)
    order = np.argsort(-length, kind="stable")
    row, start, length = row[order], start[order], length[order]
    active = [n for n in np.searchsorted(-length, -np.arange(RUN), "left").tolist() if n]
    padded = np.concatenate([found, np.zeros(RUN, found.dtype)])
    runs = padded[start[None, :] + np.arange(len(active))[:, None]] if len(row) else np.zeros((0, 0), np.int32)
    best, score = np.full(len(sizes), len(langs)), np.zeros(len(sizes))
    if parsers:
        counts = np.stack([np.bincount(row, p.phrases(runs, active), len(sizes)) for p in parsers])
        best = counts.argmin(axis=0)
        first, second = counts.min(axis=0), np.sort(counts, axis=0)[min(1, len(langs) - 1)]
        score = np.where(len(langs) > 1, second / np.maximum(first + second, 1), 1.0)
    # Letters are nearly always there: look at the characters only where ASCII has none.
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    total = np.concatenate([[0], np.cumsum(ascii_letter)])[bounds]
    for i in np.flatnonzero(np.diff(total) == 0):
        if not _has_letter(text[int(i)].as_py()):
            best[i], score[i] = len(langs), 0.0
    return known[best], score


def _predict(samples: tuple[tuple[str, bytes], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lang, score = _judge(samples, batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())}
            )

    return run


def _keep(samples: tuple[tuple[str, bytes], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lang, _ = _judge(samples, batch.column("text"))
            yield batch.filter(pa.array(lang != "und"))

    return run


def language_samples(labelled: DataFrame) -> tuple[tuple[str, bytes], ...]:
    """Symbols of some texts of each language of ``labelled(doc_id, text, lang)``."""
    texts = labelled.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    # A long text gives a slice, cut before texts are sorted; a text without a letter takes no other's place.
    start = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{SAMPLE_TEXT - 1}}}", 0)
    texts = texts.where(F.col("lang").isNotNull()).withColumn("text", F.substring(F.encode(start, "UTF-8"), 1, SAMPLE_TEXT))
    texts = texts.where(F.octet_length("text") > 0)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    some = texts.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_DOCS)
    by_lang: dict[str, list[str]] = {}
    for row in some.select("lang", "text").sort("lang", "nth").collect():
        by_lang.setdefault(row["lang"], []).append(bytes(row["text"]).decode(errors="ignore"))
    most = min(SAMPLE_BYTES, ALL_SAMPLES // max(len(by_lang), 1))
    found = []
    for lang, own in sorted(by_lang.items()):
        data, bounds = text_buffer(pa.array(own))
        found.append((lang, symbols(data, bounds)[0][:most].tobytes()))
    return tuple((lang, x) for lang, x in found if x)


def identify(docs: DataFrame, learn_from: Column) -> DataFrame:
    """``doc_id, lang_pred, score`` of all ``docs(doc_id, text, lang)``; ``learn_from``: rows whose ``lang`` may be used."""
    labelled = docs.where(learn_from).select("doc_id", "text", "lang")
    return texts_of(docs).mapInArrow(_predict(language_samples(labelled)), _RESULT)


def keep_identified(docs: DataFrame, learn_from: Column) -> DataFrame:
    """The rows of ``docs`` whose language can be told, with all their columns."""
    bound_batches(docs.sparkSession)
    samples = language_samples(docs.where(learn_from).select("doc_id", "text", "lang"))
    return docs.mapInArrow(_keep(samples), docs.schema)

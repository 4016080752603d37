"""Numbers that describe a text: what its words, lines and characters look like, whatever the language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from twohop.llm.words import NOT_SPACE, Words

NAMES = (
    "log_bytes log_words word_length word_length_spread upper_share digit_share mark_share sign_share bar_share shout_share "
    "capital_words signed_words letterless_words short_words wide_words distinct_share top_share repeated_next stop_rate line_words"
).split()


def _flags(chars: str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[[ord(c) for c in chars]] = 1
    return table


_UPPER, _LOWER, _DIGIT = (_flags(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_MARK = _flags(".,;:?'\"-()")
_SIGN = _flags("#$%&*+/<=>@[]^_`{}~\\")
_BAR, _SHOUT, _STOP, _LINE = _flags("|"), _flags("!"), _flags(".?!"), _flags("\n")
_WIDE = (np.arange(256) >= 0x80).astype(np.int64)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` per text; all zero for null and empty ones."""
    words = Words(column, NOT_SPACE, fold=True)
    data, bounds, n = words.data, words.bounds, words.n_rows
    size, count = np.diff(bounds), words.counts
    per_byte, per_word = np.maximum(size, 1), np.maximum(count, 1)

    def total(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])[bounds])

    def in_words(flag: np.ndarray) -> np.ndarray:
        return np.bincount(words.rows, flag, n)

    def of_words(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int32)])
        return sums[words.ends] - sums[words.starts]

    length = (words.ends - words.starts).astype(np.float64)
    mean = in_words(length) / per_word
    spread = np.sqrt(np.maximum(in_words(length * length) / per_word - mean * mean, 0))
    upper, lower = total(_UPPER), total(_LOWER)
    signs, letters = of_words(_SIGN + _BAR + _SHOUT), of_words(_UPPER + _LOWER + _WIDE)
    first = data[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    order = np.lexsort((words.keys, words.rows))
    keys, rows = words.keys[order], words.rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    heads = np.flatnonzero(new)
    runs = np.diff(np.append(heads, len(keys)))
    top = np.zeros(n)
    np.maximum.at(top, rows[heads], runs)
    again = np.zeros(len(words.keys), bool)
    again[1:] = (words.keys[1:] == words.keys[:-1]) & (words.rows[1:] == words.rows[:-1])
    found = np.stack(
        [
            np.log1p(size),
            np.log1p(count),
            np.minimum(mean, 40),
            np.minimum(spread, 40),
            upper / np.maximum(upper + lower, 1),
            total(_DIGIT) / per_byte,
            total(_MARK) / per_byte,
            total(_SIGN) / per_byte,
            total(_BAR) / per_byte,
            total(_SHOUT) / per_byte,
            in_words((first >= 65) & (first <= 90)) / per_word,
            in_words(signs > 0) / per_word,
            in_words(letters == 0) / per_word,
            in_words(length <= 3) / per_word,
            in_words(of_words(_WIDE) > 0) / per_word,
            np.bincount(rows[heads], minlength=n) / per_word,
            top / per_word,
            in_words(again) / per_word,
            total(_STOP) / per_word,
            np.log1p(count / (1 + total(_LINE))),
        ],
        axis=1,
    )
    found[count == 0] = 0
    return found

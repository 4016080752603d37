"""Substring dedup: words of windows that occur earlier in the corpus are removed.

Method: Rabin-Karp keys of every window of ``size`` words. Documents are dealt into groups by their id; a
group finds its repeated windows itself and sends one entry (key, smallest doc_id) per distinct window
to the bucket of the key. A bucket decides which groups saw a window first and answers with one bit per
entry. Repeated windows of a document merge into maximal intervals.

The texts are shuffled once: both uses of the groups share the exchange. A window that is in every
document is one entry per group. Keys have 64 bits: two of N windows collide with chance N^2 / 2^65.

Defined results: null or blank text has no words; a row without ``doc_id`` is not judged, nor judges; rows
with the same ``doc_id`` stand in the order of their texts, equal rows being one; all rows are returned.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twohop.llm.blocks import pack, unpack
from twohop.llm.tables import parts, texts_of, total_bytes
from twohop.llm.words import NOT_SPACE, Words

GROUP_BYTES = 4 << 20
BUCKET_WORDS = 2_000_000

_ENTRIES = "bucket bigint, part bigint, keys binary, docs binary"
_ANSWERS = "part bigint, bucket bigint, later binary"
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept string, intervals array<struct<start:bigint,length:bigint>>"


class _Group:
    """The windows of a group of documents, the same each time the group is built."""

    def __init__(self, table: pa.Table, size: int, buckets: int):
        keys = [("judged", "descending"), ("doc_id", "ascending"), ("text", "ascending")]
        judged = pc.is_valid(table["doc_id"])
        table = table.append_column("judged", judged)
        self.table = table.take(pc.sort_indices(table, sort_keys=keys)).combine_chunks()
        self.ids = pc.fill_null(self.table["doc_id"], 0).to_numpy()
        judged = self.table["judged"].to_numpy(zero_copy_only=False)
        self.words = Words(self.table["text"], NOT_SPACE, fold=False)
        at, hashes = self.words.windows(size)
        own = judged[self.words.rows[at]]
        self.at, self.hashes = at[own], hashes[own]
        # Rows stand in the order of their ids, so the first window of a key is the one that starts earliest.
        self.order = np.argsort(self.hashes, kind="stable")
        ranked = self.hashes[self.order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        self.heads = np.flatnonzero(new)
        self.keys = ranked[self.heads]
        self.docs = self.ids[self.words.rows[self.at[self.order[self.heads]]]]
        edges = [(b << 64) // buckets for b in range(1, buckets)]
        self.cuts = np.concatenate([[0], np.searchsorted(self.keys, np.array(edges, np.uint64)), [len(self.keys)]]).astype(np.int64)

    def repeats(self, later: np.ndarray) -> np.ndarray:
        """First words of the windows that occur earlier; ``later``: the keys that an earlier group has too."""
        gone = np.ones(len(self.order), bool)
        gone[self.heads] = later
        at = self.at[self.order]
        rows = self.words.rows[at]
        # Equal rows are one document: what the first of them keeps, the others keep too.
        again = np.flatnonzero(self._again())
        if len(again):
            kept = ~np.isin(rows, again)
            marks = [at[gone & kept]]
            for row in again:  # in order, so the row before it is done
                before, n = self.words.first[row - 1], self.words.counts[row]
                done = np.concatenate(marks)
                marks.append(done[(done >= before) & (done < before + n)] - before + self.words.first[row])
            return np.concatenate(marks)
        return at[gone]

    def _again(self) -> np.ndarray:
        same = np.zeros(self.table.num_rows, bool)
        if self.table.num_rows > 1:
            ids = (self.ids[1:] == self.ids[:-1]) & self.table["judged"].to_numpy(zero_copy_only=False)[1:]
            for row in np.flatnonzero(ids) + 1:
                same[row] = self.table["text"][int(row)] == self.table["text"][int(row) - 1]
        return same


def _send(size: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        group = _Group(table, size, buckets)
        part = table["part"][0].as_py()
        rows = []
        for b in np.flatnonzero(np.diff(group.cuts)):
            lo, hi = group.cuts[b], group.cuts[b + 1]
            keys = group.keys[lo:hi]
            rows.append((int(b), part, pack(np.diff(keys, prepend=np.uint64(0))), pack(group.docs[lo:hi])))
        names = ["bucket", "part", "keys", "docs"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})

    return run


def _judge(table: pa.Table) -> pa.Table:
    """One bit per entry of each group: does a document with a smaller id, in another group, have the window?"""
    keys = [np.cumsum(unpack(x.as_buffer(), np.uint64)) for x in table["keys"]]
    docs = [unpack(x.as_buffer(), np.int64) for x in table["docs"]]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    del every, keys
    heads = np.flatnonzero(new)
    owner = np.concatenate(docs)[order]
    least = np.repeat(np.minimum.reduceat(owner, heads), np.diff(np.append(heads, len(ranked))))
    later = np.empty(len(ranked), bool)
    later[order] = owner > least
    cuts = np.cumsum([len(x) for x in docs])[:-1]
    bits = [np.packbits(x).tobytes() for x in np.split(later, cuts)]
    return pa.table({"part": table["part"], "bucket": table["bucket"], "later": pa.array(bits, pa.binary())})


def _cut(size: int, buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _Group(table, size, buckets)
        later = np.zeros(len(group.keys), bool)
        for b, bits in zip(answers["bucket"].to_pylist(), answers["later"], strict=True):
            lo, hi = group.cuts[b], group.cuts[b + 1]
            later[lo:hi] = np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), count=hi - lo).astype(bool)
        words = group.words
        starts, length = group.repeats(later), len(words.keys) + size
        change = np.bincount(starts, minlength=length) - np.bincount(starts + size, minlength=length)
        gone = np.cumsum(change)[: len(words.keys)] > 0
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) if len(words.first) > 1 else np.zeros(0)
        removed = np.where(words.counts > 0, removed, 0)
        data = words.data.tobytes()
        kept, intervals = [], []
        for row in range(words.n_rows):
            lo, hi = words.first[row], words.first[row + 1]
            own = data[words.bounds[row] : words.bounds[row + 1]].split()
            if removed[row]:
                own = compress(own, (~gone[lo:hi]).tolist())
            kept.append(b" ".join(own))
            if removed[row]:
                edge = np.flatnonzero(np.diff(gone[lo:hi].astype(np.int8), prepend=0, append=0))
                intervals.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            else:
                intervals.append([])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        return pa.table(
            {
                "doc_id": group.table["doc_id"],
                "n_words": pa.array(words.counts.astype(np.int64)),
                "n_removed": pa.array(removed.astype(np.int64)),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "intervals": pa.array(intervals, kind),
            }
        )

    return run


def remove_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, intervals`` of every document; ``kept``: the words left, joined by blanks."""
    texts = texts_of(docs)
    amount = total_bytes(texts)
    groups = parts(amount, GROUP_BYTES)
    buckets = parts(amount // 6, BUCKET_WORDS)
    own = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = texts.withColumn("part", F.pmod(own, F.lit(groups)).cast("bigint"))
    entries = dealt.groupBy("part").applyInArrow(_send(size, buckets), _ENTRIES)
    answers = entries.groupBy("bucket").applyInArrow(_judge, _ANSWERS)
    return dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_cut(size, buckets), _RESULT)


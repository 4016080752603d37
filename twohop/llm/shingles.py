"""N-gram Jaccard join with token-combination prefixes.

A document is its set of distinct runs of ``size`` words (``SHINGLE`` unless given), the tokens. Two documents link when their sets'
Jaccard similarity reaches ``percent`` (``PERCENT`` unless given; 50 to 100). Equal sets are one class from the start. Then:

1. Count, in how many classes each token occurs. Documents are dealt into groups by id; a group sends a short form of its distinct tokens to
   buckets and gets back a class of frequency for each: unique, rare (up to ``RARE`` documents) or frequent.
2. Sort each set by (frequency class, token) and take a prefix. A prefix that partners must share a token of is as long as the
   number of tokens they may lack, plus one. Rare tokens are indexed singly. Frequent ones are dealt into subclasses and indexed as
   pairs within a subclass; a subclass with one shared token is missed, so the prefix is extended by one token per subclass.
   Unique tokens have no partner and are not indexed. Prefixes of frequent tokens belong to a band of sizes, and a document
   is indexed for its own band and the next, so partners always meet under the same number of subclasses.
3. Candidates share an index entry. Of every entry the first document is compared with the others, which joins most groups of copies at
   the cost of a comparison per member. Entries that still hold several components are compared in blocks: documents of different
   components, two blocks at a time as matrices, so no link is lost and no pair is listed.
4. Comparisons are made on whole texts.

The texts are shuffled once to be counted and indexed (both uses share the exchange); only documents with an index entry go on.

Tokens are 64-bit keys; the short form in step 1 only decides the class, the same for all who hold a token.

Defined results: null or blank text has an empty set and links with nothing; fewer words than ``size`` are one token; a row without ``doc_id``
links with nothing; rows with the same ``doc_id`` are one document with several texts, linked if one of them is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twohop.llm.blocks import pack, unpack
from twohop.llm.components import components
from twohop.llm.tables import parts, texts_of, total_bytes
from twohop.llm.words import NOT_SPACE, Words, mix, pieces
from twohop.operators.nodes import attach
from twohop.store import write_out

SHINGLE = 4
PERCENT = 85
RARE = 32
GROUP_BYTES = 4 << 20
BUCKET_TOKENS = 2_000_000
#: What a block of documents that are compared with each other holds at most, about.
BLOCK_TOKENS, BLOCK_DOCS = 150_000, 2_000
_SINGLE = 12  # sets so small are indexed by single tokens of all classes only, their larger partners by single tokens as well


class Sets:
    """The distinct tokens of each text, by row, ascending."""

    def __init__(self, column: pa.Array, size: int):
        words = Words(column, NOT_SPACE, fold=True)
        at, keys = words.windows(size)
        rows = words.rows[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < size))
        if len(short):
            rows, keys = np.concatenate([rows, short]), np.concatenate([keys, words.whole()[short]])
        order = np.lexsort((keys, rows))
        rows, keys = rows[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
        self.rows, self.keys = rows[new], keys[new]
        self.n_rows = words.n_rows
        self.counts = np.bincount(self.rows, minlength=words.n_rows)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def digest(self, salt: int) -> np.ndarray:
        """A key of each set, whatever the order of its tokens."""
        sums = np.zeros(len(self.keys) + 1, np.uint64)
        np.cumsum(mix(self.keys ^ np.uint64(salt)), out=sums[1:])
        return (sums[self.first[1:]] - sums[self.first[:-1]]).view(np.int64)


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = Sets(piece.column("text"), size)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id"),
                    "n": pa.array(sets.counts.astype(np.int64)),
                    "k1": pa.array(sets.digest(0x5BD1E995)),
                    "k2": pa.array(sets.digest(0x27D4EB2F165667C5)),
                }
            )

    return run


def most_missing(n: np.ndarray | int, percent: int = PERCENT) -> np.ndarray | int:
    """How many tokens of a set of ``n`` a partner may lack."""
    return n - (percent * n + 99) // 100


class _Group:
    """The sets of the class representatives of one group of documents, and the short forms of their tokens."""

    def __init__(self, docs: pa.Table, ids: np.ndarray, size: int, bits: int, buckets: int):
        chosen = np.isin(docs["doc_id"].to_numpy(), ids)
        self.docs = docs.filter(pa.array(chosen)).combine_chunks()
        self.sets = Sets(self.docs["text"], size)
        short = self.sets.keys >> np.uint64(64 - bits)
        self.short, self.back, counts = np.unique(short, return_inverse=True, return_counts=True)
        self.counts = np.minimum(counts, 255).astype(np.uint8)
        edges = np.array([(b << bits) // buckets for b in range(1, buckets)], np.uint64)
        self.cuts = np.concatenate([[0], np.searchsorted(self.short, edges), [len(self.short)]]).astype(np.int64)


def _ids_of(info: pa.Table) -> np.ndarray:
    ids = info["ids"].combine_chunks()
    return ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _send(size: int, bits: int, buckets: int):
    def run(docs: pa.Table, info: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            group = _Group(docs, _ids_of(info), size, bits, buckets)
            part = docs["part"][0].as_py()
            for b in np.flatnonzero(np.diff(group.cuts)):
                lo, hi = group.cuts[b], group.cuts[b + 1]
                rows.append((int(b), part, pack(np.diff(group.short[lo:hi], prepend=np.uint64(0))), group.counts[lo:hi].tobytes()))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = ["bucket", "part", "keys", "counts"]
        return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})

    return run


def _classify(rare: int):
    def run(table: pa.Table) -> pa.Table:
        """The frequency class of every token sent: 0 unique, 1 rare, 2 frequent."""
        keys = [np.cumsum(unpack(x.as_buffer(), np.uint64)) for x in table["keys"]]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table["counts"]])
        cuts = np.cumsum([len(x) for x in keys])[:-1]
        _, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, counts)[back]
        codes = ((total > 1).astype(np.uint8) + (total > rare)).astype(np.uint8)
        return pa.table(
            {
                "part": table["part"],
                "bucket": table["bucket"],
                "codes": pa.array([x.tobytes() for x in np.split(codes, cuts)], pa.binary()),
                "ids": pa.nulls(table.num_rows, pa.list_(pa.int64())),
            }
        )

    return run


def band(n: int, percent: int = PERCENT) -> int:
    """Sets that can link have the same band or neighbouring ones."""
    return int(math.log(n) / -math.log(percent / 100 - 0.001))


def _subclasses(band_no: int, percent: int) -> int:
    smallest = int((1 / (percent / 100 - 0.001)) ** band_no)
    return max(1, most_missing(smallest, percent) // 3)


def signatures(unique: int, rare: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Index entries of a set with so many unique tokens and these others, each ascending."""
    n = unique + len(rare) + len(frequent)
    need = int(most_missing(n, percent)) + 1
    if unique >= need:
        return np.zeros(0, np.uint64)
    found = [rare[: need - unique]]
    need -= unique + len(rare)
    if need > 0 and n - most_missing(n, percent) <= _SINGLE:
        found.append(frequent)
    if need > 0 and n > _SINGLE:
        for tag in (band(n, percent), band(n, percent) + 1):
            sub = frequent % np.uint64(_subclasses(tag, percent))
            head = np.zeros(len(frequent), bool)
            head[np.unique(sub, return_index=True)[1]] = True
            end = int(np.searchsorted(np.cumsum(~head), need)) + 1
            order = np.argsort(sub[:end], kind="stable")
            keys, sub = frequent[:end][order], sub[:end][order]
            for step in range(1, end):
                same = sub[step:] == sub[:-step]
                if not same.any():
                    break
                found.append(mix(mix(keys[:-step][same] + np.uint64(tag + 1)) ^ keys[step:][same]))
    return np.concatenate(found)


_ACTIVE = "doc_id bigint, n bigint, text string, entries array<bigint>"


def _index(size: int, percent: int, bits: int, buckets: int):
    def run(docs: pa.Table, info: pa.Table) -> pa.Table:
        ids, ns, texts, entries = [], [], [], []
        if docs.num_rows:
            group = _Group(docs, _ids_of(info), size, bits, buckets)
            codes = np.zeros(len(group.short), np.uint8)
            answers = info.filter(pa.array(np.asarray(info["codes"].is_valid())))
            for b, code in zip(answers["bucket"].to_pylist(), answers["codes"], strict=True):
                codes[group.cuts[b] : group.cuts[b + 1]] = np.frombuffer(code.as_buffer(), np.uint8)
            sets = group.sets
            code = codes[group.back]
            own_ids, own_texts = group.docs["doc_id"].to_numpy(), group.docs["text"]
            unique = np.bincount(sets.rows[code == 0], minlength=sets.n_rows)
            # A set too small for a partner of another size can link with equal ones only, which are one class.
            pairs_up = 100 * sets.counts >= percent * (sets.counts + 1)
            for row in np.flatnonzero((sets.counts > 0) & pairs_up & (unique <= most_missing(sets.counts, percent))):
                lo, hi = sets.first[row], sets.first[row + 1]
                keys, kind = sets.keys[lo:hi], code[lo:hi]
                found = signatures(int(unique[row]), keys[kind == 1], keys[kind == 2], percent)
                if len(found):
                    ids.append(int(own_ids[row]))
                    ns.append(hi - lo)
                    texts.append(own_texts[int(row)].as_py())
                    entries.append(np.unique(found).view(np.int64))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in entries])]).astype(np.int32)
        flat = np.concatenate(entries) if entries else np.zeros(0, np.int64)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n": pa.array(ns, pa.int64()),
                "text": pa.array(texts, pa.string()),
                "entries": pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
            }
        )

    return run


def _verify(size: int, percent: int):
    """The pairs of texts that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            for piece in pieces([whole], "text_a", 1 << 20):
                part = whole.slice(at, piece.num_rows)
                at += piece.num_rows
                a, b = Sets(part.column("text_a"), size), Sets(part.column("text_b"), size)
                rows, keys = np.concatenate([a.rows, b.rows]), np.concatenate([a.keys, b.keys])
                order = np.lexsort((keys, rows))
                rows, keys = rows[order], keys[order]
                shared = np.bincount(rows[1:][(keys[1:] == keys[:-1]) & (rows[1:] == rows[:-1])], minlength=part.num_rows)
                linked = (shared > 0) & (100 * shared >= percent * (a.counts + b.counts - shared))
                yield part.select(["a", "b"]).filter(pa.array(linked))

    return run


def _shared(a: Sets, b: Sets, columns: int = 1024, strip: int = 512) -> Iterator[tuple[int, np.ndarray]]:
    """How many tokens every set of ``a`` shares with every set of ``b``, by strips of sets of ``a`` with the first one's number."""
    keys = np.intersect1d(a.keys, b.keys)
    places = [np.searchsorted(keys, x.keys) for x in (a, b)]
    held = [np.append(keys, 0)[p] == x.keys for p, x in zip(places, (a, b), strict=True)]

    def side(n: int, first: int, low: int, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        own = (place >= low) & (place < low + columns)
        out = np.zeros((n, min(columns, len(keys) - low)), np.float32)
        out[rows[own] - first, place[own] - low] = 1
        return out

    for first in range(0, a.n_rows, strip):
        n = min(strip, a.n_rows - first)
        lo, hi = a.first[first], a.first[first + n]
        rows, place = a.rows[lo:hi][held[0][lo:hi]], places[0][lo:hi][held[0][lo:hi]]
        found = np.zeros((n, b.n_rows), np.float32)
        for low in np.unique(place // columns) * columns:  # only keys that the strip has
            found += side(n, first, low, rows, place) @ side(b.n_rows, 0, low, b.rows[held[1]], places[1][held[1]]).T
        yield first, found.astype(np.int32)


def _compare_blocks(size: int, percent: int):
    """Links between documents of different components in two blocks: enough of them to join what is joined."""

    def run(table: pa.Table) -> pa.Table:
        second = table["second"].to_numpy(zero_copy_only=False)
        alone = table["b1"][0].as_py() == table["b2"][0].as_py()
        sides = [table.filter(pa.array(~second)), table if alone else table.filter(pa.array(second))]
        if not all(s.num_rows for s in sides):
            return table.select(["doc_id", "doc_id"]).slice(0, 0).rename_columns(["a", "b"])
        sets = [Sets(s["text"], size) for s in sides]
        ids = [s["doc_id"].to_numpy() for s in sides]
        component = [s["component"].to_numpy() for s in sides]
        sizes = [x.counts.astype(np.int32) for x in sets]
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        found = []
        for first, shared in _shared(*sets):
            own = slice(first, first + len(shared))
            # 100 shared >= percent (both - shared), with each side below 2^31 for sets of up to ten million tokens.
            linked = (shared > 0) & ((100 + percent) * shared >= percent * (sizes[0][own, None] + sizes[1][None, :]))
            linked &= component[0][own, None] != component[1][None, :]
            for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
                x, y = top(int(component[0][first + i])), top(int(component[1][j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((int(ids[0][first + i]), int(ids[1][j])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _star_links(active: DataFrame, entries: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the first document of every entry and the others."""
    centres = entries.groupBy("entry").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("held")).where("held > 1")
    # Hot entries are split, here and below: attach() and written tables leave both sides of a join straight from a shuffle.
    met = attach(entries, "entry", centres.withColumnRenamed("entry", "node"), {"a": "a"}).where("doc_id > a")
    pairs = write_out(met.select("a", F.col("doc_id").alias("b")).distinct(), "pairs")
    texts = active.select("doc_id", "text")
    rows = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")
    return write_out(rows.mapInArrow(_verify(size, percent), "a bigint, b bigint").distinct(), "similar")


def _block_links(active: DataFrame, entries: DataFrame, links: DataFrame, size: int, percent: int) -> DataFrame:
    """Links that the stars have missed: between documents of different components that share an entry.

    Documents are put into blocks of about ``BLOCK_TOKENS`` tokens or ``BLOCK_DOCS`` documents by the largest of their open entries, large components apart. Blocks
    whose documents share an entry are compared as matrices, unless they hold one and the same component; no pair is listed.
    """
    labels = components(links, "a", "b").toDF("doc_id", "component")
    now = entries.join(labels, "doc_id", "left").select("doc_id", "n", "entry", F.coalesce("component", "doc_id").alias("component"))
    held = now.groupBy("entry").agg(F.count(F.lit(1)).alias("held"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = held.where("lo < hi").select("entry", "held")
    opened = attach(now, "entry", mixed.withColumnRenamed("entry", "node"), {"held": "held"}).where("held is not null")
    opened = write_out(opened, "open")
    most = F.max(F.struct("held", "entry"))["entry"].alias("home")
    homes = opened.groupBy("doc_id").agg(most, F.max("n").alias("n"), F.min("component").alias("component"))
    # A document's part of a block: by its tokens, or as one of so many documents, whichever is more.
    weight = F.greatest(F.col("n") / BLOCK_TOKENS, F.lit(1 / BLOCK_DOCS))
    by_component = homes.groupBy("home", "component").agg(F.ceil(F.sum(weight)).alias("own_blocks"), F.sum(weight).alias("own_part"))
    by_component = write_out(by_component, "block-components")
    small = F.sum(F.when(F.col("own_blocks") == 1, F.col("own_part")).otherwise(0.0))
    by_home = write_out(by_component.groupBy("home").agg(F.greatest(F.ceil(small), F.lit(1)).alias("shared_blocks")), "block-homes")
    place = F.when(
        F.col("own_blocks") > 1, F.xxhash64("home", "component", F.pmod(F.xxhash64("doc_id"), F.col("own_blocks")))
    ).otherwise(F.xxhash64("home", F.lit("shared"), F.pmod(F.xxhash64("component"), F.col("shared_blocks"))))
    blocks = write_out(
        homes.join(by_component, ["home", "component"]).join(by_home, "home").select("doc_id", "component", place.alias("block")), "blocks"
    )
    holds = blocks.groupBy("block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    at = opened.select("doc_id", "entry").join(blocks.select("doc_id", "block"), "doc_id").select("entry", "block").distinct()
    at = write_out(at.join(holds, "block").select("entry", "block", "lo", "hi"), "entry-blocks")
    left, right = at.toDF("entry", "b1", "lo1", "hi1"), at.toDF("entry", "b2", "lo2", "hi2")
    differ = F.expr("b1 <= b2 and not (lo1 = hi1 and lo2 = hi2 and lo1 = lo2)")
    met = write_out(left.join(right, "entry").where(differ).select("b1", "b2").distinct(), "block-pairs")
    texts = blocks.join(active.select("doc_id", "text"), "doc_id")
    first = met.join(texts.withColumnRenamed("block", "b1"), "b1").withColumn("second", F.lit(False))
    other = met.where("b1 < b2").join(texts.withColumnRenamed("block", "b2"), "b2").withColumn("second", F.lit(True))
    dealt = first.select("b1", "b2", "doc_id", "component", "text", "second").unionByName(other)
    return write_out(dealt.groupBy("b1", "b2").applyInArrow(_compare_blocks(size, percent), "a bigint, b bigint"), "block-links")


def _links(active: DataFrame, size: int, percent: int) -> DataFrame:
    entries = active.select("doc_id", "n", F.explode("entries").alias("entry"))
    stars = _star_links(active, entries, size, percent)
    return stars.union(_block_links(active, entries, stars, size, percent))


def similar_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: ``doc_id, n`` and class ``rep`` of every document with a set; the sizes of all rows; links ``a, b`` between
    classes, enough of them to connect what is connected."""
    if not 50 <= percent <= 100:  # below, similar sets may share fewer tokens than there are subclasses
        raise ValueError(f"percent must be from 50 to 100, not {percent}")
    texts = texts_of(docs)
    sets = write_out(texts.mapInArrow(_digests(size), "doc_id bigint, n bigint, k1 bigint, k2 bigint"), "sets")
    held = sets.where("n > 0 and doc_id is not null")
    classes = write_out(held.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep")), "representatives")
    members = write_out(held.join(classes, ["n", "k1", "k2"]).select("doc_id", "n", "rep"), "classes")

    amount = total_bytes(texts)
    groups, buckets = parts(amount, GROUP_BYTES), parts(amount // 6, BUCKET_TOKENS)
    bits = min(max(int(math.log2(amount // 6 + 2)) + 13, 24), 64)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("bigint").alias("part")
    dealt = texts.where("doc_id is not null").select("doc_id", "text", part)
    reps = members.select(F.col("rep").alias("doc_id")).distinct().select("doc_id", part).groupBy("part").agg(F.collect_list("doc_id").alias("ids"))
    info = "part bigint, bucket bigint, codes binary, ids array<bigint>"
    listed = reps.select("part", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("codes"), "ids")
    sent = dealt.groupBy("part").cogroup(listed.groupBy("part")).applyInArrow(
        _send(size, bits, buckets), "bucket bigint, part bigint, keys binary, counts binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(_classify(RARE), info)
    known = listed.union(answers)
    active = dealt.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(_index(size, percent, bits, buckets), _ACTIVE)
    return members, sets.select("doc_id", "n"), _links(write_out(active, "indexed"), size, percent)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    members, sizes, links = similar_documents(docs, size, percent)
    ends = members.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    joined = components(ends.union(links), "a", "b").withColumnRenamed("node", "doc_id")
    return sizes.join(joined, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )

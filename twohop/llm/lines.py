"""Line dedup: lines found in many documents stay only in the last of them.

Lines are exploded, normalised and hashed; distinct documents are counted per hash; the lines of frequent
hashes are dropped; what is left is put together by position. The hashes of long enough lines are written out, so the
texts are read for them once; so are the frequent ones, so that a hot hash can be split where the two meet; the texts are shuffled once, to meet their dropped positions. Counting first makes
(hash, document) distinct, which spreads a line that is everywhere over all tasks, then adds up before the
second shuffle.

Hashes have 128 bits, so that different lines do not meet.

Defined results: null or empty text is one empty line; a row without ``doc_id`` keeps all its lines and is not counted;
rows with the same ``doc_id`` count as one document, and each is returned without its own dropped lines. For that, lines carry a
key of their text beside ``doc_id``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twohop.llm.tables import texts_of
from twohop.llm.words import pieces
from twohop.store import write_out

#: The blanks stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: str) -> str:
    """The line without blanks at its ends, A-Z as a-z."""
    return line.strip(BLANKS).encode().lower().decode()


def _hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows, places, digests = [], [], []
            for row, text in enumerate(piece.column("text").to_pylist()):
                for place, line in enumerate((text or "").split("\n")):
                    if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
                        rows.append(row)
                        places.append(place)
                        digests.append(hashlib.blake2b(key.encode(), digest_size=16).digest())
            hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id").take(pa.array(rows, pa.int64())),
                    "text_key": piece.column("text_key").take(pa.array(rows, pa.int64())),
                    "pos": pa.array(places, pa.int32()),
                    "h1": pa.array(hashes[:, 0]),
                    "h2": pa.array(hashes[:, 1]),
                }
            )

    return run


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        texts, n_lines, n_dropped = [], [], []
        for text, gone in zip(piece.column("text").to_pylist(), piece.column("gone").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            out = set(gone or ())
            kept = [x for i, x in enumerate(lines) if i not in out] if out else lines
            texts.append("\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": piece.column("doc_id"),
                "text": pa.array(texts, pa.string()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
                "others": piece.column("others"),
            }
        )


def drop_frequent_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every document, and its other columns as the struct ``others``."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("others")
    texts = texts_of(docs, others).withColumn("text_key", F.xxhash64("text"))
    judged = texts.where("doc_id is not null").select("doc_id", "text", "text_key")
    lines = write_out(judged.mapInArrow(_hashes(min_chars), "doc_id bigint, text_key bigint, pos int, h1 bigint, h2 bigint"), "lines")
    frequent = write_out(
        lines.groupBy("h1", "h2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "keeper"),
        "frequent-lines",
    )
    dropped = (
        lines.join(frequent, ["h1", "h2"])
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("gone"))
    )
    joined = texts.join(dropped, ["doc_id", "text_key"], "left").select("doc_id", "text", "gone", "others")
    long = T.LongType()
    schema = T.StructType([joined.schema["doc_id"], joined.schema["text"], T.StructField("n_lines", long), T.StructField("n_dropped", long), joined.schema["others"]])
    return joined.mapInArrow(_reassemble, schema)

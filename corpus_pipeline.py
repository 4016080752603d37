"""From raw documents to packed training sequences, stage by stage.

A stage is a function (spark, docs, sf_dir) -> DataFrame on what its predecessor kept. All but the last return the columns
of ``documents``: language ID rejects texts without a language, line dedup drops frequent lines, the Jaccard join keeps the
document with the smallest id of each group of near copies, decontamination drops documents that hold a benchmark passage,
packing puts what is left into sequences.

Each stage's result is written to the shared folder and read again by the next, so a lost executor costs only its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twohop.llm import decontaminate, language, lines, packing, shingles
from twohop.llm.queries import BYTE_TOKENS, learnt_languages, tokenizer_path
from twohop.store import write_out

#: Near copies: runs of five words, similarity of 0.8 or more. The query op5 has a rule of its own.
COPY_WORDS, COPY_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, learnt_languages())


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.drop_frequent_lines(docs)
    own = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return kept.select(*[own.get(c, F.col(f"others.`{c}`")).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without ``doc_id`` stay; rows with the same ``doc_id`` stay or go together."""
    found = shingles.near_duplicates(docs, COPY_WORDS, COPY_PERCENT).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without ``doc_id`` stay; rows with the same ``doc_id`` stay or go together."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, items).where("n_hit > 0").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(BYTE_TOKENS), end_id=2)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]

#: Tokenisation has no SQL form; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = write_out(docs, name)
    return docs

"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twohop.llm import (
    alignment,
    decontaminate,
    embeddings,
    language,
    licenses,
    lines,
    packing,
    quality,
    range_coder,
    runs,
    shingles,
    substring,
    toxicity,
)


#: Names of the public tokenizer files.
WORD_TOKENS, BYTE_TOKENS, PIECE_TOKENS = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: Column | str) -> Column:
    return F.sha2(text, 256)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        _sha256(F.concat_ws(",", "item_ids")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _remainder(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labels whose crc32(doc_id) modulo 5 is not 0; ``toxic`` from a probability of 0.5."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = toxicity.score_toxicity(docs, labels, _remainder(5) != 0)
    return found.select(
        "doc_id",
        (_remainder(5) == 0).alias("held_out"),
        F.col("toxic").alias("score"),
        (F.col("toxic") >= 0.5).cast("int").alias("predicted"),
        (F.col("toxic") >= 0.5).alias("toxic"),
        F.col("low_quality").alias("p_low_quality"),
        F.col("toxic_low_quality").alias("p_toxic_low_quality"),
    )


def op3_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return range_coder.read_ids(range_coder.write_ids(docs, tokenizer_path(WORD_TOKENS), end_id=1))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_frequent_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENS), end_id=2)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", _sha256("kept").alias("kept_sha256"))


def learnt_languages() -> Column:
    """The documents whose ``lang`` is learnt from."""
    return _remainder(4) != 2


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(_table(spark, sf_dir, "documents"), learnt_languages())
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string")) / 5), F.lit(quality.FOLDS))
    found = quality.score_quality(docs, labels, _remainder(5) != 0, fold)
    return found.select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return alignment.align_tokenizers(docs, tokenizer_path(BYTE_TOKENS), tokenizer_path(PIECE_TOKENS))


def _with_loops(docs: DataFrame) -> DataFrame:
    """Documents whose crc32(doc_id) is divisible by 10 repeat a block of their words from some word on to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("bigint")
    own = F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")).alias("own")
    split = docs.select("doc_id", "text", own, g.alias("g")).withColumn("n", F.size("own"))
    a = F.col("g") % F.greatest(F.col("n"), F.lit(1))
    rest = F.col("n") - a
    looped = split.withColumns({"a": a.cast("int"), "p": (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int")})
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    block = F.flatten(F.array_repeat(F.slice("own", F.col("a") + 1, F.col("p")), times))
    changed = F.concat(F.slice("own", F.lit(1), F.col("a")), F.slice(block, F.lit(1), F.col("n") - F.col("a")))
    return looped.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op12_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(_with_loops(_table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("a"), (-r["period"]).alias("b")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]), F.lit("\n")))
    best = found.select("doc_id", "n_words", "kept", F.array_max(ranked).alias("top"), F.array_join(lines, "").alias("lines"), F.size("runs").alias("n_runs"))
    length, period = F.col("top.length"), -F.col("top.b")
    return best.select(
        "doc_id",
        "n_words",
        F.col("n_runs").cast("bigint").alias("n_runs"),
        (-F.col("top.a")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(1000 * top.length) div (-top.b)").alias("exponent_milli"),
        _sha256("lines").alias("runs_sha256"),
        _sha256("kept").alias("collapsed_sha256"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    base, labels = F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels")
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", base, labels, "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_toxicity": op2_toxicity,
    "op3_range_coder": op3_range_coder,
    "op4_line_dedup": op4_line_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_pack": op6_pack,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_token_alignment": op11_token_alignment,
    "op12_run_detection": op12_run_detection,
    "op13_license_scan": op13_license_scan,
}

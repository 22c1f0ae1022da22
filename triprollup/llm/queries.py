"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triprollup.llm import (
    decontaminate,
    feistel,
    host_rules,
    jaccard_forest,
    language_id,
    line_dedup,
    lm_scoring,
    matrices,
    packing,
    periodic,
    pieces,
    spelling,
    suffix_dedup,
)
from triprollup.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.col("text").cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = feistel.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup_strings(docs, keep_first=False).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("data", 256).alias("kept_sha256"),
        "n_repeated",
        "longest_repeat",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs), keep=["doc_id"])
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrices.pack_matrices(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.tokenized(table(spark, sf_dir, "documents"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), plant=True)
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_line_dedup,
        op2_decontamination,
        op3_sharding,
        op4_suffix_dedup,
        op5_jaccard_join,
        op6_lm_scoring,
        op7_best_fit_packing,
        op8_host_rules,
        op9_language_id,
        op10_token_matrices,
        op11_spelling_variants,
        op12_sentence_pieces,
        op13_periodic_runs,
    )
}

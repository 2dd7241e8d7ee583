"""Registered queries of the package: each operator over its whole table, as digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postweave.llm import (
    decontaminate,
    line_rules,
    mixing,
    odd_sketch,
    phrases,
    pitman_yor,
    quality,
    sharding,
    spelling,
    token_files,
    toxic_spans,
    transcripts,
    warc,
)

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.tokenized(table(spark, folder, "documents"), tokenizer_path())


def op2_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(table(spark, folder, "documents"), shards=24)


def op3_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


def op5_language_scores(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.language_scores(table(spark, folder, "documents"))


def op6_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derivative_report(table(spark, folder, "pages"))


def op7_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.line_report(table(spark, folder, "documents"))


def op8_odd_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, folder, "documents"), width=3, threshold=0.85).drop("group", "text_key")


def op9_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_transcript_roles(spark: SparkSession, folder: str) -> DataFrame:
    return transcripts.role_report(table(spark, folder, "conversations"))


def op11_toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    scores = toxic_spans.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scores.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"), noise=31)


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_feistel_shards": op2_feistel_shards,
    "op3_quality_scores": op3_quality_scores,
    "op4_mixed_sources": op4_mixed_sources,
    "op5_language_scores": op5_language_scores,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_line_rules": op7_line_rules,
    "op8_odd_sketches": op8_odd_sketches,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_transcript_roles": op10_transcript_roles,
    "op11_toxic_spans": op11_toxic_spans,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op7_line_rules": line_rules.LINE_REPORT_SQL,
    "op13_phrase_collocations": phrases.COLLOCATIONS_SQL,
}

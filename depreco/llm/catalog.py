"""Registered queries of the operators on text corpora, with their DuckDB SQL where SQL can say it.

Every query reads whole tables; no row or text is cut. The trained operators (3, 5, 6), the token counts
and ids (2, 13), the tiles (7) and the mined rules (8) have no SQL; tests hold them against brute-force
versions, the tokenizer library or held-out labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_count, byte_bpe, decontaminate, licenses, line_dedup, mixing, near_dedup, quality_cnn, quality_rules, spelling, sql, toxicity, url_rules, vector_codes

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return bpe_count.token_counts(table(spark, sf_dir, "documents"), str(path("word_bpe_49k.json")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.quality_scores(docs, quality_cnn.train(docs, table(spark, sf_dir, "labels")))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select("row.doc_id", "n_lines", "n_dropped", "left_whole", "text")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.word_counts(spelling.occurrences(table(spark, sf_dir, "documents"))))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN, path

    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), str(path("byte_bpe_50k.tiktoken")), PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_token_counts, op3_quality_classifier, op4_source_mix, op5_quality_rules,
        op6_toxicity, op7_decontamination, op8_url_filter, op9_line_dedup, op10_license_scan,
        op11_spelling_variants, op12_vector_codes, op13_byte_bpe,
    )
}

ORACLES: dict[str, str] = {
    "op1_near_dedup": sql.NEAR_DEDUP,
    "op4_source_mix": sql.MIXING,
    "op9_line_dedup": sql.LINE_DEDUP,
    "op10_license_scan": sql.licenses(licenses.TEMPLATES, licenses.PERCENT),
    "op11_spelling_variants": sql.spelling(spelling.LEAST_LENGTH, spelling.LEAST_COUNT, spelling.DROP_EVERY, spelling.TIMES),
    "op12_vector_codes": sql.vector_codes(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE),
}

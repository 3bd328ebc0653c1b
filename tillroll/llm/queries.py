"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontamination, html_text, lm_score, merkle_manifest, near_duplicates, nearest_vectors, packing, periodic_runs, pii, quality, repeated_bytes, secrets, token_counts
from tillroll.llm.common import read_table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    return importlib.import_module("public_tokenizers").path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read_table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf_dir, "documents"))


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept_text")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(read_table(spark, sf_dir, "pages"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(read_table(spark, sf_dir, "documents"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors.nearest(read_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(read_table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_decontamination, op2_pii, op3_lm_score, op4_repeated_bytes, op5_packing, op6_quality, op7_html_text, op8_jaccard, op9_token_counts, op10_secrets,
             op11_periodic_runs, op12_nearest_vectors, op13_merkle_manifest]
    return {f.__name__: f for f in found}

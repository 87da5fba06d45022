"""The operators of this subpackage, and the pipeline of them, as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerflow.llm.block_search import nearest
from ledgerflow.llm.collocations import collocations
from ledgerflow.llm.edit_embedding import fingerprint_digest
from ledgerflow.llm.language_id import language_digest
from ledgerflow.llm.mixing import mixing_digest
from ledgerflow.llm.near_dup import Rule, near_duplicates
from ledgerflow.llm.packing import pack
from ledgerflow.llm.periodic import periodic_digest
from ledgerflow.llm.quality import quality_digest
from ledgerflow.llm.substring_dedup import substring_dedup_digest
from ledgerflow.llm.suffix_dedup import suffix_dedup_digest
from ledgerflow.llm.toxicity import toxicity_digest
from ledgerflow.llm.vector_dedup import near_vectors


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup_digest(table(spark, folder, "documents"))


def op3_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing_digest(table(spark, folder, "documents"))


def op6_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), Rule(size=3, percent=85))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_block_search(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_digest(table(spark, folder, "documents"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup_digest(table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_digest(table(spark, folder, "documents"))


def op13_edit_embedding(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_digest(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_curve_packing": op1_curve_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_vector_dedup": op3_vector_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_temperature_mixing": op5_temperature_mixing,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_quality": op7_quality,
    "op8_block_search": op8_block_search,
    "op9_language_id": op9_language_id,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_edit_embedding": op13_edit_embedding,
    "pipeline": corpus_pipeline.run,
}

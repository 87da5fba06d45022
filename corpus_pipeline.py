"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next.

`run(spark, folder)` applies them to `folder`/documents.parquet. Stages return the columns of documents, the last one the
pieces of sequences.

Every stage takes null, empty and blank texts, repeated rows and ids, null ids, empty tables and further columns; what each
does with them is said by the operator it calls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm.frames import discard, finished
from ledgerflow.llm.language_id import recognised
from ledgerflow.llm.mixing import mixed_documents
from ledgerflow.llm.near_dup import Rule, near_dedup
from ledgerflow.llm.packing import pack
from ledgerflow.llm.substring_dedup import substring_dedup


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language; those without one go."""
    return recognised(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles have a similarity of 0.8 or more."""
    return near_dedup(docs, Rule(size=5, percent=80))


def passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages of 50 words or more that a document with a smaller id has are cut out."""
    return substring_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Small sources repeat up to one and a half times on average; every document stays at least once."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of 2048 tokens along a space-filling curve."""
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("passages", passages),
    ("mixing", mixing),
    ("packing", packing),
]

# Automata, sketches and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of sequences made of `folder`/documents.parquet."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before: list[DataFrame] = []
    for name, stage in STAGES:
        given = docs
        docs = finished(spark, lambda: stage(spark, given, folder), f"pipeline-{name}")
        # What a stage staged goes with its end, and its documents with the end of the next one.
        discard(*before)
        before = [docs]
    return docs

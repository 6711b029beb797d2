"""The corpus pipeline: documents through language ID, exact dedup, near-dedup, substring dedup, and packing.

Each stage works on all that its predecessor kept. All but the last return the columns of documents.

Nulls and so on: a document without text, or without any letter, has no language and goes in the first stage, so
later stages see none. Rows that share a doc_id are rows of their own in the first two stages and one document for
near-dedup, where they stay or go together; a row without doc_id stays there. Very long texts are read whole. Extra columns,
whatever their names, are carried along to the last stage, which returns pieces only. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import exact_dedup, language_id, near_dedup, packing, substring_dedup
from textmill.llm._stage import Stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay, those of several too; what has no letters goes. The model learns from the labelled ones."""
    return language_id.keep(docs, language_id.fit(docs.where(language_id.remainder(4) != 2)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the one with the least doc_id stays."""
    return near_dedup.dedup(docs, spread=near_dedup.NARROW)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that occurred before are cut out."""
    return substring_dedup.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, placed in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("best-fit packing", pack),
]
#: Learned scores, weighted samples and token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = spark.read.parquet(f"{sf_dir}/documents.parquet"), Stage(spark, "pipeline")
    for i, (_, step) in enumerate(STAGES):
        docs = stage.save(step(spark, docs, sf_dir), f"stage{i}")
        if i:
            stage.drop(f"stage{i - 1}")
    return docs

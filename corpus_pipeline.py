"""The corpus pipeline: five training-data operators applied to ``documents`` in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathe.llm import exact_dedup, language, mixing, packing, simhash
from lathe.llm.common import stored, table
from lathe.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources come to their target weights."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with the digest of their ids."""
    return packing.digest(packing.pack(docs, tokenizer_path()))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("mix_sources", mix_sources), ("pack", pack_sequences)]

#: Fingerprints, the cube method's draws and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

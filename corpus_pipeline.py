"""Corpus pipeline: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before
kept, and is written as Parquet before the next reads it.  The first three
return rows of ``documents`` with its columns; the last the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid, minhash, packing, quality
from tidemark.llm.catalog import QUALITY_THRESHOLD
from tidemark.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold of the quality query."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, QUALITY_THRESHOLD)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the documents given; those without
    letters, or long enough to tell and parsed well by no language, go."""
    return langid.keep_known(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, in full sequences."""
    return packing.digests(packing.pack(docs))


STAGES = [("quality_classifier", quality_classifier), ("language_id", language_id),
          ("near_dedup", near_dedup), ("packing", pack)]

#: The stages can't be written in SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Training-corpus pipeline: five operators over ``documents``, each on all that the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame with the
columns of ``documents`` (the last adds ``slot`` and ``shard``). ``run`` writes
each stage's rows to the shared checkpoint folder and reads them back, so a
lost executor costs tasks of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import language_id, mixing, near_dedup, shards
from eventlake.llm.common import cut, table
from eventlake.llm.decontaminate import decontaminate

#: SQL cannot express trained language ID, Order MinHash or template matching.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language ID rejects: no text, no letter, or far from every learned language."""
    model = language_id.fit(docs)
    return language_id.predict(docs, model).filter("NOT rejected").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, the one with the smallest id."""
    return near_dedup.near_dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item was found."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as the mix of its source asks for."""
    return mixing.mix(docs, mixing.word_count("text"))


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document on a shard by its id."""
    return shards.assign(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontamination_stage),
    ("mix_sources", mixing_stage),
    ("shards", shard_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

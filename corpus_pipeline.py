"""The corpus pipeline: toxic documents go, then exact and near copies; what is left is mixed and packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmarts.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from sparkmarts.llm.common import written
from sparkmarts.llm.queries import documents, table, tokenizer


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.deduplicate(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is repeated as often as the mix takes it; in the next stage each repetition is a row of its own."""
    return mixing.repeat(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Models, seeded hashes and packing have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for place, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = written(docs)
    return docs

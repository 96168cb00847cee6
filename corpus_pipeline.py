"""The corpus pipeline: STAGES over documents, each written as Parquet and read again as the next one's docs.

Rows that a stage drops: language ID, texts without a language; exact dedup, all but one of equal texts; near
dedup, all but the smallest id of a component; decontamination, contaminated texts. The last stage returns the
documents that the mix takes, with the number of copies of each and the words they come to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from adlens.llm import decontam, exact_dedup, jaccard_join, langid, mixing
from adlens.llm.common import findable, shared_dir, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language can be told, as ``langid.known`` keeps them: null and empty texts, and those without a letter, go. docs may be empty, repeat rows, and hold nulls."""
    findable(spark)
    return langid.known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts, the one with the largest id, as ``exact_dedup.keep_one`` has it."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies, as ``jaccard_join.keep_one`` has it; texts without words are linked with nothing and stay."""
    findable(spark)
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that aren't contaminated by the table benchmark, as ``decontam.clean`` keeps them."""
    findable(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with copies and taken, as ``mixing.mixed`` has them."""
    findable(spark)
    return mixing.mixed(docs)


STAGES = [("language ID", language), ("exact dedup", exact), ("near dedup", near), ("decontamination", decontaminate), ("mixing", mix)]
#: Components, learned languages and rounded copies are beyond SQL; tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table documents."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs

"""A pipeline over `documents`: toxicity, exact copies, near copies, benchmark passages, then the mix of sources.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
The last one returns the rows of the mix, repeated as its plan says, with the
shard each copy goes to (mix_copy, mix_shard); the others return the columns
they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nivalis.llm import decontam, exactdedup, mixing, neardup, toxicity
from nivalis.llm.common import read, stash


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exactdedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"), mode="drop")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Toxicity scores have no SQL; the stages are held against brute force in the tests.
ORACLE_SQL = None

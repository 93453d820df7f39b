"""Folders that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir, or on one machine (tests) below one of our own where that is unset."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not told and not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="spark-"))
    return f"{(told or _own[0]).rstrip('/')}/nivalis-{label}-{uuid.uuid4().hex}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in a new shared folder: computed once, and read again where an executor is lost."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark drops a statement's shuffle files at its end, instead of when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)

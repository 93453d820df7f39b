"""Helpers the corpus operators share: tables in the shared folder, row keys, folds, samples."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own_dir: list[str] = []

#: Row counts up to which a side of identifiers (numbers) may be broadcast.
SMALL_ROWS = 500_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or on one machine (tests) one of our own where that is unset."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-"))
    return _own_dir[0]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/nivalis-{label}-{uuid.uuid4().hex}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs a re-read only, and fixes
    values such as partition ids that another run of the plan might change.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int, limit: int = SMALL_ROWS) -> DataFrame:
    """Hint a broadcast if the counted rows, of a number each, are within the limit; else leave the join to shuffle."""
    return F.broadcast(df) if rows <= limit else df


def crews(spark: SparkSession) -> int:
    """Into how many parts a key that copies share is split before they meet: grows with the shuffle partitions."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: Column) -> Column:
    """The fold that learning must not touch: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fold(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(0))


def bounded_sample(df: DataFrame, key: Column, limit: int) -> DataFrame:
    """Rows of df chosen by the hash of their distinct keys; all rows if there are no more than `limit`.

    Beyond that a threshold on the hash keeps 95 % of the limit in the mean; from a limit of
    20,000 on, that is seven standard deviations below it. The choice depends on the keys
    and their number only, so it is the same whenever the plan runs.
    """
    total = df.count()
    if total <= limit:
        return df
    share = 0.95 * limit / total
    u = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return df.where(u < share)


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def small(batches, most: int = 4 << 20):
    """Slices of Arrow batches with about `most` bytes each (on average, one row at least), so that Python holds few objects at a time.

    After each batch Arrow gives back the memory it does not use: workers outlive their tasks, and several of them share an executor.
    """
    import pyarrow as pa

    for batch in batches:
        step = max(1, most * batch.num_rows // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
        pa.default_memory_pool().release_unused()


def texts(batch, column: str = "text") -> list[bytes]:
    """A column of an Arrow batch as UTF-8 bytes; null counts as empty."""
    import pyarrow as pa

    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def chunks(items: list[bytes], most: int = 4 << 20):
    """Ranges (start, stop) of items with about `most` bytes each, a longer item alone."""
    start = held = 0
    for i, item in enumerate(items):
        if held and held + len(item) > most:
            yield start, i
            start, held = i, 0
        held += len(item)
    if start < len(items):
        yield start, len(items)


def running(df: DataFrame, group: str, order: list, label: str, value: str | None = None) -> DataFrame:
    """df with `before`: the sum of `value` (rows, where none is named) over the earlier rows of each row's group.

    Rows are dealt by ranges of (group, order), so a group of any size is spread over many tasks.
    Only the first group of a partition can have begun in an earlier one; what is carried over is
    one number for each partition, added up on the driver. `group` has no nulls, `value`
    nothing below 0, and `order` should end in what tells rows apart, else its ties meet in one task.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    spark = df.sparkSession
    keys = [F.col(group).asc(), *order]
    worth = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    dealt = df.withColumn("_worth", worth).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    dealt = dealt.sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    kind = T.StructType([*dealt.schema, T.StructField("before", T.LongType()), T.StructField("_leads", T.BooleanType())])
    names = kind.names

    def run(batches):
        lead = last = None
        total = 0  # of the last group so far
        for batch in batches:
            if not batch.num_rows:
                continue
            keys_, own = batch.column(group), batch.column("_worth").to_numpy()
            lead = keys_[0] if lead is None else lead
            ends = np.cumsum(own)
            new = np.concatenate([[True], pc.not_equal(keys_[1:], keys_[:-1]).to_numpy(zero_copy_only=False)])
            base = (ends - own)[np.flatnonzero(new)]
            if last == keys_[0]:
                base[0] -= total
            before = ends - own - base[np.cumsum(new) - 1]
            last, total = keys_[-1], int(before[-1] + own[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64()), pc.equal(keys_, lead)], names)

    local = stash(dealt.mapInArrow(run, kind), label)
    ends = local.groupBy("_part").agg(
        F.min(group).alias("first"), F.max(F.struct(group, F.col("before") + F.col("_worth"))).alias("last"), F.sum(F.when(F.col("_leads"), F.col("_worth"))).alias("led")
    )
    carried, held, before = [], 0, None
    for r in sorted(ends.collect()):
        if r["first"] != before:
            held = 0
        carried.append((r["_part"], held))
        held = held + r["led"] if r["first"] == r["last"][0] else r["last"][1]
        before = r["last"][0]
    carries = spark.createDataFrame([c for c in carried if c[1]], "_part int, _carry long")
    summed = F.col("before") + F.when(F.col("_leads"), F.coalesce("_carry", F.lit(0))).otherwise(0)
    return local.join(F.broadcast(carries), "_part", "left").withColumn("before", summed).drop("_part", "_carry", "_leads", "_worth")

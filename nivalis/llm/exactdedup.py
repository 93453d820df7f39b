"""Exact de-duplication by a tree-merge of sorted digest runs.

Each input partition is one run: every digest once, with the smallest identifier and a
count. In each round the runs of `fan_in` neighbouring partitions (a power of two,
so a binomial tree is folded a few levels at a time) exchange rows by digest
and become one run. Spark's sort-based aggregation does the merging: it brings
what a task gets into digest order (spilling if it must) and keeps the smallest identifier
of equal digests in one pass; a round's result is written to the shared folder, so a
lost executor costs its share of that round only. A text that fills a third of all
rows thus arrives at any task as at most `fan_in` rows. Two rows only count as
copies if SHA-256, length and an independent 64-bit hash all agree; this
verification is part of the merge key at every level. The decisions then walk
down the tree again, so that no join key is hot either.

Defined results. A null text counts as empty. Rows with a null identifier come
after all others. Of repeated rows (same identifier and text) one is kept. An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import stash

KEY = ["sha", "length", "other"]


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = normalised(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.octet_length(text).alias("length"),
        F.xxhash64(text).alias("other"),
    )


def merge_round(runs: DataFrame, fan_in: int) -> DataFrame:
    """One round: every `fan_in` neighbouring runs become one, in digest order."""
    return (
        runs.withColumn("run", F.expr(f"run div {fan_in}"))
        .groupBy(*KEY, "run")
        .agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of docs."""
    if fan_in < 2 or fan_in & (fan_in - 1):
        raise ValueError("fan_in must be a power of two")
    slim = digests(docs, id_col, text_col).select(
        "*", F.spark_partition_id().cast("long").alias("run"), F.monotonically_increasing_id().alias("row")
    )
    slim = stash(slim, "digest-runs")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    levels = [stash(merge_round(slim.select(*KEY, "run", first.alias("first"), F.lit(1).cast("long").alias("n")), fan_in), "digest-level")]
    runs = (slim.agg(F.max("run")).first()[0] or 0) // fan_in + 1
    while runs > 1:
        levels.append(stash(merge_round(levels[-1], fan_in), "digest-level"))
        runs = -(-runs // fan_in)
    # Back down: only digests with copies, first to the lowest level's runs, then to the rows.
    copies = levels[-1].where("n > 1").select(*KEY, "first", F.col("n").alias("group_size"))
    routes = levels[0].select(*KEY, "run").join(copies, KEY)
    rows = slim.withColumn("run", F.expr(f"run div {fan_in}")).join(routes, [*KEY, "run"], "left")
    return rows.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns, whatever these are called.

    The join back is on identifier and digest, so a hot text is no hot key. Repeated rows
    (same identifier and text) meet there, and one of them stays, without another shuffle.
    """
    key = lambda ident, sha: F.concat_ws(":", F.isnull(ident).cast("string"), F.coalesce(ident.cast("string"), F.lit("")), sha)
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias("key"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.select(F.struct(*columns).alias("doc"), key(F.col(id_col), F.sha2(normalised(text_col), 256)).alias("key"))
    once = own.join(kept, "key", "left_semi").dropDuplicates(["key"])
    return once.select(*(F.col(f"doc.`{c}`") for c in docs.columns))

"""Mixing sources to target weights, with DataFrame and SQL functions only.

A multivariate-hypergeometric splitting tree: every source is cut into up to
4096 blocks by a hash of its documents. A source's target fixes how many passes
over all blocks and which part of one more pass the mix takes, and so an exact
quota of block draws. The vector of quotas is split between two halves of the
output shards by a multivariate hypergeometric draw (one conditional
hypergeometric draw per source, by inversion of its distribution function with
a hashed uniform), and each half again, down to single shards. Each shard then
owns a run of consecutive draws of the source's permuted blocks; runs are
disjoint. Rows are put in a hashed order inside each shard only.

All tables beyond the documents are small: one row per source and block (4096
per source at most), one per shard and source. They are written to the shared
folder as they come, which keeps each plan short. Blocks spread any source, hot
or not, over 4096 keys. All draws come from hashes, so reruns agree.

Defined results. A null text has size 0. A null source is a source of its own,
in the last place. A null doc_id falls into a block by its text's hash. Rows
repeated in the input are documents of their own. An empty table gives an
empty mix. Further columns are carried by mix() and ignored by mix_plan(); columns
mix_copy and mix_shard of the input are replaced. No document is drawn more
often than MAX_REPEAT says, an empty one neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from nivalis.llm.common import stash

BLOCKS = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2.0
SHARDS = 64


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the block the document falls into."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit(""))
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        block_of(ident).alias("block"),
    )


def block_of(ident):
    return F.conv(F.substring(F.md5(ident.cast("binary")), 1, 3), 16, 10).cast("int")


def targets(blocks: DataFrame, weights=WEIGHTS, share=SHARE, max_repeat=MAX_REPEAT) -> DataFrame:
    """source, rank, source_size and target: weights water-filled below max_repeat times each source's size.

    One row per source, so the windows over all sources are small.
    """
    per_source = blocks.groupBy("source").agg(F.sum("words").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.select("*", F.row_number().over(by_name).alias("rank")).select(
        "*",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1).alias("w"),
        (F.lit(float(max_repeat)) * F.col("source_size")).alias("most"),
    )
    everything = W.partitionBy(F.lit(1))
    by_ratio = everything.orderBy(F.col("most") / F.col("w"), "rank").rowsBetween(W.unboundedPreceding, -1)
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("most").over(by_ratio), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0))
    )
    filled = ranked.withColumn("level", level).withColumn("fits", F.col("level") <= F.col("most") / F.col("w"))
    water = F.max_by("level", F.when(F.col("fits"), -F.col("most") / F.col("w"))).over(everything)
    return filled.withColumn("water", water).select(
        "source",
        "rank",
        "source_size",
        F.least("most", F.coalesce(F.col("water") * F.col("w"), F.col("most"))).alias("target"),
    )


def block_draws(blocks: DataFrame, per_source: DataFrame) -> DataFrame:
    """How often each block is drawn: whole passes, then permuted blocks up to the rest, closed by the best-fitting one."""
    size, target = F.col("source_size"), F.col("target")
    passes = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("int")
    b = blocks.join(per_source.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "rank", "block", "words", "source_size", "target",
        passes.alias("passes"),
        (target - passes * size).alias("rest"),
        F.md5(F.concat_ws(":", F.coalesce("source", F.lit("")), "block").cast("binary")).alias("perm"),
    )
    own = W.partitionBy("source")
    run = F.sum("words").over(own.orderBy("perm").rowsBetween(W.unboundedPreceding, 0))
    b = b.withColumn("in_run", (run <= F.col("rest")) & (F.col("rest") > 0))
    gap = F.col("rest") - F.coalesce(F.sum(F.when(F.col("in_run"), F.col("words"))).over(own), F.lit(0))
    b = b.withColumn("gap", gap).withColumn("miss", F.abs(F.col("words") - F.col("gap")))
    best = F.row_number().over(W.partitionBy("source", "in_run").orderBy("miss", "perm")) == 1
    closes = ~F.col("in_run") & best & (F.col("miss") < F.col("gap"))
    return b.withColumn("draws", F.col("passes") + (F.col("in_run") | closes).cast("int"))


#: Natural log of x!: exact up to 20, beyond that Stirling's series (error below 1e-9).
_LN_FACT = (
    "CASE WHEN {x} <= 20 THEN ln(CAST(factorial(CAST({x} AS INT)) AS DOUBLE)) ELSE "
    "{x} * ln({x}) - {x} + 0.5 * ln(2 * pi() * {x}) + 1 / (12.0D * {x}) - 1 / (360.0D * {x} * {x} * {x}) END"
)


def _ln_choose(n: str, k: str) -> str:
    return "(" + " - ".join("(" + _LN_FACT.format(x=f"({x})") + ")" for x in (n, k, f"{n} - {k}")) + ")"


#: The marked ones among v.drawn of v.total, v.marked of which are marked: the first value whose distribution function reaches v.u.
_HYPERGEOMETRIC = f"""aggregate(
    sequence(v.low, v.high),
    named_struct('cdf', 0.0D, 'x', CAST(NULL AS BIGINT)),
    (a, k) -> CASE WHEN a.x IS NOT NULL THEN a ELSE transform(
        array(a.cdf + exp({_ln_choose("v.marked", "k")} + {_ln_choose("(v.total - v.marked)", "(v.drawn - k)")} - {_ln_choose("v.total", "v.drawn")})),
        c -> named_struct('cdf', c, 'x', CASE WHEN c >= v.u OR k >= v.high THEN k END))[0] END,
    a -> a.x)"""


def splitting_tree(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """shard, rank and quota: the quotas (rank, draws) split among the shards by a binary tree.

    One row per node with an array over all sources; log2(shards) narrow levels.
    """
    depth = shards.bit_length() - 1
    if shards != 1 << depth:
        raise ValueError("shards must be a power of two")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "draws")))
    nodes = quotas.groupBy().agg(ordered.alias("q")).selectExpr(
        "0L AS node", "transform(q, s -> s.rank) AS ranks", "transform(q, s -> s.draws) AS q"
    )
    for level in range(depth):
        u = f"(shiftrightunsigned(xxhash64(node, {level}, i), 11) + 0.5D) / 9007199254740992.0D"
        left = f"""aggregate(
            sequence(0, size(q) - 1),
            named_struct('total', n, 'left', (n + pmod(node + {level}, 2)) div 2, 'out', CAST(array() AS ARRAY<BIGINT>)),
            (s, i) -> transform(
                transform(array(named_struct(
                    'total', s.total, 'marked', q[i], 'drawn', s.left, 'u', {u},
                    'low', greatest(0L, s.left - (s.total - q[i])), 'high', least(q[i], s.left))), v -> {_HYPERGEOMETRIC}),
                x -> named_struct('total', s.total - q[i], 'left', s.left - x, 'out', concat(s.out, array(x))))[0],
            s -> s.out)"""
        nodes = (
            nodes.where("size(q) > 0")
            .selectExpr("node", "ranks", "q", "aggregate(q, 0L, (t, v) -> t + v) AS n")
            .selectExpr("node", "ranks", "q", f"{left} AS l")
            .selectExpr("node", "ranks", "explode(array(struct(0L AS side, l AS q), struct(1L AS side, zip_with(q, l, (a, b) -> a - b) AS q))) AS h")
            .selectExpr("node * 2 + h.side AS node", "ranks", "h.q AS q")
        )
    return nodes.selectExpr("node AS shard", "explode(arrays_zip(ranks, q)) AS z").selectExpr(
        "shard", "z.ranks AS rank", "z.q AS quota"
    )


def mix_plan(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """doc_id, source, size, block, source_size, target, taken and the shards that get the document, one row per document."""
    own = stash(sized(docs), "mix-sizes")
    draws = plan_blocks(own, shards, **options).withColumnsRenamed({"source": "of", "block": "of_block"})
    return own.join(draws, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))).select(
        "doc_id", "source", "size", "block", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards"
    )


def plan_blocks(own: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """source, block, source_size, target and the array of shards that draw the block."""
    blocks = stash(own.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    drawn = stash(block_draws(blocks, targets(blocks, **options)), "mix-draws")
    quotas = drawn.groupBy("rank").agg(F.sum("draws").cast("long").alias("draws"))
    before = W.partitionBy("rank").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    slots = (
        stash(splitting_tree(quotas, shards), "mix-tree")
        .withColumn("start", F.coalesce(F.sum("quota").over(before), F.lit(0)))
        .where("quota > 0")
        .selectExpr("rank", "shard", "explode(sequence(start, start + quota - 1)) AS slot")
    )
    copies = drawn.where("draws > 0").selectExpr("rank", "block", "perm", "explode(sequence(1, draws)) AS pass")
    order = W.partitionBy("rank").orderBy("pass", "perm")
    copies = copies.withColumn("slot", (F.row_number().over(order) - 1).cast("long"))
    got = copies.join(slots, ["rank", "slot"]).groupBy("rank", "block").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    return drawn.select("source", "rank", "block", "source_size", "target").join(got, ["rank", "block"], "left").select(
        "source", "block", "source_size", "target",
        F.coalesce("shards", F.expr("CAST(array() AS ARRAY<BIGINT>)")).alias("shards"),
    )


def mix(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """The mix itself: the rows of docs, repeated as planned, with `mix_shard`; in hashed order inside each piece of a shard."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit(""))
    own = docs.select(F.struct(*docs.columns).alias("doc"), F.col("source").alias("own_source"), block_of(ident).alias("own_block"))
    plan = plan_blocks(sized(docs), shards, **options).select("source", "block", "shards")
    rows = own.join(plan, F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_block") == F.col("block")))
    rows = rows.select("doc", F.posexplode("shards").alias("copy", "shard"))
    own_id = F.col("doc.doc_id")
    # A shard is written by several tasks, the more the more partitions there are.
    pieces = max(16, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    rows = rows.repartition("shard", F.pmod(F.xxhash64(own_id), F.lit(pieces))).sortWithinPartitions("shard", F.xxhash64(own_id, "copy", F.lit("order")))
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("mix_copy", "mix_shard")]
    return rows.select(*kept, F.col("copy").alias("mix_copy"), F.col("shard").alias("mix_shard"))

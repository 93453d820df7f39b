"""A prefix trie over conversations, by a van Emde Boas recursion.

Every conversation is a sequence of turns (role, text); a node is a distinct
sequence of first turns. Nodes are never compared text by text: a turn is a 128-bit
digest, a run of turns is named by its two halves, and a prefix by the prefix at the last cut
and the run since then.

1. Turns are numbered within their conversation by a sort over ranges, so that a
   conversation of any length is spread over many tasks.
2. Naming. Sequences are cut at half depth, their halves again, and so on; all pieces of
   one size are worked on together. Going up, runs of 2, 4, 8 ... turns get digests
   from their halves; going down, prefixes at the cuts get names: first those at half the
   largest depth (the roots of the lower forests), then those at a quarter and at three quarters,
   and so on to single turns. The last six halvings happen inside a chunk of `CHUNK`
   turns, which is one row; those above are Spark joins over one row per chunk.
3. Every node knows its `cuts`, the names of its ancestors 1, 2, 4, ... turns up, as far as
   the largest cut that its depth is a multiple of.
4. Totals are grafted upward along the same recursion: per cut size s, a trie of depth 2s takes
   the totals of the lower tries that hang on its cut, from s = 1 on; then totals go on to the
   nodes between the cuts, from the largest s down. Every node joins a constant number of
   times on average; rounds number thrice the logarithm of the largest depth.

Parents with very many children (at most 1,000, by count) are broadcast with their number
for the look-up of parents, others joined. The ids that end at one node are sorted over ranges, joined
to pieces of text there, and only these are hashed one after the other.

Defined results. A null turn comes first; turns of equal number come in the order of their digests. A
null role or text is empty. Rows without conv_id belong to no conversation. Repeated rows
are turns of their own. An empty table gives no node, not even a root. Further columns are
ignored. Two different prefixes get one name with a chance below 1e-14 for 1e12 nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import running, stash

HALVINGS = 6
CHUNK = 1 << HALVINGS  # turns in a row
SPAN = 1 << 12  # turns of a conversation that join under one key
HOT = 1000  # parents at most that are broadcast
PIECE = 1 << 13  # ids joined to one piece of text
ROOT = b"\0" * 16
RUN, PREFIX = b"\1", b"\0"


def _digest(c: Column) -> Column:
    return F.unhex(F.substring(F.sha2(c, 256), 1, 32))


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 1), digest and bytes (of the text) of every turn in its conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    found = running(stash(slim, "trie-turns"), "conv", [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")], "trie-order")
    return found.select("conv", (F.col("before") + 1).alias("pos"), "digest", "bytes")


def rebuilt(turns: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, turns) and their turns (conv, depth, digest, bytes), with the beginning of their group's first one.

    The first h (0 to `most`, by the id's hash) turns of conversation c - c % group, then the own ones after the first h.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n")).select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    heads = turns.where(F.col("pos") <= most).withColumnRenamed("conv", "base")
    there = heads.groupBy("base").agg(F.count("*").alias("head"))
    convs = sizes.join(there, "base", "left").withColumn("taken", F.least("h", F.coalesce("head", F.lit(0))))
    convs = stash(convs.select("conv", "base", "n", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), "trie-conversations")
    first = convs.join(heads, "base").where("pos <= h").select("conv", F.col("pos").alias("depth"), "digest", "bytes")
    # Where the base has fewer than h turns, the own ones move up; a long conversation joins its shift under several keys.
    moved = convs.where("taken < h AND n > h").select("conv", (F.col("h") - F.col("taken")).alias("shift"), F.explode(F.expr(f"sequence(0L, n div {SPAN})")).alias("span"))
    own = turns.where(F.col("pos") > h).withColumn("span", F.expr(f"pos div {SPAN}")).join(moved, ["conv", "span"], "left")
    rest = own.select("conv", (F.col("pos") - F.coalesce("shift", F.lit(0))).alias("depth"), "digest", "bytes")
    return convs.select("conv", "turns"), first.unionByName(rest)


def _runs(digests: list[bytes]) -> list[list[bytes]]:
    """Digests of all complete runs of 1, 2, 4 ... turns, from their halves."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_hash(RUN, below[i], below[i + 1]) for i in range(0, len(below) - 1, 2)])
    return levels


def _hash(kind: bytes, a: bytes, b: bytes) -> bytes:
    return hashlib.sha256(kind + a + b).digest()[:16]


def names_in_chunk(start: bytes, end: bytes | None, digests: list[bytes]) -> list[bytes]:
    """Names of the prefixes at positions 0 to len(digests) of a chunk: at its middle first, then at the quarters, down to single turns."""
    n, runs = len(digests), _runs(digests)
    names = [start] + [b""] * n
    for k in reversed(range(min(len(runs), HALVINGS))):
        for p in range(1 << k, n + 1, 2 << k):
            names[p] = _hash(PREFIX, names[p - (1 << k)], runs[k][(p >> k) - 1])
    if n == CHUNK:
        names[n] = end
    return names


def _chunks(turns: DataFrame) -> DataFrame:
    """conv, chunk, digests, sizes, and run: the digest of a complete chunk."""
    rows = turns.groupBy("conv", F.expr(f"(depth - 1) div {CHUNK}").alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "bytes"))).alias("t"))
    rows = rows.select("conv", "chunk", F.col("t.digest").alias("digests"), F.col("t.bytes").alias("sizes"))

    def run(batches):
        for batch in batches:
            whole = [_runs(d)[-1][0] if len(d) == CHUNK else None for d in batch.column("digests").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(whole, pa.binary())], [*batch.schema.names, "run"])

    return stash(rows.mapInArrow(run, "conv long, chunk long, digests array<binary>, sizes array<long>, run binary"), "trie-chunks")


def _starts(chunks: DataFrame) -> DataFrame | None:
    """conv, at, name and cuts of the prefixes that end with a complete chunk (at chunks long), by the recursion over chunks."""
    whole = chunks.where("run IS NOT NULL").select("conv", "chunk", "run")
    most = whole.agg(F.max("chunk")).first()[0]
    if most is None:
        return None
    pair = lambda kind, a, b: _digest(F.concat(F.lit(kind), a, b))
    halves = F.col("chunk") % 2
    runs = [whole]
    while 2 << (len(runs) - 1) <= most + 1:
        of = runs[-1].groupBy("conv", F.expr("chunk div 2").alias("chunk")).agg(F.max(F.when(halves == 0, F.col("run"))).alias("a"), F.max(F.when(halves == 1, F.col("run"))).alias("b"))
        runs.append(stash(of.where("a IS NOT NULL AND b IS NOT NULL").select("conv", "chunk", pair(RUN, F.col("a"), F.col("b")).alias("run")), "trie-runs"))
    found = None
    for k in reversed(range(len(runs))):
        cut = runs[k].where("chunk % 2 = 0").select("conv", F.shiftleft("chunk", k).alias("from"), "run")
        at_start = cut.where("`from` = 0").withColumn("name", F.lit(ROOT))
        later = cut.where("`from` > 0").join(found.withColumnRenamed("at", "from"), ["conv", "from"]) if found is not None else at_start.limit(0)
        new = at_start.unionByName(later).select("conv", (F.col("from") + (1 << k)).alias("at"), pair(PREFIX, F.col("name"), F.col("run")).alias("name"))
        new = stash(new, "trie-starts")
        found = new if found is None else found.unionByName(new)
    # The names 1, 2, 4 ... chunks up, as far as the largest cut.
    up = found.select("conv", "at", F.explode(F.expr(f"filter(sequence(0, {len(runs) - 1}), k -> at % shiftleft(1L, k) = 0)")).alias("k"))
    up = up.withColumn("from", F.expr("at - shiftleft(1L, k)"))
    known = found.select("conv", F.col("at").alias("from"), F.col("name").alias("cut"))
    cuts = up.where("`from` = 0").withColumn("cut", F.lit(ROOT)).unionByName(up.where("`from` > 0").join(known, ["conv", "from"]))
    cuts = cuts.groupBy("conv", "at").agg(F.sort_array(F.collect_list(F.struct("k", "cut"))).alias("c"))
    return stash(found.join(cuts.select("conv", "at", F.col("c.cut").alias("cuts")), ["conv", "at"]), "trie-cuts")


PLACES = "name binary, depth long, conv long, bytes long, cuts array<binary>, ends boolean"


def places(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """name, depth, conv, bytes, cuts, and whether the conversation ends there, for every turn of every conversation."""
    chunks = _chunks(turns)
    starts = _starts(chunks)
    last = convs.where("turns > 0").select("conv", F.expr(f"(turns - 1) div {CHUNK}").alias("chunk"), F.lit(True).alias("last"))
    rows = chunks.drop("run").join(last, ["conv", "chunk"], "left")
    if starts is None:
        nothing = F.lit(None)
        rows = rows.select("*", nothing.cast("binary").alias("start"), nothing.cast("binary").alias("end"), nothing.cast("array<binary>").alias("above"))
    else:
        rows = rows.join(starts.select("conv", F.col("at").alias("chunk"), F.col("name").alias("start")), ["conv", "chunk"], "left")
        rows = rows.join(starts.select("conv", (F.col("at") - 1).alias("chunk"), F.col("name").alias("end"), F.col("cuts").alias("above")), ["conv", "chunk"], "left")

    def run(batches):
        for batch in batches:
            out = []
            for conv, chunk, digests, sizes, last, start, end, above in zip(*(batch.column(c).to_pylist() for c in ("conv", "chunk", "digests", "sizes", "last", "start", "end", "above"))):
                names = names_in_chunk(start or ROOT, end, digests)
                for p in range(1, len(names)):
                    within = [names[p - (1 << k)] for k in range(min(HALVINGS, (p & -p).bit_length()))]
                    cuts = within + above if p == CHUNK else within
                    out.append((names[p], chunk * CHUNK + p, conv, sizes[p - 1], cuts, bool(last) and p == len(digests)))
                if len(out) >= 1 << 14:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.bool_()]

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)], ["name", "depth", "conv", "bytes", "cuts", "ends"])

    return stash(rows.mapInArrow(run, PLACES), "trie-places")


def _grafted(nodes: DataFrame, deepest: int) -> DataFrame:
    """nodes with `leaves` and `saved` summed over their subtrees: up along the cuts, then down between them."""
    top = deepest.bit_length()
    level = lambda depth: F.when(depth > 0, F.log2(depth.bitwiseAND(-depth)).cast("int")).otherwise(top)
    totals = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    nodes = nodes.withColumn("level", level(F.col("depth")))

    def with_more(own: DataFrame, more: DataFrame) -> DataFrame:
        more = more.select("name", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        sums = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}
        return own.join(more, "name", "left").withColumns(sums).drop("more_leaves", "more_saved")

    tries, waiting = [], None  # per cut size; totals on their way to roots of larger tries
    for k in range(top + 1):
        own = nodes.where(F.col("level") == k)
        tries.append(stash(with_more(own, waiting.where(F.col("level") == k)) if k else own, "trie-up"))
        if k < top:
            roots = tries[k].select(F.element_at("cuts", k + 1).alias("name"), level(F.col("depth") - (1 << k)).alias("level"), "leaves", "saved")
            passed = roots if waiting is None else roots.unionByName(waiting.where(F.col("level") > k))
            waiting = stash(passed.groupBy("name", "level").agg(*totals), "trie-waiting")
    done, full = tries[top], None  # the root
    for k in reversed(range(top)):
        if full is None:
            found = tries[k]
        else:
            passed = full.select(F.element_at("cuts", k + 1).alias("name"), "leaves", "saved").groupBy("name").agg(*totals)
            found = stash(with_more(tries[k], passed), "trie-down")
        full = found if full is None else full.unionByName(found)
    return done if full is None else done.unionByName(full)


def ends_digest(ends: DataFrame) -> DataFrame:
    """name and the SHA-256 of its conv ids in numeric order, comma-joined; one bounded piece of text in memory at a time."""

    def pieces(batches):
        name, first, ids = None, None, []
        for batch in batches:
            out = []
            for n, c in zip(batch.column("name").to_pylist(), batch.column("conv").to_pylist()):
                if n != name or len(ids) >= PIECE:
                    if ids:
                        out.append((name, first, ",".join(map(str, ids))))
                    name, first, ids = n, c, []
                ids.append(c)
            yield table(out)
        yield table([(name, first, ",".join(map(str, ids)))] if ids else [])

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 3, (pa.binary(), pa.int64(), pa.string()))], ["name", "first", "ids"])

    def hashed(batches):
        name, sha = None, None
        for batch in batches:
            out = []
            for n, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if n != name:
                    if sha:
                        out.append((name, sha.hexdigest()))
                    name, sha = n, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pairs(out)
        yield pairs([(name, sha.hexdigest())] if sha else [])

    def pairs(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 2, (pa.binary(), pa.string()))], ["name", "ends_sha256"])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = ends.repartitionByRange(parts, "name", "conv").sortWithinPartitions("name", "conv").mapInArrow(pieces, "name binary, first long, ids string")
    return texts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "name binary, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """All nodes of the trie over conversations (conv, turns) with their turns (conv, depth, digest, bytes).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = convs.sparkSession
    at = places(convs, turns)
    below = at.groupBy("name").agg(F.min(F.struct("conv", "depth", "bytes", "cuts")).alias("m"), F.count("*").alias("n_convs"))
    below = below.select("name", F.col("m.conv").alias("conv_id"), F.col("m.depth").alias("depth"), F.col("m.bytes").alias("bytes"), F.col("m.cuts").alias("cuts"), "n_convs")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("name"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), F.lit(None).cast("array<binary>").alias("cuts"), "n_convs")
    nodes = stash(below.unionByName(root), "trie-nodes")
    size, deepest = nodes.agg(F.count("*"), F.max("depth")).first()
    parents = nodes.where("depth > 0").groupBy(F.element_at("cuts", 1).alias("name")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(parents, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")})
    full = stash(_grafted(stash(nodes, "trie-children"), deepest or 0), "trie-totals")
    full = full.withColumn("parent", F.when(F.col("depth") > 0, F.element_at("cuts", 1))).drop("cuts", "bytes", "level")
    # Parents of more than one in HOT of all nodes are fewer than HOT.
    known = full.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = known.where(F.col("n_children") > (size or 0) / HOT).select("parent", F.col("parent_conv_id").alias("hot_conv_id"))
    tagged = full.join(F.broadcast(hot), "parent", "left")
    easy = tagged.where("hot_conv_id IS NOT NULL OR depth = 0").withColumnRenamed("hot_conv_id", "parent_conv_id")
    rest = tagged.where("hot_conv_id IS NULL AND depth > 0").drop("hot_conv_id").join(known.drop("n_children"), "parent")
    ends = at.where("ends").select("name", "conv").unionByName(convs.where("turns = 0").select(F.lit(ROOT).alias("name"), "conv"))
    nothing = hashlib.sha256(b"").hexdigest()
    return easy.unionByName(rest).join(ends_digest(ends), "name", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie over the conversations as they are."""
    turns = turns_of(conversations)
    convs = turns.groupBy("conv").agg(F.count("*").alias("turns"))
    return trie(convs, turns.withColumnRenamed("pos", "depth"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie over the conversations as rebuilt() makes them."""
    return trie(*rebuilt(turns_of(conversations)))

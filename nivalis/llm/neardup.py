"""Near-duplicates by bottom-k sketches from one hash function.

A document is the set of its 5-word shingles. One 64-bit hash per shingle; the `K`
smallest are the sketch. Documents with equal sets form a class and go on as one.

Candidates come from inverted lists of retained values. Two sketches of sets with
a Jaccard similarity of 0.75 share many values, at least `needed()` of them (sets
of up to K shingles: always; larger ones: but for a chance below 1e-4 at exactly
0.75, vanishing above). So it is enough to list a class under its rarest values,
as many as its sketch has more than the needed overlap less one, and values that
no other class has are no list at all. Common passages are thereby listed only
under documents that consist of them for the most part.

No list is turned into all its pairs. It names one hub, the class with the fewest
values that nobody else has, and members of other components are compared with
it (the union-sketch estimate first, then the full sets); what is linked is one
component from then on. Classes in lists that still span components are near
misses of each other: they get sketches as long as their sets, and so lists whose
bounds are exact for every pair of sizes. A class that is not like the hub of its
group has, as a rule, more values of its own than any link allows and is under no
list any more. These lists go through the same turn with a hub; only then pairs
of entries in different components are compared, all of them, on the full sets.

Components grow by label propagation with pointer jumping; no links, labels or
sketches of all documents reach the driver. Copies join their class through crews,
as many as there are shuffle partitions (64 at least), so no join key is hot.

Defined results. Texts without words have 0 shingles and are linked with nothing; a
text of fewer than 5 words is one shingle. Rows without doc_id are linked with
nothing and have no component. Rows with the same doc_id are one document, linked
with what any of its texts is linked with. An
empty table gives an empty result; further columns are ignored by components()
and carried by keep_one().
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from nivalis.llm.common import crews, maybe_broadcast, small, stash, texts

SHINGLE = 5
PERCENT = 75
K = 64
LARGE_OVERLAP = 34
MARGIN = 0.25
PIECE = 1 << 17  # words hashed at a time

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash's base and of its inverse, modulo 2^64; grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", INVERSE)):
                table = np.full(n, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
        return self.up, self.down


def shingle_hashes(text: bytes, powers: Powers) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles: words by white space, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    size = min(SHINGLE, len(words))
    found = []
    for at in range(0, len(words) - size + 1, PIECE):
        part = words[at : at + PIECE + size - 1]
        joined = np.frombuffer(b" ".join(part), np.uint8)
        up, down = powers.upto(len(joined) + 1)
        sums = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum((joined + np.uint64(1)) * up[: len(joined)], out=sums[1:])
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        s, e = starts[: len(part) - size + 1], ends[size - 1 :]
        h = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        found.append(h ^ (h >> np.uint64(31)))
    return np.unique(np.concatenate(found).view(np.int64))


def needed(n: Column) -> Column:
    """The least number of retained values that sketches of two linked sets share, given the size of one."""
    small = F.floor(F.least(n * PERCENT / 100, F.when(n * 100 / PERCENT > K, K - n * (100 / PERCENT - 1)).otherwise(n)))
    return F.when(n > K, F.lit(LARGE_OVERLAP)).otherwise(F.greatest(small, F.lit(1)))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, crew, n_shingles, sig (a digest of the whole set; null without words) and the sketch."""

    def run(batches):
        powers = Powers()
        for batch in small(batches):
            n, sig, sketch = [], [], []
            for text in texts(batch):
                h = shingle_hashes(text, powers)
                n.append(len(h))
                sig.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                sketch.append(h[:K].copy())  # else the whole set stays in memory
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(sketch, pa.list_(pa.int64()))],
                ["doc_id", "n", "sig", "sketch"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = own.mapInArrow(run, "doc_id long, n long, sig binary, sketch array<bigint>")
    return found.withColumn("crew", F.pmod(F.xxhash64("doc_id"), F.lit(crews(docs.sparkSession))))


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """cls, n and the whole sorted set of 64-bit hashes, for the classes in ids; a class whose doc_id repeats keeps one row."""

    def run(batches):
        powers = Powers()
        for batch in small(batches):
            sets = [shingle_hashes(t, powers) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "n", "members"]
            )

    own = docs.select(F.col("doc_id").cast("long").alias("cls"), F.col("text").cast("string").alias("text"))
    return own.join(ids, "cls", "left_semi").mapInArrow(run, "cls long, n long, members array<bigint>")


def union_estimate(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Of two sketches: the share of the union's k smallest values that both have."""
    union = np.union1d(a, b)[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return np.count_nonzero(both <= union[-1]) / len(union) if len(union) else 0.0


def _sides(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) with the arrays of both classes, va and vb."""
    for side in ("a", "b"):
        pairs = pairs.join(values.select(F.col("cls").alias(side), F.col(name).alias(f"v{side}")), side)
    return pairs.select("a", "b", "va", "vb")


def _chosen(pairs: DataFrame, keep) -> DataFrame:
    """The pairs (a, b) for which keep(va, vb) holds."""

    def run(batches):
        for batch in small(batches):
            sides = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in ("va", "vb")]
            kept = [keep(*(v[o[i] : o[i + 1]] for o, v in sides)) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose estimated similarity is not far below the limit."""
    return _chosen(_sides(pairs, reps, "sketch"), lambda a, b: union_estimate(a, b) >= PERCENT / 100 - MARGIN)


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets have the similarity asked for."""

    def keep(a, b):
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= PERCENT * (len(a) + len(b) - common)

    return _chosen(_sides(pairs, sets, "members"), keep)


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The same for pairs whose sets are still to be made."""
    pairs = stash(pairs, "near-likely")
    ids = pairs.selectExpr("explode(array(a, b)) AS cls").distinct()
    return _similar(pairs, stash(full_sets(docs, ids), "near-sets"))


def connected(edges: DataFrame) -> DataFrame:
    """node and comp (the smallest node it reaches) for the nodes of edges (a, b)."""
    both = stash(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "near-labels")
    while True:
        near = both.join(labels.selectExpr("node AS b", "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        jump = step.alias("s").join(step.selectExpr("node AS target", "next AS beyond"), F.col("s.next") == F.col("target"))
        moved = stash(jump.select("node", F.col("comp").alias("before"), F.least("next", "beyond").alias("comp")), "near-labels")
        labels = moved.select("node", "comp")
        if moved.where("comp != before").isEmpty():
            return labels


def _ranked(entries: DataFrame) -> DataFrame:
    """Entries (v, cls, n, len) of values that two classes have, each with its rank from rare to common and `alone`.

    `len` is the number of values that a class retains, `alone` the number of those that it has for itself; these rank first.
    """
    shared = entries.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    own = W.partitionBy("cls")
    found = entries.join(shared, "v").withColumn("alone", F.col("len") - F.count("*").over(own))
    return found.withColumn("rank", F.row_number().over(own.orderBy("df", "v")) + F.col("alone"))


def lists(reps: DataFrame) -> DataFrame:
    """The inverted lists of the sketches: value, class, n, rank, alone, for each class under its rarest shared values."""
    found = _ranked(reps.select("cls", "n", F.size("sketch").alias("len"), F.explode("sketch").alias("v")))
    return found.where(F.col("rank") <= F.col("len") - needed(F.col("n")) + 1).select("v", "cls", "n", "rank", "alone")


def long_lists(sets: DataFrame) -> DataFrame:
    """The same with sketches as long as the sets, so that bounds on ranks hold without a margin."""
    found = _ranked(sets.select("cls", "n", F.col("n").alias("len"), F.explode("members").alias("v")))
    return found.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).select("v", "cls", "n", "rank", "alone")


def _in_size(a: str = "n", b: str = "other_n") -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _fits(a: str = "n", b: str = "other_n", rank_a: str = "rank", rank_b: str = "other_rank") -> Column:
    """Of entries of two long lists: sizes that allow the similarity, and a value early enough in both orders for these sizes.

    The first value that two linked sets share has at least their overlap less one after it in either set.
    """
    overlap = F.ceil((F.col(a) + F.col(b)) * PERCENT / (100 + PERCENT) - 1e-9)
    return _in_size(a, b) & (F.col(rank_a) <= F.col(a) - overlap + 1) & (F.col(rank_b) <= F.col(b) - overlap + 1)


def _pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()


def _with_comp(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return posted.withColumn("comp", F.col("cls"))
    return posted.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))


OTHER = [("cls", "other"), ("n", "other_n"), ("comp", "other_comp"), ("rank", "other_rank")]


def _hub_pairs(now: DataFrame, fits: Column) -> DataFrame:
    """Each entry with its list's hub, the class with the fewest values of its own, if that is of another component."""
    hub = F.min_by(F.struct(*[F.col(c).alias(o) for c, o in OTHER]), F.struct("alone", F.xxhash64("cls")))
    hubs = now.groupBy("v").agg(hub.alias("h")).select("v", "h.*")
    return _pairs(now.join(hubs, "v").where((F.col("comp") != F.col("other_comp")) & fits))


def _spanning_lists(now: DataFrame) -> DataFrame:
    mixed = now.groupBy("v").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("v")
    return now.join(mixed, "v", "left_semi")


def links(docs: DataFrame, reps: DataFrame) -> DataFrame | None:
    """cls and comp for all classes that have a link."""
    posted = stash(lists(reps), "near-lists")
    pairs = stash(_hub_pairs(_with_comp(posted, None), _in_size()), "near-pairs")
    labels = _joined(None, _verified(_likely(pairs, reps), docs))
    # What is left spans components of a list: settled on long lists.
    todo = stash(_spanning_lists(_with_comp(posted, labels)).select("cls").distinct(), "near-todo")
    sets = stash(full_sets(docs, todo), "near-sets")
    posted = stash(long_lists(sets), "near-long-lists")
    pairs = stash(_hub_pairs(_with_comp(posted, labels), _fits()), "near-pairs")
    labels = _joined(labels, _similar(pairs, sets))
    now = stash(_spanning_lists(_with_comp(posted, labels)), "near-now")
    others = now.select("v", *[F.col(c).alias(o) for c, o in OTHER])
    pairs = stash(_pairs(now.join(others, "v").where((F.col("comp") < F.col("other_comp")) & _fits())), "near-pairs")
    return _joined(labels, _similar(pairs, sets))


def _joined(labels: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """The labels after further links."""
    edges = stash(edges, "near-links")
    if edges.isEmpty():
        return labels
    return connected(edges).selectExpr("node AS cls", "comp") if labels is None else _contracted(labels, edges)


def _contracted(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels after further links: these are lifted to components and connected there."""
    lifted = edges
    for side in ("a", "b"):
        lifted = lifted.join(labels.selectExpr(f"cls AS {side}", f"comp AS comp_{side}"), side, "left")
    lifted = lifted.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")).where("a != b")
    top = connected(lifted).selectExpr("node AS comp", "comp AS top")
    lower = labels.join(top, "comp", "left").select("cls", F.coalesce("top", "comp").alias("comp"))
    # Classes that were on their own until now are nodes of `top`, but not of the labels.
    fresh = top.selectExpr("comp AS cls", "top AS comp").join(labels, "cls", "left_anti")
    return stash(lower.unionByName(fresh), "near-labels")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs."""
    slim = stash(sketches(docs), "near-sketches")
    by_crew = slim.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig", "n", "crew").agg(F.min("doc_id").alias("low"))
    by_crew = stash(by_crew, "near-crews")
    classes = by_crew.groupBy("sig", "n").agg(F.min("low").alias("cls"))
    first = classes.select("sig", "n", F.col("cls").alias("doc_id"))
    reps = slim.join(first, ["sig", "n", "doc_id"]).dropDuplicates(["sig", "n", "doc_id"])
    reps = stash(reps.selectExpr("doc_id AS cls", "n", "sketch"), "near-classes")
    labels = links(docs, reps)
    routes = by_crew.select("sig", "n", "crew").join(classes, ["sig", "n"])
    if labels is None:
        routes = routes.withColumn("comp", F.col("cls"))
    else:
        routes = routes.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    rows = slim.select("doc_id", "n", "sig", "crew").join(routes.drop("cls"), ["sig", "n", "crew"], "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs without those that components() does not keep."""
    gone = stash(components(docs).where("NOT kept").select("doc_id").distinct(), "near-dropped")
    return docs.join(maybe_broadcast(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)

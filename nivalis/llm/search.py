"""Ranked lexical search by dense blocked multiplication of integers in float64.

Items (queries) are ranked against all documents by the sum over their terms of an
integer weight times an integer impact. Both are whole numbers, so the sums can be done by
BLAS in float64 as long as no partial sum reaches 2^53: the item vocabulary is
cut into tiles of at most `TILE` terms in which no item's weights add up to more than
2^53 divided by the largest impact; a term too heavy for that alone is spread over several
tiles. Tile products are added up in 64-bit integers.

1. Items are dealt into slices of at most `ITEMS` items and `ENTRIES` terms (or one larger
   item); a slice's terms and weights are all that is broadcast, one slice at a time.
2. One pass over the documents counts terms: per document its length and the counts of
   the slice's terms (stored), per task how many documents hold each term.
3. A second pass takes these counts in blocks of `DOCS` documents, makes dense impact
   tiles of them, multiplies them with the weights and keeps each item's best `k`: a block's scores
   at or above the k-th best so far, equal scores by smaller doc_id. A task emits
   at most k rows per item; they are ranked in crews first, then over all.

Documents are never shuffled, so nothing is skewed by hot terms, sources or copies. At
scale the work is items times documents, as that of any dense product; it is spread over all tasks.

Defined results. Null texts and texts without a term are in no count and no result; an
item without terms has no rows. A null doc_id is ranked after all others of its score.
Rows of documents are documents of their own, repeated or not. All distinct texts of one
item_id (null is one) make up one item; equal rows of the benchmark count once. Empty tables give
no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from nivalis.llm.common import crews, new_folder, running, small, stash, texts

K = 10
ITEMS = 1024
ENTRIES = 1 << 18
TILE = 1024
DOCS = 1024
POSTINGS = 1 << 21  # counts in a block of documents, or those of one document
SCALE = 1_000_000_000
TOP_IMPACT = 1_000_000  # SCALE * tf / (1000 * tf + 8 * m) is below this
MOST = (1 << 53) // TOP_IMPACT

#: Terms are runs of digits, letters and all that is not ASCII; only A-Z are lower-cased. Every other byte is a blank.
TABLE = bytes(b if b >= 128 or re.match(rb"[0-9a-z]", bytes([b])) else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def item_terms(benchmark: DataFrame) -> DataFrame:
    """item_id, term (bytes) and q, its occurrences in the item."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in small(batches):
            words = [terms(t) for t in texts(batch)]
            at = np.repeat(np.arange(len(words)), [len(w) for w in words])
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(at)), pa.array([w for ws in words for w in ws], pa.binary())], ["item_id", "term"])

    once = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    return once.mapInArrow(run, f"item_id {kind}, term binary").groupBy("item_id", "term").agg(F.count("*").alias("q"))


def _slices(entries: DataFrame):
    """Bounded lists of (item, term, q), with the item numbers within the slice, and their ids."""
    sizes = entries.groupBy("item_id").agg(F.greatest(F.count("*"), F.lit(ENTRIES // ITEMS)).alias("size")).withColumn("all", F.lit(0).cast("long"))
    dealt = running(sizes, "all", [F.col("item_id")], "search-slices", "size").select("item_id", F.expr(f"before div {ENTRIES}").alias("slice"))
    both = stash(entries.join(dealt.withColumnRenamed("item_id", "of"), F.col("item_id").eqNullSafe(F.col("of"))).drop("of"), "search-items")
    last = both.agg(F.max("slice")).first()[0]
    for s in range(0 if last is None else last + 1):
        rows = both.where(F.col("slice") == s).select("item_id", "term", "q").collect()
        ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
        number = {i: n for n, i in enumerate(ids)}
        yield ids, sorted((number[r.item_id], bytes(r.term), r.q) for r in rows)


def count_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n, terms and counts of every document that has a term; and rows without n: a task's documents per term."""

    def run(batches):
        known = vocabulary.value
        get, size = known.get, len(known)
        held = np.zeros(size, np.int64)
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]

        def table(ids, *columns):
            return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n", "terms", "counts"])

        for batch in small(batches):
            n, found, counts, at = [], [], [], []
            for i, text in enumerate(texts(batch)):
                words = terms(text)
                if not words:
                    continue
                codes = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
                codes = np.sort(codes[codes >= 0])
                heads = np.flatnonzero(np.concatenate([codes[:1] >= 0, codes[1:] != codes[:-1]]))
                held[codes[heads]] += 1
                at.append(i)
                n.append(len(words))
                found.append(codes[heads])
                counts.append(np.diff(np.concatenate([heads, [len(codes)]])).astype(np.int32))
            yield table(batch.column("doc_id").take(pa.array(at, pa.int64())), n, found, counts)
        there = np.flatnonzero(held).astype(np.int32)
        for start in range(0, len(there), 1 << 16):
            part = there[start : start + (1 << 16)]
            yield table(pa.nulls(1, pa.int64()), [None], [part], [held[part]])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def weight_tiles(entries: list[tuple[int, int, int]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles (columns, items, weights of each, bounds of the columns' entries) of entries (column, item, weight), sorted by column.

    In a tile no item's weights exceed MOST together.
    """
    tiles, columns, held, total = [], [], [], {}

    def close():
        if columns:
            items = np.array([i for part in held for i, _ in part], np.int64)
            weights = np.array([w for part in held for _, w in part], np.float64)
            tiles.append((np.array(columns, np.int64), items, weights, np.cumsum([0, *map(len, held)])))
        columns.clear(), held.clear(), total.clear()

    at = 0
    while at < len(entries):
        column, end = entries[at][0], at
        while end < len(entries) and entries[end][0] == column:
            end += 1
        own = [(i, w) for _, i, w in entries[at:end] if w]
        at = end
        while own:
            part = [(i, min(w, MOST)) for i, w in own]
            if len(columns) == TILE or any(total.get(i, 0) + w > MOST for i, w in part):
                close()
            columns.append(column)
            held.append(part)
            for i, w in part:
                total[i] = total.get(i, 0) + w
            own = [(i, w - MOST) for i, w in own if w > MOST]
    close()
    return tiles


def block_scores(tiles, n_items: int, docs: np.ndarray, columns: np.ndarray, impacts: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores of all items for a block of documents, from their impacts (document, column, impact)."""
    scores = np.zeros((n_items, n_docs), np.int64)
    by = np.argsort(columns, kind="stable")
    docs, columns, impacts = docs[by], columns[by], impacts[by]
    for own, items, weights, bounds in tiles:
        a, b = np.searchsorted(columns, own[0]), np.searchsorted(columns, own[-1], side="right")
        place = np.searchsorted(own, columns[a:b])  # a tile's columns are all that lie between its ends
        impact = np.zeros((len(own), n_docs))
        impact[place, docs[a:b]] = impacts[a:b]
        rows, which = np.unique(items, return_inverse=True)
        weight = np.zeros((len(rows), len(own)))
        weight[which, np.repeat(np.arange(len(own)), np.diff(bounds))] = weights
        scores[rows] += (weight @ impact).astype(np.int64)
    return scores


class Best:
    """The k best (score, doc_id) of each item so far; smaller ids first among equal scores, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)  # below `least` nothing is of interest
        self.rows: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * n_items

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        for i in np.flatnonzero(scores.max(axis=1, initial=0) >= self.least).tolist():
            own = scores[i]
            least = self.least[i]
            if len(own) > self.k:
                least = max(least, np.partition(own, len(own) - self.k)[len(own) - self.k])
            good = np.flatnonzero(own >= least)  # with all ties of the k-th
            score, ident, null = (np.concatenate(x) for x in zip(self.rows[i], (own[good], ids[good], nulls[good])))
            by = np.lexsort((ident, null, -score))[: self.k]
            self.rows[i] = (score[by], ident[by], null[by])
            if len(by) == self.k:
                self.least[i] = score[by][-1]


def _best_of(counted: DataFrame, ids: list, id_type: pa.DataType, schema: str, tiles, totals: tuple[int, int], k: int) -> DataFrame:
    """Each task's best k documents per item: item_id, doc_id, score."""
    n_docs, n_terms = totals
    shared = counted.sparkSession.sparkContext.broadcast((ids, tiles))

    def run(batches):
        own_ids, own_tiles = shared.value
        best = Best(len(own_ids), k)
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            doc, null = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            columns, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
            m = 100 - 75 + (75 * batch.column("n").to_numpy() * n_docs) // n_terms
            at = 0
            while at < batch.num_rows:
                base = ends[at] - sizes[at]
                to = min(at + DOCS, max(at + 1, int(np.searchsorted(ends, base + POSTINGS, side="right"))))
                which = np.repeat(np.arange(to - at), sizes[at:to])
                part = tf[base : ends[to - 1]]
                impacts = (SCALE * part) // (1000 * part + 8 * m[at:to][which])
                best.add(block_scores(own_tiles, len(own_ids), which, columns[base : ends[to - 1]], impacts, to - at), doc[at:to], null[at:to])
                at = to
        found = [(i, *row) for i, rows in enumerate(best.rows) for row in zip(*(c.tolist() for c in rows))]
        item, score, ident, null = list(zip(*found)) or [()] * 4
        names = pa.array([own_ids[i] for i in item], id_type)
        docs = pa.array([None if x else d for d, x in zip(ident, null)], pa.int64())
        yield pa.RecordBatch.from_arrays([names, docs, pa.array(score, pa.int64())], ["item_id", "doc_id", "score"])

    return counted.mapInArrow(run, schema)


def search(docs: DataFrame, benchmark: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    id_type = benchmark.select("item_id").limit(0).toArrow().schema.field(0).type
    schema = f"item_id {kind}, doc_id long, score long"
    folder, made = new_folder(spark, "search-best"), []
    for ids, entries in _slices(stash(item_terms(benchmark), "search-terms")):
        vocabulary: dict[bytes, int] = {}
        for _, term, _ in entries:  # in order of items, so that items have their terms in few tiles
            vocabulary.setdefault(term, len(vocabulary))
        words = spark.sparkContext.broadcast(vocabulary)
        counted = stash(count_terms(docs, words), "search-counts")
        n_docs, n_terms = counted.agg(F.count("n"), F.sum("n")).first()
        if n_docs:
            held = counted.where("n IS NULL").select(F.explode(F.arrays_zip("terms", "counts")).alias("h")).groupBy("h.terms").agg(F.sum("h.counts").alias("df"))
            df = dict(held.collect())  # as many rows as the slice has terms
            weight = {c: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for c, n in df.items()}
            cells = sorted((vocabulary[t], i, q * weight[vocabulary[t]]) for i, t, q in entries if vocabulary[t] in df)
            made.append(f"{folder}/{len(made)}")
            _best_of(counted.where("n IS NOT NULL"), ids, id_type, schema, weight_tiles(cells), (n_docs, n_terms), k).write.parquet(made[-1])
        words.unpersist()
    if not made:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = spark.read.schema(schema).parquet(*made)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    crew = F.pmod(F.xxhash64("doc_id"), F.lit(crews(spark)))
    for key in ([F.col("item_id"), crew], [F.col("item_id")]):
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")

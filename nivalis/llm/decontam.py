"""Benchmark decontamination: a broadcast set of test n-grams against all training windows.

The benchmark's windows (n consecutive words, or a shorter item's all words)
are cut and counted by Spark. They go to the executors as a hash set if they are
at most `SLICE` bytes. A larger benchmark is cut into slices of that size by the
windows' hashes: each slice is broadcast, scanned for, its hits written to the shared
folder, and dropped before the next one, so neither the driver nor a worker ever
holds more than one; at last the hits of equal texts are put together. A scan maps
words to the benchmark's vocabulary, hashes all windows of a chunk of documents at
once, looks the hashes up and verifies every hit word for word. Documents are not
shuffled for one slice; for several, only by the digest of texts that have hits.

Words: runs of [0-9a-z] and non-ASCII characters after lower-casing A-Z.

Defined results. A null or empty text has no words and no hits. An item without
words has no window; a null item_id still marks words but is not listed.
Repeated items count once. An empty benchmark leaves everything clean; an empty
table gives an empty result. Further columns are carried along by clean().
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import chunks, small, stash, texts

N = 10
SLICE = 32 << 20  # bytes of windows and item names

#: Bytes that are no part of a word become spaces, A-Z become a-z.
TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """gram (words joined by a space), its length in words, and the items that have it."""

    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), texts(batch)):
                words = words_of(text)
                size = min(n, len(words))
                rows += [(item, size, b" ".join(words[i : i + size])) for i in range(len(words) - size + 1) if size]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["item", "n", "gram"]
            )

    slim = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(cut, "item string, n int, gram binary").groupBy("gram", "n").agg(F.collect_set("item").alias("items"))


def _hash(ids: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Of every n consecutive ids (64-bit, wrapping)."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15 + 2 * seed) + ids[j : j + len(out)].astype(np.uint64) + np.uint64(1)
            out ^= out >> np.uint64(29)
    return out


def build_index(windows) -> dict:
    """From (gram, n, items) rows: the vocabulary and, by length, sorted hashes with their ids and items."""
    vocabulary: dict[bytes, int] = {}
    by_length: dict[int, list] = defaultdict(list)
    for gram, n, items in windows:
        by_length[n].append(([vocabulary.setdefault(w, len(vocabulary)) for w in bytes(gram).split()], sorted(items)))
    index = {}
    for n, rows in by_length.items():
        ids = np.array([r[0] for r in rows], np.int64).reshape(len(rows), n)
        seed = 0
        while True:  # until no two windows share a hash
            hashes = np.concatenate([_hash(row, n, seed) for row in ids])
            order = np.argsort(hashes)
            if len(np.unique(hashes)) == len(hashes):
                break
            seed += 1
        index[n] = (seed, hashes[order], ids[order], [rows[i][1] for i in order])
    return {"vocabulary": vocabulary, "index": index}


def scan(docs: list[list[bytes]], table: dict):
    """For each document (as words) a mask of hit words, or None, and the set of items with a window in it."""
    get = table["vocabulary"].get
    sizes = np.array([len(d) for d in docs], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.concatenate([np.fromiter(map(get, d, repeat(-1)), np.int64, len(d)) for d in docs]) if docs else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(docs)), sizes)
    masks: list = [None] * len(docs)
    found: list = [set() for _ in docs]
    for n, (seed, hashes, grams, items) in table["index"].items():
        own = _hash(ids, n, seed)
        at = np.searchsorted(hashes, own)
        at[at == len(hashes)] = 0
        hit = np.flatnonzero((hashes[at] == own) & (owner[: len(own)] == owner[n - 1 :]) if len(own) else [])
        if len(hit):  # verify word for word
            hit = hit[(ids[hit[:, None] + np.arange(n)] == grams[at[hit]]).all(axis=1)]
        for i in hit.tolist():
            d = int(owner[i])
            if masks[d] is None:
                masks[d] = np.zeros(sizes[d], bool)
            masks[d][i - starts[d] : i - starts[d] + n] = True
            found[d].update(items[at[i]])
    return masks, found


def _slices(benchmark: DataFrame, n: int, size: int) -> list[DataFrame]:
    """The benchmark's windows in slices of about `size` bytes."""
    windows = stash(benchmark_windows(benchmark, n), "leak-windows")
    width = F.octet_length("gram") + F.aggregate("items", F.lit(0).cast("long"), lambda b, i: b + F.octet_length(i))
    count = max(1, -(-(windows.agg(F.sum(width)).first()[0] or 0) // size))
    part = F.pmod(F.xxhash64("gram"), F.lit(count))
    return [windows.where(part == k) for k in range(count)]


def _shared(windows: DataFrame):
    """A broadcast hash set of one slice."""
    return windows.sparkSession.sparkContext.broadcast(build_index(windows.toLocalIterator()))


def ranges_of(mask: np.ndarray | None) -> list[dict]:
    """The runs of a mask as (start, end), end excluded."""
    if mask is None:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()
    return [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]


def scanned(data: list[bytes], table: dict):
    """Number of words, mask of hit words (or None) and items of each text, by chunks."""
    for start, stop in chunks(data):
        words = [words_of(b) for b in data[start:stop]]
        yield from zip(map(len, words), *scan(words, table))


HITS = "hits array<struct<start:int,end:int>>, items array<string>"
HITS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _hits_by_slices(docs: DataFrame, slices: list[DataFrame]) -> DataFrame:
    """leak_key (a digest of the text), hits and items of all distinct texts with hits, one slice in memory at a time."""
    found = None
    for windows in slices:
        table = _shared(windows)

        def run(batches, table=table):
            for batch in small(batches):
                rows = [(i, ranges_of(mask), sorted(items)) for i, (_, mask, items) in enumerate(scanned(texts(batch), table.value)) if mask is not None]
                at, hits, items = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("leak_key").take(pa.array(at, pa.int64())), pa.array(hits, HITS_TYPE), pa.array(items, pa.list_(pa.string()))],
                    ["leak_key", "hits", "items"],
                )

        own = docs.select(leak_key().alias("leak_key"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
        part = stash(own.mapInArrow(run, f"leak_key string, {HITS}").dropDuplicates(["leak_key"]), "leak-hits")
        table.destroy()
        found = part if found is None else found.unionByName(part)
    # Ranges of several slices may overlap: in order of their starts, each joins the last one that it reaches.
    every = found.groupBy("leak_key").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("h"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    step = """aggregate(h, CAST(array() AS array<struct<start:int,end:int>>), (a, x) -> CASE
        WHEN size(a) > 0 AND x.start <= element_at(a, -1).end
        THEN concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end))))
        ELSE concat(a, array(x)) END)"""
    return every.select("leak_key", F.expr(step).alias("hits"), "items")


def leak_key():
    """What tells texts apart where hits are joined back to them."""
    return F.sha2(F.col("text").cast("binary"), 256)


def cut_spans(text: bytes, mask: np.ndarray) -> bytes:
    """The text without its hit words and what stands between neighbouring ones."""
    ends = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(TABLE))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    out, at = [], 0
    for first, after in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out.append(text[at : ends[first][0]])
        at = ends[after - 1][1]
    return b"".join([*out, text[at:]])


def find(docs: DataFrame, benchmark: DataFrame, n: int = N, slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, n_words, hits (ranges of word positions, end excluded) and items (sorted) for every row of docs."""
    slices = _slices(benchmark, n, slice_bytes)
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long"
    if len(slices) > 1:
        sizes = own.withColumn("leak_key", leak_key()).mapInArrow(_word_counts, f"{kind}, leak_key string")
        none = (F.expr("CAST(array() AS array<struct<start:int,end:int>>)"), F.expr("CAST(array() AS array<string>)"))
        rows = sizes.join(_hits_by_slices(docs, slices), "leak_key", "left")
        return rows.select("doc_id", "n_words", *[F.coalesce(c, x).alias(c) for c, x in zip(("hits", "items"), none)])
    table = _shared(slices[0])

    def run(batches):
        for batch in small(batches):
            sizes, masks, items = list(zip(*scanned(texts(batch), table.value))) or [(), (), ()]
            arrays = [pa.array(sizes, pa.int64()), pa.array(map(ranges_of, masks), HITS_TYPE), pa.array(map(sorted, items), pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_words", "hits", "items"])

    return own.mapInArrow(run, f"{kind}, {HITS}")


def _word_counts(batches):
    for batch in small(batches):
        sizes = [len(words_of(t)) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), batch.column("leak_key")], ["doc_id", "n_words", "leak_key"])


def without_spans(text: bytes, hits: list) -> bytes:
    """The text without the words in `hits` (ranges) and what stands between neighbouring ones."""
    mask = np.zeros(len(words_of(text)), bool)
    for h in hits:
        mask[h["start"] : h["end"]] = True
    return cut_spans(text, mask)


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "drop", n: int = N, slice_bytes: int = SLICE) -> DataFrame:
    """The rows of docs without contaminated documents (mode "drop") or without the hit spans (mode "spans")."""
    if mode not in ("drop", "spans"):
        raise ValueError("mode is drop or spans")
    slices = _slices(benchmark, n, slice_bytes)
    if len(slices) > 1:
        found = _hits_by_slices(docs, slices)
        keyed = docs.select(F.struct(*docs.columns).alias("doc"), leak_key().alias("leak_key"))
        if mode == "drop":
            return keyed.join(found, "leak_key", "left_anti").select("doc.*")
        hits_name = _free(docs.columns, "hits")
        rows = keyed.join(found, "leak_key", "left").select("doc.*", F.col("hits").alias(hits_name))
    else:
        table, rows, hits_name = _shared(slices[0]), docs, None

    def run(batches):
        for batch in small(batches):
            data = texts(batch)
            if hits_name is None:
                hits = [ranges_of(mask) for _, mask, _ in scanned(data, table.value)]
            else:
                hits = batch.column(hits_name).to_pylist()
                batch = batch.drop_columns([hits_name])
            if mode == "drop":
                yield batch.filter(pa.array([not h for h in hits], pa.bool_()))
                continue
            at, old = batch.schema.get_field_index("text"), batch.column("text")
            new = [None if gone else (without_spans(b, h) if h else b).decode() for gone, b, h in zip(old.is_null().to_pylist(), data, hits)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, old.type))

    return rows.mapInArrow(run, docs.schema)


def _free(columns: list[str], name: str) -> str:
    """The name, with underscores in front until no column has it."""
    while name in columns:
        name = "_" + name
    return name

"""Removal of repeated byte strings, by deep-shallow suffix sorting of candidate suffixes.

Every byte covered by a string of `LENGTH` bytes that also starts earlier (in a
document with a smaller id, or earlier in the same document) is removed. All
strings are judged on the input; overlaps count.

1. Candidates. A window of LENGTH bytes has as its key the smallest hash of its
   `GRAM`-byte strings, so equal windows have equal keys. Consecutive windows of
   one key form a segment (about 3 for 100 bytes). Segments whose key occurs
   once, and only once within itself, hold nothing that repeats.
2. The bytes of all other segments are brought together by key and sorted deep-shallow: the
   suffixes at their starts first (multikey quicksort, 8 bytes being one character, to a depth
   of `SHALLOW` bytes, and blind tries for the groups that still agree), then those at
   their ends, which tells equal segments; all but the earliest of these are removed. Of
   keys that have several different segments, the suffixes at all window starts of the
   earliest ones are sorted likewise. Suffixes that agree over LENGTH bytes are compared
   byte for byte there; all but the earliest are removed. Many keys are sorted together, each
   step of the sort as one array operation.
3. A key's suffixes are sorted in one task. A key with more than `MANY` segments, such as
   that of a line common to all documents, is sorted in crews first. What is left of it is
   split into windows, these by their outer bytes, and sorted in crews and then once more
   over all crews; so no group grows with the data.
4. Removed ranges are merged per document and cut out.

Defined results. A null text is empty. Documents without an id come after all
others. If ids repeat, different texts of one id are documents of their own, in
the order of their hashes; equal rows are one document, searched once, and treated alike:
what one of them keeps, each of them keeps. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import crews, small, stash, text_bytes, texts

LENGTH = 100
GRAM = 32
SHALLOW = 24
MANY = 1 << 16
OUTER = 16
LONGEST = 200  # windows in a segment
TOGETHER = 1 << 16  # suffixes sorted together, if their keys allow
STEP = 1 << 15  # strings compared at a time
PIECE = 1 << 20
CHUNK = 1 << 18
LAST = (1 << 63) - 1
BASE = 0x9E3779B97F4A7C15
ROW = ["doc_id", "tie"]


class Hashes:
    """Polynomial hashes modulo 2^64 of substrings, from running sums over a buffer."""

    tables: list = []

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if not self.tables or len(self.tables[0]) < n:
            size, made = max(n, CHUNK * 2), []
            for b in (BASE, pow(BASE, -1, 1 << 64)):
                table = np.full(size, b, np.uint64)
                table[0] = 1
                made.append(np.multiply.accumulate(table))
            Hashes.tables = made
        up, self.down = self.tables
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def every(self, n: int) -> np.ndarray:
        """Of all substrings of n bytes."""
        count = len(self.sums) - n
        return mixed((self.sums[n:] - self.sums[:count]) * self.down[:count])


def mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every `width` consecutive values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def segments(pieces: list[bytes]):
    """For texts laid end to end: key, whether it repeats inside, piece, start and number of windows of each segment."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, np.zeros(0, bool), none, none, none
    width = LENGTH - GRAM + 1
    grams = Hashes(data).every(GRAM)
    low = sliding(grams, width, np.minimum)  # of the window at each start
    ends = np.cumsum(sizes)
    begins = ends - sizes
    bad = np.zeros(len(low), bool)
    cut = np.zeros(len(low) + 1, bool)
    for b, e in zip(begins.tolist(), ends.tolist()):
        bad[max(b, e - LENGTH + 1) : e] = True
        cut[min(b, len(low))] = True
    # A gram is some window's smallest if it equals the largest such value around it; equal neighbours repeat.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), np.where(bad, np.uint64(0), low), np.zeros(width - 1, np.uint64)])
    anchors = grams[grams == sliding(padded, width, np.maximum)]
    repeated = np.unique(anchors[1:][anchors[1:] == anchors[:-1]])
    cut[0] = True
    cut[1:-1] |= (low[1:] != low[:-1]) | (bad[1:] != bad[:-1])
    starts = np.flatnonzero(cut[:-1])
    counts = np.diff(np.concatenate([starts, [len(low)]]))
    keep = ~bad[starts]
    starts, counts = starts[keep], counts[keep]
    if len(counts) and counts.max() > LONGEST:
        parts = -(-counts // LONGEST)
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, counts = np.repeat(starts, parts) + at * LONGEST, np.minimum(LONGEST, np.repeat(counts, parts) - at * LONGEST)
    key = low[starts]
    inside = np.isin(key, repeated) if len(repeated) else np.zeros(len(key), bool)
    owner = np.searchsorted(ends, starts, side="right")
    return key.view(np.int64), inside, owner, starts - begins[owner], counts


def _rows(docs: DataFrame, unique: bool) -> DataFrame:
    """doc_id, a tie-breaker (0 where ids are unique) and the text's bytes."""
    own = text_bytes()
    tie = F.lit(0).cast("long") if unique else F.xxhash64(own)
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), tie.alias("tie"), own.alias("text"))


def _pieces(batches):
    """Lists of (row, offset, bytes) of about CHUNK bytes; long texts in pieces that overlap by a window less a byte."""
    for batch in batches:
        pieces, held = [], 0
        for i, text in enumerate(batch.column("text")):
            text = text.as_py()
            for at in range(0, max(1, len(text) - LENGTH + 1), PIECE):
                pieces.append((i, at, text[at : at + PIECE + LENGTH - 1]))
                held += len(pieces[-1][2])
                if held >= CHUNK:
                    yield batch, pieces
                    pieces, held = [], 0
        if pieces:
            yield batch, pieces


def _key_rows(rows: DataFrame) -> DataFrame:
    """key and inside of every segment, to be counted."""

    def run(batches):
        for _, pieces in _pieces(batches):
            key, inside, *_ = segments([p[2] for p in pieces])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(inside)], ["key", "inside"])

    return rows.select("text").mapInArrow(run, "key long, inside boolean")


def _segment_rows(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch, pieces in _pieces(batches):
            ids, ties = batch.column("doc_id").to_numpy(), batch.column("tie").to_numpy()
            which, at = np.array([p[0] for p in pieces], np.int64), np.array([p[1] for p in pieces], np.int64)
            key, _, owner, start, n = segments([p[2] for p in pieces])
            doc = which[owner]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, ids[doc], ties[doc], at[owner] + start, n.astype(np.int32))], ["key", "doc_id", "tie", "start", "n"])

    return rows.mapInArrow(run, "key long, doc_id long, tie long, start long, n int")


def _regrouped(places: np.ndarray, heads: np.ndarray, *columns) -> np.ndarray:
    """New group heads of sorted places: a group starts where the old head or one of the columns changes."""
    new = np.ones(len(places), bool)
    new[1:] = heads[1:] != heads[:-1]
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return places[np.flatnonzero(new)[np.cumsum(new) - 1]]


def _open_places(heads: np.ndarray, done: np.ndarray) -> np.ndarray:
    """Places in groups of two and more that are not known to be equal."""
    follows = np.zeros(len(heads), bool)
    follows[1:] = heads[1:] == heads[:-1]
    several = follows.copy()
    several[:-1] |= follows[1:]
    return np.flatnonzero(several & ~done)


def deep_shallow(data: np.ndarray, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the strings of LENGTH bytes at `at` by key and bytes: their order, and for each place the head of its group of equal strings.

    Down to SHALLOW bytes each step is a step of multikey quicksort for all open groups at
    once. Then each group grows a blind trie: its first string is a leaf, every other one is
    compared with that leaf once, and those that leave it at the same depth by the same byte
    are below one new node, whose strings go on in the same way.
    """
    order = np.argsort(keys, kind="stable")
    places = np.arange(len(at))
    heads = _regrouped(places, keys[order]) if len(at) else places
    done = np.zeros(len(at), bool)
    if not len(at):
        return order, heads
    strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    for depth in range(0, SHALLOW, 8):
        live = _open_places(heads, done)
        items = order[live]
        word = np.ascontiguousarray(strings[:, depth : depth + 8][at[items]]).view(">u8")[:, 0].astype(np.uint64)
        by = np.lexsort((word, heads[live]))
        order[live] = items[by]
        heads[live] = _regrouped(live, heads[live], word[by])
    while len(live := _open_places(heads, done)):
        items, leaf = order[live], order[heads[live]]
        depth, byte, side = (np.concatenate(x) for x in zip(*(_branches(strings, at[items[i : i + STEP]], at[leaf[i : i + STEP]]) for i in range(0, len(live), STEP))))
        by = np.lexsort((byte, -side * depth, side, heads[live]))
        order[live] = items[by]
        heads[live] = _regrouped(live, heads[live], side[by], depth[by], byte[by])
        done[live] = side[by] == 0
    return order, heads


def _branches(strings: np.ndarray, at: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each string leaves the leaf of its trie: depth, byte and side (-1 before it, 1 after it, 0 equal)."""
    own, other = strings[:, SHALLOW:][at], strings[:, SHALLOW:][leaf]
    differs = own != other
    depth = differs.argmax(1)
    rows = np.arange(len(at))
    byte, of_leaf = own[rows, depth].astype(np.int64), other[rows, depth].astype(np.int64)
    side = np.sign(byte - of_leaf)
    byte[side == 0] = 0
    return depth, byte, side


def repeats(data: np.ndarray, at: np.ndarray, keys: np.ndarray, place: tuple) -> np.ndarray:
    """For each string of LENGTH bytes: whether an equal one of its key has an earlier place (doc_id, tie, start)."""
    order, heads = deep_shallow(data, at, keys)
    sizes = np.bincount(heads, minlength=len(heads))[heads]
    several = order[sizes > 1]
    by = np.lexsort((*(p[several] for p in reversed(place)), heads[sizes > 1]))
    group = heads[sizes > 1][by]
    later = np.zeros(len(at), bool)
    later[several[by[1:]]] = group[1:] == group[:-1]
    return later


def equal_segments(data: np.ndarray, begins: np.ndarray, n: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Numbers of the segments (n windows each, n + LENGTH - 1 bytes) that are equal for equal segments of one key.

    Sorted at their starts, then, where one window does not cover them, at their ends and in between.
    """
    by = np.lexsort((n, keys))
    same = np.empty(len(n), np.int64)
    same[by] = _regrouped(np.arange(len(n)), keys[by], n[by])
    steps = [np.zeros(len(n), np.int64), n - 1, *(np.where(n - 1 > t, t, 0) for t in range(LENGTH, int(n.max(initial=1)) - 1, LENGTH))]
    for k, offset in enumerate(steps):
        rows = np.flatnonzero(offset > 0) if k else np.arange(len(n))
        order, heads = deep_shallow(data, (begins + offset)[rows], same[rows])
        same[rows[order]] = heads + (k + 1) * len(n)
    return same


def firsts(same: np.ndarray, place: tuple) -> np.ndarray:
    """Whether each row is the earliest one of those with its number."""
    by = np.lexsort((*reversed(place), same))
    first = np.ones(len(by), bool)
    first[by[1:]] = same[by[1:]] != same[by[:-1]]
    return first


def merged_ranges(doc: np.ndarray, tie: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """doc_id, tie, from, to of the runs that strings of LENGTH bytes at these places cover."""
    by = np.lexsort((at, tie, doc))
    doc, tie, at = doc[by], tie[by], at[by]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] > at[:-1] + LENGTH)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]])[: len(first)] - 1
    return [doc[first], tie[first], at[first], at[last] + LENGTH]


def _whole_keys(batches, key: str, size):
    """Tables of whole keys, of rows sorted by key; about TOGETHER suffixes each, or one key."""
    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        if held and held[-1].column(key)[-1].as_py() == keys[0]:
            starts = starts[1:]
        done = np.concatenate([[0], np.cumsum(size(batch))])
        at, base = 0, count
        for s in starts.tolist():
            if base + done[s] - done[at] >= TOGETHER:
                yield pa.Table.from_batches([*held, batch.slice(at, s - at)])
                held, at, base = [], s, 0
        if at < batch.num_rows:
            held.append(batch.slice(at))
            count = base + done[-1] - done[at]
    if held:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _segment_bytes(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """The segments with their bytes."""
    per_doc = shared.groupBy(*ROW).agg(F.collect_list(F.struct("key", "many", "inside", "start", "n")).alias("cuts"))
    out = ["key", "many", "inside", "bytes", "doc_id", "tie", "start", "n"]

    def run(batches):
        for batch in small(batches, 1 << 20):
            texts_, cuts = batch.column("text").to_pylist(), batch.column("cuts")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(cuts.offsets.to_numpy()))
            key, many, inside, start, n = cuts.flatten().flatten()
            data = [texts_[d][a:b] for d, a, b in zip(doc.tolist(), start.to_pylist(), (start.to_numpy() + n.to_numpy() + LENGTH - 1).tolist())]
            ids = [pa.array(batch.column(c).to_numpy()[doc]) for c in ROW]
            yield pa.RecordBatch.from_arrays([key, many, inside, pa.array(data, pa.binary()), *ids, start, n], out)

    return rows.join(per_doc, ROW).mapInArrow(run, "key long, many boolean, inside boolean, bytes binary, doc_id long, tie long, start long, n int")


PARTS = "doc_id long, tie long, `from` long, `to` long, key long, bytes binary"  # bytes: of what is not settled yet


def _settled(table: pa.Table):
    """Ranges to be removed from whole keys, and the segments of crews that are still to be held against those of other crews."""
    n = _column(table, "n").astype(np.int64)
    data, begins = _laid_out(table, n)
    key, many = _column(table, "group"), _column(table, "many")
    doc, tie, start = place = tuple(_column(table, c) for c in ("doc_id", "tie", "start"))
    same = equal_segments(data, begins, n, key)
    first = firsts(same, place)
    found = [(doc[~first], tie[~first], start[~first], (start + n)[~first] + LENGTH - 1)]
    # Windows of different segments of a key, and of segments that repeat inside.
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    kinds, inside = np.add.reduceat(first.astype(np.int64), edges[:-1]), np.logical_or.reduceat(_column(table, "inside"), edges[:-1])
    several = np.repeat((kinds > 1) | inside, np.diff(edges))
    rows = np.flatnonzero(first & ~many & several)
    runs = np.flatnonzero(np.concatenate([[True], key[rows][1:] != key[rows][:-1]])) if len(rows) else rows
    before = (np.cumsum(n[rows]) - n[rows])[runs] // TOGETHER
    starts = [0, *runs[1:][before[1:] != before[:-1]].tolist(), len(rows)]
    for a, b in zip(starts, starts[1:]):
        part = rows[a:b]
        row = np.repeat(part, n[part])
        t = np.arange(len(row)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        later = repeats(data, begins[row] + t, key[row], (doc[row], tie[row], start[row] + t))
        found.append(merged_ranges(doc[row][later], tie[row][later], (start[row] + t)[later]))
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(np.concatenate(c)) for c in zip(*found)), *(pa.nulls(sum(len(f[0]) for f in found), k) for k in (pa.int64(), pa.binary()))], ["doc_id", "tie", "from", "to", "key", "bytes"]
    )
    rest = table.filter(pa.array(first & many)).select(["doc_id", "tie", "start", "n", "key", "bytes"])
    end = pa.array(_column(rest, "start") + _column(rest, "n") + LENGTH - 1)
    yield from rest.set_column(3, "to", end).rename_columns(["doc_id", "tie", "from", "to", "key", "bytes"]).to_batches()


def _laid_out(table: pa.Table, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows end to end, and where each row's begin."""
    data = np.frombuffer(b"".join(v for c in table.column("bytes").chunks for v in c.to_pylist()), np.uint8)
    return data, np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)


def _window_ranges(rest: DataFrame, parts: int) -> DataFrame:
    """Of keys of very many segments: each window under a finer key, sorted in crews, then the first ones of the crews."""
    names = ["fine", "bytes", "doc_id", "tie", "start"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    schema = "fine long, bytes binary, doc_id long, tie long, start long"

    def windows(batches):
        for batch in small(batches, 1 << 17):
            rows = []
            for key, data, doc, tie, start in zip(*(batch.column(c).to_pylist() for c in ("key", "bytes", "doc_id", "tie", "from"))):
                for t in range(len(data) - LENGTH + 1):
                    w = data[t : t + LENGTH]
                    outer = hashlib.blake2b(key.to_bytes(8, "little", signed=True) + w[:OUTER] + w[-OUTER:], digest_size=8).digest()
                    rows.append((int.from_bytes(outer, "little", signed=True), w, doc, tie, start + t))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)], names)

    def sort(batches):
        for table in _whole_keys(batches, "group", lambda batch: np.ones(batch.num_rows, np.int64)):
            data, at = _laid_out(table, np.ones(table.num_rows, np.int64))
            later = repeats(data, at, _column(table, "group"), tuple(_column(table, c) for c in ("doc_id", "tie", "start")))
            yield from table.append_column("later", pa.array(later)).select([*names, "later"]).to_batches()

    def turn(rows: DataFrame, *salt: Column) -> DataFrame:
        grouped = rows.withColumn("group", F.xxhash64("fine", *salt)).repartition("group").sortWithinPartitions("group")
        return stash(grouped.mapInArrow(sort, f"{schema}, later boolean"), "suffix-windows")

    crew = turn(rest.mapInArrow(windows, schema), F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
    last = turn(crew.where("NOT later").drop("later"))
    return crew.union(last).where("later").selectExpr("doc_id", "tie", "start AS `from`", f"start + {LENGTH} AS `to`")


def ranges(rows: DataFrame) -> DataFrame:
    """doc_id, tie, from, to: all ranges to be removed, not yet merged."""
    keys = _key_rows(rows).groupBy("key").agg(F.count("*").alias("times"), F.max("inside").alias("inside")).where("times > 1 OR inside")
    shared = _segment_rows(rows).join(keys.select("key", "inside", (F.col("times") > MANY).alias("many")), "key")
    cut = _segment_bytes(rows, stash(shared, "suffix-segments"))
    parts = crews(rows.sparkSession)
    crew = F.when(F.col("many"), F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
    grouped = cut.withColumn("group", F.xxhash64("key", crew)).repartition("group").sortWithinPartitions("group", "key")

    def sort(batches):
        for table in _whole_keys(batches, "group", lambda batch: batch.column("n").to_numpy() // 8 + 1):
            yield from _settled(table)

    found = stash(grouped.mapInArrow(sort, PARTS), "suffix-sorted")
    rest, done = found.where("bytes IS NOT NULL"), found.where("bytes IS NULL").select("doc_id", "tie", "from", "to")
    return done if rest.isEmpty() else done.unionByName(_window_ranges(rest, parts))


def merge(spans: list) -> list[tuple[int, int]]:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _merged(found: DataFrame) -> DataFrame:
    """Each document's ranges as an array of maximal runs."""
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def run(batches):
        for batch in batches:
            spans = [[{"from": a, "to": b} for a, b in merge([(s["from"], s["to"]) for s in x])] for x in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(spans, kind)], [*ROW, "spans"])

    per_doc = found.groupBy(*ROW).agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    return per_doc.mapInArrow(run, "doc_id long, tie long, spans array<struct<`from`:long,`to`:long>>")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (from, to; in bytes, the removed runs) and kept (the remaining bytes) for every row."""
    ids = docs.select("doc_id").groupBy("doc_id").count()
    unique = ids.where("count > 1").isEmpty()
    rows = _rows(docs, unique)
    # Of equal rows one is searched, else each would count as the other's earlier copy.
    per_doc = stash(_merged(ranges(rows if unique else rows.dropDuplicates(ROW))), "suffix-ranges")
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def run(batches):
        for batch in batches:
            spans, kept, sizes = [], [], []
            for text, found in zip(texts(batch), batch.column("spans").to_pylist()):
                merged = [(s["from"], s["to"]) for s in found or ()]
                parts, at = [], 0
                for a, b in merged:
                    parts.append(text[at:a])
                    at = b
                sizes.append(len(text))
                kept.append(b"".join([*parts, text[at:]]))
                spans.append([{"from": a, "to": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
            )

    out = rows.join(per_doc, ROW, "left").select("doc_id", "text", "spans")
    out = out.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<`from`:long,`to`:long>>, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))

"""The prefix trie against plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from nivalis.llm import common, prefixes
from pyspark.sql import functions as F

KIND = "conv_id long, turn long, role string, text string, name string, depth int, row int, before long"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], KIND)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def sequences(rows):
    by_conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by_conv[c].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    return {c: [t[-1] for t in sorted(ts)] for c, ts in by_conv.items()}


def rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = seqs.get(c - int(c - 5 * int(c / 5)), [])
        out[c] = base[:h] + own[h:]
    return out


def brute(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(seqs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def talk(rng, n, start=()):
    return [*start, *(("user" if i % 2 else "bot", rng.choice("abc") * rng.randint(0, 3) + "é") for i in range(n))]


@pytest.fixture(scope="module")
def rows():
    """Short and long conversations with common beginnings, of exactly 64 and 128 turns too; null turns, roles, texts and ids; ties; repeated rows."""
    rng = random.Random(2)
    long = talk(rng, 300)
    seqs = {c: talk(rng, rng.randint(1, 7)) for c in range(-9, 40)}
    for i, n in enumerate([63, 64, 65, 127, 128, 129, 200, 256, 300, 300]):
        seqs[50 + i] = long[:n]
    seqs[60], seqs[65] = long[:130] + talk(rng, 70), long[:64] + talk(rng, 3)
    seqs |= {70 + i: talk(rng, 1, seqs[3]) for i in range(20)} | {100 + i: seqs[5] for i in range(30)}
    out = [(c, i, *t) for c, s in seqs.items() for i, t in enumerate(s)]
    out += [(3, None, None, None), (4, 1, "user", "tie"), (4, 1, "bot", "tie"), (4, 1, "bot", "tie"), (None, 1, "user", "x"), (201, 1, None, "")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("span", [1 << 12, 3])
def test_rebuilt_trie(spark, rows, monkeypatch, span):
    monkeypatch.setattr(prefixes, "SPAN", span)
    monkeypatch.setattr(prefixes, "PIECE", 2 * span)
    assert got(prefixes.rebuilt_trie(conversations(spark, rows))) == brute(rebuilt(sequences(rows)))


def test_trie_of_conversations_as_they_are(spark, rows):
    assert got(prefixes.conversation_trie(conversations(spark, rows))) == brute(sequences(rows))


def test_no_conversations_and_turnless_ones(spark):
    assert got(prefixes.rebuilt_trie(conversations(spark, []))) == []
    assert got(prefixes.rebuilt_trie(conversations(spark, [(None, 1, "a", "b")]))) == []
    alone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    some = [(alone, 1, "user", "gone")]
    assert got(prefixes.rebuilt_trie(conversations(spark, some))) == brute(rebuilt(sequences(some)))


def test_running_totals_over_groups_of_all_sizes(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.randint(0, 9)) for g, n in ((-4, 1), (0, 2000), (1, 3), (7, 500), (8, 1)) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, i int, v int")
    for value in (None, "v"):
        found = common.running(df, "g", [F.col("i")], "test", value)
        assert sorted(found.columns) == sorted([*df.columns, "before"])
        sums = defaultdict(int)
        expected = {}
        for g, i, v in sorted(rows):
            expected[g, i] = sums[g]
            sums[g] += 1 if value is None else v
        assert {(r.g, r.i): r.before for r in found.collect()} == expected
    assert common.running(df.where("g > 99"), "g", [F.col("i")], "test").count() == 0

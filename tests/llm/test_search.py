"""Ranked search against plain loops over Python integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from nivalis.llm import search


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    counts = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for item, text in set(items):
        wanted.setdefault(item, Counter()).update(words(text))
    out = []
    for item, q in wanted.items():
        found = []
        for i, c, n in counts:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, r in q.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    """Many ties and copies, a third of all rows of one text, empty, null and long texts, null ids, repeated rows, an item of two texts."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "xyzé" for b in range(60)] + ["Straße", "NAÏVE", "ſ", "İx"]
    text = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, text(rng.randint(1, 40))) for i in range(120)]
    docs += [(1000 + i, docs[5][1]) for i in range(80)] + [(i, docs[i][1]) for i in (3, 3, 4)]
    docs += [(300, None), (301, ""), (302, " .,!_"), (None, docs[5][1]), (None, text(9)), (303, text(4000)), (304, docs[7][1].upper())]
    items = [(i, text(rng.randint(1, 30))) for i in range(25)] + [(5, docs[5][1]), (50, None), (51, "?!"), (None, "x1 y2 x1"), (52, "nowhere"), (53, "x1 " * 500), (3, docs[3][1]), (3, docs[3][1])]
    rng.shuffle(docs)
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, term int, score int, rank int").repartition(5),
        spark.createDataFrame([(*i, 4, 5) for i in items], "item_id long, text string, q int, doc_id int"),
    )


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, tables, monkeypatch, small):
    if small:  # many slices, tiles and blocks, and weights that are spread over tiles
        for name, value in {"ITEMS": 4, "ENTRIES": 64, "TILE": 5, "DOCS": 7, "POSTINGS": 50, "MOST": 4000}.items():
            monkeypatch.setattr(search, name, value)
    found = search.search(*frames(spark, *tables))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(*tables)


def test_search_without_documents_items_or_terms(spark):
    for docs, items in (([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)]), ([(1, "a")], [(1, "b")])):
        assert search.search(*frames(spark, docs, items)).count() == 0
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert [(r.item_id, r["rank"], r.doc_id) for r in search.search(docs, items).collect()] == [("i", 1, 1)]


def test_no_partial_sum_can_reach_the_limit_of_doubles():
    rng = random.Random(1)
    cells = sorted((c, i, rng.choice([5, 10**6, 28_000 * 400_000, 10**11])) for c in range(300) for i in rng.sample(range(20), 7))
    tiles = search.weight_tiles(cells)
    back = Counter()
    for columns, items, weights, bounds in tiles:
        assert len(columns) <= search.TILE and len(set(columns.tolist())) == len(columns)
        per_item = Counter()
        for at, column in enumerate(columns.tolist()):
            for i, w in zip(items[bounds[at] : bounds[at + 1]].tolist(), weights[bounds[at] : bounds[at + 1]].tolist()):
                per_item[i] += int(w)
                back[column, i] += int(w)
        assert max(per_item.values()) * search.TOP_IMPACT <= 1 << 53
    assert back == {(c, i): w for c, i, w in cells}
    docs, columns = np.repeat(np.arange(4), 300), np.tile(np.arange(300), 4)
    impacts = np.array([rng.randrange(search.TOP_IMPACT) for _ in docs])
    scores = search.block_scores(tiles, 20, docs, columns, impacts, 4)
    for i in range(20):
        for d in range(4):
            assert int(scores[i, d]) == sum(w * int(impacts[300 * d + c]) for c, j, w in cells if j == i)

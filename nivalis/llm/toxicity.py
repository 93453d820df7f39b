"""Toxicity by maximum-scoring segments.

Learning (only rows outside the held-out fold; one row of each distinct text):
document frequencies of words and of word beginnings are counted by label;
each gets a log-odds ratio under an informative Dirichlet prior (its own overall
frequency, `PRIOR` times the number of documents), less one standard deviation.
Terms for which that leaves at least `ODDS_MIN` form the model, all of them; weaker
ones mostly tell topics and copied texts. A term of fewer than a handful of labelled
documents never gets there, so the model is much smaller than the labelled texts.

Scoring: a word's score is that of its strongest term less a drift that makes
the expected score negative. A linear-time scan finds all maximal
scoring segments of the whole text. Under clean text the best of n words
follows an extreme-value law, P(S > s) = 1 - exp(-K n e^(-lambda s)); lambda
solves E[e^(lambda s)] = 1 on clean words and K is its maximum-likelihood value,
both from clean documents of another fold. A document's evidence is the sum of
lambda s - ln(K n) over its significant segments; a logistic curve fitted on that
fold turns it into a probability.

What leaves the executors is bounded: the terms of the model, two histograms,
and the labelled ids, of which at most `MAX_LABELLED` (chosen by hash) are used.

Defined results. A null or empty text has no words and gets the curve's lowest
score. Without labels of both kinds the score is the share of toxic labels (0
without any). Several labels of a document count as toxic if one is. Rows with a
null doc_id are scored, not learned from. An empty table gives an empty result;
further columns are ignored by score() and carried by keep_clean().
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import bounded_sample, chunks, fold, held_out, small, texts
from nivalis.llm.decontam import words_of

MAX_LABELLED = 200_000
PRIOR = 0.005
ODDS_MIN = 1.5
DRIFT = 0.25
THRESHOLD = 0.3
BIN = 0.1


@dataclass
class Model:
    terms: dict = field(default_factory=dict)  # term -> log-odds less one standard deviation
    lam: float = 1.0
    k: float = 1.0
    a: float = 0.0
    b: float = 0.0


def terms_of(word: bytes) -> tuple[bytes, ...]:
    """The word itself and its beginnings of 4 to 8 characters, marked by a star."""
    s = word.decode(errors="replace")
    return (word, *((s[:n] + "*").encode() for n in range(4, min(9, len(s)))))


class WordScores(dict):
    """Scores of words, worked out once each; emptied when large."""

    def __init__(self, terms: dict):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: bytes) -> float:
        if len(self) > 150_000:
            self.clear()
        score = self[word] = max((self.terms.get(t, 0.0) for t in terms_of(word))) - DRIFT
        return score


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), end excluded, in linear time.

    Candidates are kept as (start, end, sum before, sum through, link), the link
    being the last earlier candidate that began from a lower sum; a new one either
    stands alone or swallows back to its own link, if that ended lower.
    """
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, end, left, right = i, i + 1, before, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((start, end, left, right, j))
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right, _ in found]


def _learning_rows(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """doc_id, toxic and fold of at most `limit` labelled rows with distinct texts."""
    told = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    told = told.where(~held_out(F.col("doc_id")))
    ids = docs.select("doc_id", F.xxhash64("text").alias("h")).join(told, "doc_id")
    once = ids.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").cast("int").alias("toxic"))
    return bounded_sample(once.select("doc_id", "toxic"), F.col("doc_id"), limit)


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    rows = _learning_rows(docs, labels, max_labelled).collect()  # two numbers for each of at most max_labelled rows
    sizes = Counter(int(r.toxic) for r in rows)
    if not sizes[0] or not sizes[1]:
        share = min(max(sizes[1] / max(1, len(rows)), 1e-6), 1 - 1e-6)
        return Model(a=math.log(share / (1 - share)))
    spark = docs.sparkSession
    sample = spark.createDataFrame([(r.doc_id, int(r.toxic)) for r in rows], "doc_id long, toxic int")
    own = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    own = own.select("toxic", "text", (fold(F.col("doc_id")) == 3).alias("calibrates"))
    terms = _terms(own.where("NOT calibrates"))
    model = Model(terms=terms)
    _calibrate(own.where("calibrates"), model)
    return model


def _terms(own: DataFrame) -> dict:
    def count(batches):
        for batch in small(batches):
            data, labels = texts(batch), batch.column("toxic").to_pylist()
            for start, stop in chunks(data):
                by_label = (Counter(), Counter())
                for toxic, text in zip(labels[start:stop], data[start:stop]):
                    by_label[toxic].update({t for w in set(words_of(text)) for t in terms_of(w)})
                keys = list(by_label[0].keys() | by_label[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), *(pa.array([c[k] for k in keys], pa.int64()) for c in by_label)], ["term", "clean", "toxic"]
                )

    n = {r.toxic: r.n for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = n.get(0, 0), n.get(1, 0)
    a0 = PRIOR * (n_clean + n_toxic)
    counts = own.mapInArrow(count, "term binary, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    a = F.lit(PRIOR) * (F.col("clean") + F.col("toxic"))
    odds = F.log((F.col("toxic") + a) / (n_toxic + a0 - F.col("toxic") - a + 1e-9)) - F.log(
        (F.col("clean") + a) / (n_clean + a0 - F.col("clean") - a + 1e-9)
    )
    sure = odds - F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a))
    kept = counts.select("term", sure.alias("odds")).where(F.col("odds") >= ODDS_MIN)
    return {bytes(r.term): r.odds for r in kept.collect()}


def _calibrate(own: DataFrame, model: Model) -> None:
    """Sets lambda and K from clean documents, then the logistic curve from all."""
    terms = own.sparkSession.sparkContext.broadcast(model.terms)

    def histogram(batches):
        scores = WordScores(terms.value)
        for batch in small(batches):
            seen: Counter = Counter()
            for text in texts(batch):
                seen.update(round(s / BIN) for s in map(scores.__getitem__, words_of(text)))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["bin", "n"])

    bins = own.where("toxic = 0").mapInArrow(histogram, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    s, n = np.array([r.bin * BIN for r in bins]), np.array([float(r.n) for r in bins])
    if len(s) and s.max() > 0 and s @ n < 0:
        low, high = 1e-6, 50.0 / s.max()
        mean = lambda lam: float((n / n.sum()) @ np.exp(lam * s)) - 1
        for _ in range(100):
            model.lam = (low + high) / 2
            low, high = (model.lam, high) if mean(model.lam) < 0 else (low, model.lam)
    lam = model.lam
    found = own.mapInArrow(_scanner(terms, None), "toxic int, n long, best double, evidence double")
    r = found.where("toxic = 0").agg(F.count("*").alias("docs"), F.sum(F.col("n") * F.exp(-lam * F.col("best"))).alias("mass")).first()
    if r.docs and r.mass:
        model.k = r.docs / r.mass
    scanned = own.mapInArrow(_scanner(terms, model), "toxic int, n long, best double, evidence double")
    curve = scanned.groupBy("toxic", F.round(F.log1p("evidence"), 1).alias("x")).agg(F.count("*").alias("n")).collect()
    _fit_curve(model, [(r.x, r.toxic, r.n) for r in curve])


def _fit_curve(model: Model, rows: list) -> None:
    """Logistic regression on (x, label, count), slightly shrunk, by Newton's method."""
    x, y, n = (np.array(v, float) for v in zip(*rows)) if rows else (np.zeros(0),) * 3
    design = np.stack([np.ones_like(x), x], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (n * (y - p)) - 0.01 * beta
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        beta += np.clip(np.linalg.solve(hess, grad), -2, 2)
    model.a, model.b = float(beta[0]), float(max(0.0, beta[1]))


def evidence_of(found: list, n: int, model: Model) -> float:
    floor = math.log(model.k * n) if n else 0.0
    return sum(e for _, _, s in found if (e := model.lam * s - floor) > 0)


def _scan(text: bytes, scores: WordScores) -> tuple[int, list]:
    words = list(map(scores.__getitem__, words_of(text)))
    return len(words), segments(words) if words and max(words) > 0 else []


def _scanner(terms, model: Model | None):
    """Per document: label, number of words, best segment's score, evidence (0 before K is known)."""

    def run(batches):
        scores = WordScores(terms.value)
        for batch in small(batches):
            rows = []
            for text in texts(batch):
                n, found = _scan(text, scores)
                rows.append((n, max((s for *_, s in found), default=0.0), evidence_of(found, n, model) if model else 0.0))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64())],
                ["toxic", "n", "best", "evidence"],
            )

    model = Model(lam=model.lam, k=model.k) if model else None
    return run


def _scored(batch, scores: WordScores, model: Model) -> tuple[list, list]:
    """Score and significant passages (word positions, significance) of each row."""
    values, passages = [], []
    for text in texts(batch):
        n, found = _scan(text, scores)
        floor = math.log(model.k * n) if n else 0.0
        x = model.a + model.b * math.log1p(evidence_of(found, n, model))
        values.append(1 / (1 + math.exp(-max(-30.0, min(30.0, x)))))
        passages.append([{"start": a, "end": b, "evidence": e} for a, b, s in found if (e := model.lam * s - floor) > 0])
    return values, passages


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and passages (start, end, evidence; in words) of every row."""
    spark = docs.sparkSession
    terms, rest = spark.sparkContext.broadcast(model.terms), Model(lam=model.lam, k=model.k, a=model.a, b=model.b)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))

    def run(batches):
        scores = WordScores(terms.value)
        for batch in small(batches):
            values, passages = _scored(batch, scores, rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"]
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, passages array<struct<start:int,end:int,evidence:double>>"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose score is below the threshold, with all their columns."""
    spark = docs.sparkSession
    terms, rest = spark.sparkContext.broadcast(model.terms), Model(lam=model.lam, k=model.k, a=model.a, b=model.b)

    def run(batches):
        scores = WordScores(terms.value)
        for batch in small(batches):
            yield batch.filter(pa.array([v < threshold for v in _scored(batch, scores, rest)[0]], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

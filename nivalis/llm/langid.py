"""Language identification: known words first, then ever shorter character n-grams.

A known word counts with its log frequency in each language. An unseen word
counts with the mean log frequency of its longest known character n-grams: those
of 5 characters, or else of 4, and so on down to 1 (a caret and a dollar sign mark
the word's ends). The language with the largest sum over the whole text wins.

The classifier is fitted on a bounded sample of labelled documents (`MAX_DOCS`,
chosen by hash, outside the held-out fold). All their words (but those that occur
once) and all n-grams are the model, broadcast as arrays; its size follows the sample's,
not the table's.

Defined results. A null text or one without a letter is `und` with score 0; so is
everything if no labelled row can be learned from. Else the score is the winner's
share of the posterior. Ties go to the first language by name. Repeated rows are
judged alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import bounded_sample, held_out, small, stash

MAX_DOCS = 20_000
CACHED = 200_000
ORDERS = (5, 4, 3, 2, 1)
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def learn(docs: DataFrame, max_docs: int = MAX_DOCS) -> dict:
    """The model: languages, words and n-grams with their log frequencies by language."""
    told = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    ids = bounded_sample(told.select("doc_id").distinct(), F.col("doc_id"), max_docs)
    own = told.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").drop("doc_id")

    def count_words(batches):
        for batch in small(batches):
            seen: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                seen.update((lang, w) for w in words_of(text))
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(seen.values()), pa.int64())],
                ["lang", "term", "n"],
            )

    def count_grams(batches):
        for batch in small(batches, 1 << 20):
            seen: Counter = Counter()
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "n"))):
                for order in ORDERS:
                    for gram in grams_of(word, order):
                        seen[lang, gram] += n
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(seen.values()), pa.int64())],
                ["lang", "term", "n"],
            )

    schema = "lang string, term string, n long"
    words = stash(own.mapInArrow(count_words, schema).groupBy("lang", "term").agg(F.sum("n").alias("n")), "lang-words")
    grams = words.mapInArrow(count_grams, schema).groupBy("lang", "term").agg(F.sum("n").alias("n"))
    langs = [r.lang for r in words.select("lang").distinct().orderBy("lang").collect()]
    return {"langs": langs, "words": _log_frequencies(words, langs, F.lit(0), 2), "grams": _log_frequencies(grams, langs, F.char_length("term"), 1)}


def _log_frequencies(counts: DataFrame, langs: list, group: Column, least: int) -> tuple[pa.Array, np.ndarray]:
    """Terms with `least` occurrences and their add-a-half smoothed log shares by language, within each group (all words; n-grams by length)."""
    of = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(langs)]
    table = counts.groupBy("term", group.alias("g")).agg(*of, F.sum("n").alias("n")).where(F.col("n") >= least).drop("n").toArrow().combine_chunks()
    if not langs or not table.num_rows:
        return pa.array([], pa.string()), np.zeros((0, len(langs)))
    n = np.stack([table.column(f"n{i}").to_numpy() for i in range(len(langs))], 1).astype(float)
    _, which = np.unique(table.column("g").to_numpy(), return_inverse=True)
    totals, sizes = np.zeros((which.max() + 1, len(langs))), np.bincount(which)
    np.add.at(totals, which, n)
    return table.column("term").combine_chunks(), np.log((n + 0.5) / (totals[which] + 0.5 * sizes[which][:, None]))


class WordVectors(dict):
    """Numbers of the rows of `table` that hold words' log frequencies by language, worked out once each; emptied when large."""

    def __init__(self, model: dict):
        super().__init__()
        self.words, self.grams = ({t: i for i, t in enumerate(model[k][0].to_pylist())} for k in ("words", "grams"))
        self.known, self.pieces = model["words"][1], model["grams"][1]
        self.table = np.zeros((CACHED, len(model["langs"])))
        self.known_rows, self.known_at, self.rows, self.counts, self.flat, self.none = ([] for _ in range(6))

    def __missing__(self, word: str) -> int:
        """The row for the word; what it holds is worked out by settle(), for many words at once."""
        row = self[word] = len(self)
        at = self.words.get(word)
        if at is not None:
            self.known_rows.append(row)
            self.known_at.append(at)
            return row
        get, w = self.grams.get, f"^{word}$"
        for n in ORDERS:
            found = [g for i in range(len(w) - n + 1) if (g := get(w[i : i + n])) is not None]
            if found:
                self.rows.append(row)
                self.counts.append(len(found))
                self.flat += found
                return row
        self.none.append(row)
        return row

    def settle(self) -> None:
        if self.known_rows:
            self.table[self.known_rows] = self.known[self.known_at]
        if self.rows:
            counts = np.array(self.counts)
            self.table[self.rows] = np.add.reduceat(self.pieces[self.flat], np.cumsum(counts) - counts, axis=0) / counts[:, None]
        if self.none:
            self.table[self.none] = 0
        for held in (self.known_rows, self.known_at, self.rows, self.counts, self.flat, self.none):
            held.clear()

    def total(self, words: list[str]) -> np.ndarray:
        out = np.zeros(self.table.shape[1])
        for at in range(0, len(words), CACHED // 2):
            part = words[at : at + CACHED // 2]
            if len(self) + len(part) > CACHED:
                self.clear()
            rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            self.settle()
            out += self.table[rows].sum(axis=0)
        return out


def judge(text: str | None, vectors: WordVectors, langs: list[str]) -> tuple[str, float]:
    words = words_of(text) if text else []
    if not words or not langs:
        return "und", 0.0
    total = vectors.total(words)
    share = np.exp(total - total.max())
    best = int(total.argmax())
    return langs[best], float(share[best] / share.sum())


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        vectors = WordVectors(model)
        for batch in small(batches):
            rows = [judge(t, vectors, model["langs"]) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)

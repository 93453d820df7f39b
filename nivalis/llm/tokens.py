"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton over the vocabulary lists every piece that ends at each
character; dynamic programming carries the best score and its number of tokens
only, no path, for as many characters as the longest piece has. Ties follow the usual unigram tokenizer: at an end, starts are
tried from left to right and a later one must score strictly better; a character
that is no piece itself may stand alone at the lowest score less 10, and counts
one token for each of its UTF-8 bytes (byte fallback).

Spaces become the mark U+2581 and one is put in front of the text. No piece has a
mark after another character, so the best split of a text is that of its
parts (marks, then other characters); parts are counted once per task and
looked up again.

The vocabulary's pieces and scores are read from a SentencePiece model file whose
path is a parameter.

Defined results. A null text has 0 characters and null tokens; an empty text has
0 tokens. Repeated rows are counted alike; an empty table gives an empty
result; further columns are ignored. Texts of any length are counted whole.
"""

from __future__ import annotations

import re
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import small

PENALTY = 10.0
MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def vocabulary(path: str = MODEL) -> list[tuple[str, float]]:
    """The model's ordinary pieces with their scores (no control, unknown or byte pieces)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (m.id_to_piece(i), m.get_score(i))
        for i in range(m.get_piece_size())
        if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))
    ]


class Counts(dict):
    """Token counts of parts, worked out once each; emptied when large."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, value in pieces:
            self.automaton.add_word(piece, (len(piece), value))
        self.automaton.make_automaton()
        self.ring = 1 + max(len(piece) for piece, _ in pieces)
        self.alone = min(v for _, v in pieces) - PENALTY

    def __missing__(self, part: str) -> int:
        n = self.count(part)
        if len(part) <= 64:
            if len(self) > 500_000:
                self.clear()
            self[part] = n
        return n

    def count(self, part: str) -> int:
        """Matches come in the order of their ends, longer ones first (starts from left to right); only the last `ring` places are held."""
        ring, alone = self.ring, self.alone
        best, count = [0.0] * ring, [0] * ring
        at, top, n, single = 0, None, 0, False
        for end, (length, value) in chain(self.automaton.iter(part), ((len(part), (0, 0.0)),)):
            while at < end:  # all pieces that end at this character are known
                if not single:
                    score = best[at % ring] + alone
                    if top is None or score > top:
                        top, n = score, count[at % ring] + len(part[at].encode())
                at += 1
                best[at % ring], count[at % ring] = top, n
                top, single = None, False
            if length:
                single |= length == 1
                start = (end + 1 - length) % ring
                score = best[start] + value
                if top is None or score > top:
                    top, n = score, count[start] + 1
        return count[at % ring]


def parts_of(text: str) -> list[str]:
    return PARTS.findall(MARK + text.replace(" ", MARK)) if text else []


def count_tokens(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id, n_chars and n_tokens of every row. The vocabulary (a file's pieces) is broadcast."""
    pieces = vocabulary(model_path)
    if any(MARK in p.lstrip(MARK) for p, _ in pieces):
        raise ValueError("a piece has a mark after another character; parts would not be independent")
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        counts = Counts(shared.value)
        get = counts.__getitem__
        for batch in small(batches):
            data = batch.column("text").to_pylist()
            n = [None if t is None else sum(map(get, parts_of(t))) for t in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t or "") for t in data], pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "n_chars", "n_tokens"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, n_tokens long"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)

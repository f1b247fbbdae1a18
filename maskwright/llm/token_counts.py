"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at each character, the longest first; dynamic programming carries
the best score and its piece count, and a later candidate replaces an earlier one only if it is strictly better, which is
the tie rule of the tokenizers library's Unigram model (starts ascending).  A character without a piece of its own costs
the lowest score less 10 and counts its UTF-8 bytes (byte fallback).

Where no piece crosses a word start and all scores are whole numbers, sums are exact and the best path of a text is the
best paths of its words, so each distinct word is solved once a task.  Otherwise the text is solved as a whole.

A blank is written as U+2581 and one stands before the text.  Nulls and empty texts have no tokens.  Repeated rows are
separate rows.  Empty table: empty result.  Other columns aren't read.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, table, text_batches
from .words import Pieces, code_points

BLANK = "▁"
SLICE = 1_200_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces with scores of a sentencepiece file, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Viterbi:
    def __init__(self, pieces: list[tuple[str, float]], lowest: float | None = None) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min([s for _, s in pieces] if lowest is None else [lowest]) - 10.0
        #: whether words can be solved one by one
        self.apart = not any(BLANK in p.lstrip(BLANK) for p, _ in pieces) and all(s == int(s) and abs(s) < 1 << 31 for _, s in pieces)

    def count(self, text: str) -> int:
        """Pieces on the best path of normalised `text`."""
        n = len(text)
        best, counts = [0.0] + [None] * n, [0] * (n + 1)
        unknown, done = self.unknown, 0
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, value in self.automaton.iter(text):
            ends[end].append(value)
        for end, found in enumerate(ends, 1):
            top, single = None, False
            for length, score in found:
                single |= length == 1
                total = best[end - length] + score
                if top is None or total > top:
                    top, done = total, counts[end - length] + 1
            if not single:
                total = best[end - 1] + unknown
                if top is None or total > top:
                    top, done = total, counts[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))
            best[end], counts[end] = top, done
        return counts[n]


def normalised(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


@functools.cache
def _viterbi(path: str) -> Viterbi:
    return Viterbi(vocabulary(path))


class Counter:
    def __init__(self, model: Viterbi) -> None:
        self.model, self.pieces = model, Pieces()

    def counts(self, texts: list[str]) -> list[int]:
        texts = list(map(normalised, texts))
        if not self.model.apart:
            return list(map(self.model.count, texts))
        joined, cps, at = code_points(texts)
        blank = cps == ord(BLANK)
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[at[:-1]] = True
        begin[at[1:] - 1] = True  # the line feed after each text
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(cps))
        real = ~np.isin(starts, at[1:] - 1)
        starts, ends = starts[real], ends[real]
        resolve = lambda new: [[self.model.count(joined[s:e])] for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
        ids, _ = self.pieces.ids(self.pieces.find(cps, starts, ends, resolve))
        sums = np.concatenate([[0], np.cumsum(ids, dtype=np.int64)])
        return np.diff(sums[np.searchsorted(starts, at)]).tolist()


def _count(batches, path: str):
    import pyarrow as pa

    counter = Counter(_viterbi(path))
    for batch in text_batches(batches, "text", SLICE):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.counts(batch.column(1).to_pylist()), pa.int64())], names=["_id", "n_tokens"])


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and n_tokens.  `path`: a sentencepiece file, on every machine, whose pieces and scores are the vocabulary."""
    import public_tokenizers

    path = path or public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select(F.col(id_col).alias("_id"), body(text_col).alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _count(batches, path), f"_id {kind}, n_tokens long").withColumnRenamed("_id", id_col)


def query(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"))

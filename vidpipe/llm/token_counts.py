"""Token counts under a unigram vocabulary, by a Viterbi pass that only counts.

Text is cut before each space, the space becoming the mark U+2581.  An Aho-Corasick automaton lists the
vocabulary's pieces that end at each character; the best path to a character carries its score and its number
of pieces and nothing else, so no token is ever built.  Tie rules are those of the public tokenizers library:
of equal scores the piece that begins first wins; a character that is no piece by itself may be unknown, at
the lowest score of the vocabulary less 10; unknown characters in a row are one token.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MARK = "▁"
#: What an unknown character costs below the lowest score.
UNKNOWN = 10.0
#: Remembered words per task; longer words than LONG are counted each time.
CACHE = 300_000
LONG = 64

_counters: dict = {}


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a sentencepiece model file and their scores; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return [(model.id_to_piece(i), model.get_score(i)) for i in usual]


class _Counter(dict):
    """Word, with its mark -> (pieces, score) of its best segmentation."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        super().__init__()
        self.find = ahocorasick.Automaton()
        for piece, score in pieces:
            self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN

    def count(self, word: str) -> tuple[int, float]:
        n, unknown_score = len(word), self.unknown
        best, pieces, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        at, top, start, single = 0, 0.0, 0, True  # the end that matches are coming for, and the best of them so far

        def settle(upto: int, top: float | None, start: int, single: bool) -> None:
            """Keep the best path to ``at``, and paths over unknown characters alone to the ends before ``upto``."""
            for end in range(max(at, 1), upto):
                miss = False
                if end != at:
                    top, single = None, False
                if not single:
                    total = best[end - 1] + unknown_score
                    if top is None or total > top:
                        top, start, miss = total, end - 1, True
                best[end], unknown[end] = top, miss
                pieces[end] = pieces[start] + (not (miss and unknown[start]))

        for end, (size, score) in self.find.iter(word):  # by end, of one end the piece that begins first
            end += 1
            if end != at:
                if single and end == at + 1:
                    if at:
                        best[at] = top
                        pieces[at] = pieces[start] + 1
                else:
                    settle(end, top, start, single)
                at, top, start, single = end, best[end - size] + score, end - size, size == 1
            else:
                total = best[end - size] + score
                if total > top:
                    top, start = total, end - size
                if size == 1:
                    single = True
        settle(n + 1, top, start, single)
        return pieces[n], best[n]

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.count(word)
        if len(word) <= LONG:
            if len(self) >= CACHE:
                self.clear()
            self[word] = found
        return found


def words(text: str) -> list[str]:
    """The text cut before each space; a text that does not begin with one gets one."""
    parts = text.split(" ")
    return [MARK + p for p in (parts[1:] if text.startswith(" ") else parts)] if text else []


def count_tokens(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, score)``, one row per input row: pieces of the best segmentation of the whole text, and its score.

    Null and empty texts have no tokens and score 0.  Ids are carried as they are, null and repeated ones too;
    other columns do not matter; no rows give no rows.  ``path`` is a sentencepiece model file that every executor
    can read.
    """
    docs = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = _Counter(read_pieces(path))
        counter = _counters[path]
        for batch in batches:
            for part in slices(batch, "text"):
                found = [[counter[w] for w in words(t)] for t in part["text"].to_pylist()]
                counts, scores = [sum(n for n, _ in own) for own in found], [float(sum(s for _, s in own)) for own in found]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(counts, pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "n_tokens", "score"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, score double")

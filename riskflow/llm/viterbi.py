"""Token counts of a unigram vocabulary without building tokens: Aho-Corasick matches and a count-only Viterbi pass.

The vocabulary is the pieces of a public SentencePiece file, each with a log-probability by its rank (Zipf's rule, see
``load``), as a unigram model with byte fallback over words marked by U+2581. For each end in a word the automaton gives all
pieces that end there; the pass carries the best score and the number of pieces of the best path, nothing else.

Tie rules are those of the ``tokenizers`` library: scores are doubles added from left to right; of equal scores the piece
that starts first wins; a character that is no piece of its own costs the least score less 10; unknown characters in a row
are one piece, written as bytes where all 256 byte pieces exist.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskflow.llm import store
from riskflow.llm.text import Memo, blocks, words

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_BLANK = np.zeros(256, bool)
_BLANK[0x20] = True


def load(path: str) -> list[tuple[str, float]]:
    """Pieces of a SentencePiece file in order, with score -log(rank + 1): a bounded vocabulary, as the file has it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), -math.log(k + 1.0)) for k in range(model.get_piece_size())]


class Counter:
    """Number of pieces of the best path of words."""

    def __init__(self, vocabulary: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        known = {piece for piece, _ in vocabulary}
        self.fallback = all(f"<0x{k:02X}>" in known for k in range(256))
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.memo = Memo(self._words, np.int64)
        self.mark = self.count(MARK)

    def count(self, word: str) -> int:
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, (size, score) in self.automaton.iter(word):
            ends[last + 1].append((last + 1 - size, score))
        score, pieces, run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            best, found = None, sorted(ends[end])
            for start, own in found:  # the earliest start first; a later one must be better
                total = own + score[start]
                if best is None or total > best:
                    best, pieces[end], run[end] = total, pieces[start] + 1, False
            if not found or found[-1][0] != end - 1:
                total = self.unknown + score[end - 1]
                if best is None or total > best:
                    best, run[end] = total, True
                    size = len(word[end - 1].encode()) if self.fallback else (0 if run[end - 1] else 1)
                    pieces[end] = pieces[end - 1] + size
            score[end] = best
        return pieces[n]

    def _words(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = [self.count(MARK + w.decode("utf-8", "replace")) for w in found]
        return np.array(counts, np.int64), np.ones(len(found), np.int64)

    def texts(self, column: pa.Array) -> np.ndarray:
        """Pieces of each text: every space starts a word, and so does a text that begins without one."""
        column = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), MARK, " ")
        found = words(column, space=_BLANK)
        at, _ = self.memo.lookup(found)
        sums = np.zeros(len(at) + 1, np.int64)
        np.cumsum(self.memo.pool[at], out=sums[1:])
        blanks = np.zeros(len(found.data) + 1, np.int64)
        np.cumsum(found.data == 0x20, out=blanks[1:])
        a, b = found.at[:-1], found.at[1:]
        bare = np.zeros(len(a), bool)
        bare[a < b] = found.data[a[a < b]] != 0x20
        starts = blanks[b] - blanks[a] + bare
        return sums[found.first[1:]] - sums[found.first[:-1]] + (starts - found.n) * self.mark


@lru_cache(maxsize=2)
def _counter(vocabulary: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(vocabulary)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and n_chars of every document, over whole texts.

    Null and empty texts have no tokens; repeated rows are counted each; null ids stay null; other columns are not read. The
    vocabulary is sent to the executors; its size is that of the file.
    """
    store.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(load(path)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(shared.value)
        for batch in batches:
            for part in blocks(batch):
                text = part.column("text")
                n = pc.fill_null(pc.utf8_length(text), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(count.texts(text), pa.int64()), n], names=["doc_id", "n_tokens", "n_chars"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id bigint, n_tokens bigint, n_chars bigint")

"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character.  Dynamic
programming carries the best score and the number of pieces to each place, and no path.  The
tie rule is the tokenizer's: starts are tried from left to right and only a strictly better
score replaces, so of equal paths the one with the earlier start of its last piece stays.
"""

from __future__ import annotations

from functools import lru_cache
from math import log

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import per_batch

SPACE = "▁"
#: below the lowest score of a piece, for a character that no piece covers
UNKNOWN_PENALTY = 10.0
#: words whose counts a Python worker remembers
REMEMBERED = 300_000
_LONG = 64
_UNKNOWN = 1 << 40


def zipf_unigram(pieces: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """Unigram log-probabilities of pieces by rank: 1 / (rank * H), the best score first.

    A merge-based vocabulary stores merge order as its scores; their ranks stand in for
    frequencies.  Nothing is trained.
    """
    ordered = sorted(pieces, key=lambda p: -p[1])
    total = log(sum(1 / r for r in range(1, len(ordered) + 1)))
    return [(piece, -log(r) - total) for r, (piece, _) in enumerate(ordered, 1)]


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces and scores of a sentencepiece model file, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]


class Counter(dict):
    """Word -> pieces plus ``_UNKNOWN`` times the characters without a piece; fills itself."""

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        count = self.viterbi(SPACE + word)
        if len(word) <= _LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count

    def viterbi(self, text: str) -> int:
        n = len(text)
        best: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        best[0] = 0.0
        done = 0  # ends up to here are final
        single, unknown = self.single, self.unknown

        def close(upto: int) -> None:
            nonlocal done
            while done < upto:
                c = text[done]
                if c not in single:  # the last start to reach this end
                    score = unknown + best[done]
                    if best[done + 1] is None or score > best[done + 1]:
                        best[done + 1] = score
                        # falls back to the bytes of the character
                        count[done + 1] = count[done] + len(c.encode("utf-8", "replace")) + _UNKNOWN
                done += 1

        if len(self.automaton):
            for last, (length, score) in self.automaton.iter(text):
                end = last + 1
                close(last)
                start = end - length
                score += best[start]
                if best[end] is None or score > best[end]:
                    best[end] = score
                    count[end] = count[start] + 1
        close(n)
        return count[n]

    def total(self, text: str | None) -> tuple[int, int]:
        """Tokens, and characters without a piece.  Words start at spaces, each with its marker."""
        if not text:
            return 0, 0
        words = text.replace(SPACE, " ").split(" ")
        if words[0] == "":  # the text begins with a space, which needs no marker before it
            del words[0]
        found = sum(map(self.__getitem__, words))
        return found % _UNKNOWN, found // _UNKNOWN


@lru_cache(maxsize=1)
def _counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    """Kept by the Python worker, which serves many tasks."""
    return Counter(pieces)


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], most_pieces: int = 1_000_000) -> DataFrame:
    """doc_id, n_tokens, n_unknown of every row.

    ``pieces`` are a unigram vocabulary with its scores.  A vocabulary is fixed by its tokenizer
    and not by the data; one above ``most_pieces`` is refused, as it is sent to every worker.
    Words are the parts between spaces, each with the space marker before it, tokenized one by
    one; a character that no piece covers counts one token per UTF-8 byte.  Null and empty texts
    have no tokens; repeated rows are counted alike.
    """
    if len(pieces) > most_pieces:
        raise ValueError(f"{len(pieces)} pieces are too many to send to every worker")
    held = docs.sparkSession.sparkContext.broadcast(tuple(pieces))

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = _counter(held.value)
        tokens, unknown = zip(*map(counter.total, batch.column("text").to_pylist()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64())],
            ["doc_id", "n_tokens", "n_unknown"],
        )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return per_batch(slim, build, "doc_id bigint, n_tokens bigint, n_unknown bigint")

"""Token counts of a unigram tokenizer without its tokens: count-only Viterbi.

The model is the unigram tokenizer over the pieces and scores of a vocabulary file: spaces become U+2581, one is put in
front of a text that is not empty, and characters without a piece are counted as bytes. An Aho-Corasick automaton of all
pieces lists the pieces that end at each place; the recursion carries the best score and, with it, the number of
tokens. Ties are settled as the tokenizer does: of equal scores the piece that starts first in the text wins, since a
later one replaces it only with a better score.

No piece holds U+2581 after another character, so no piece runs over the start of a word, and with whole-number
scores the best path of a text is made of the best paths of its words. Words are counted once and summed up. With a
vocabulary for which this does not hold the whole text is one word.
Null and empty texts have no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlens.llm.chunks import ChunkCache
from larderlens.llm.common import text_slices

SPACE = "▁"
# Fixed value: what an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0

COUNTS = "doc_id long, n_tokens long"

_COUNTERS: dict[str, TokenCounter] = {}


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file, in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    held = SentencePieceProcessor(model_file=path)
    return [(held.id_to_piece(i), held.get_score(i)) for i in range(held.get_piece_size())]


class TokenCounter:
    """Counts for texts as UTF-8 bytes."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        whole = all(float(score).is_integer() for _, score in pieces)
        by_word = whole and not any(SPACE in piece.lstrip(SPACE) for piece, _ in pieces)
        alone = b"" if any("\n" in piece for piece, _ in pieces) else b"\n"
        self.words = re.compile(b" *[^ " + alone + b"]+| +" + (b"|\n" if alone else b"")) if by_word else None
        self.cache = ChunkCache(lambda chunks: [self._count(c).to_bytes(8, "little") for c in chunks])

    def _count(self, chunk: bytes) -> int:
        text = chunk.decode().replace(" ", SPACE)
        n = len(text)
        # Best score and token count up to each place; an unknown run is one piece of bytes, so bytes are added up.
        score: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        starts: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for last, (length, value) in self.automaton.iter(text):
            starts[last - length + 1].append((last + 1, value))
        for at in range(n):
            here, so_far = score[at], count[at] + 1
            for end, value in sorted(starts[at]):
                if score[end] is None or here + value > score[end]:
                    score[end], count[end] = here + value, so_far
            if text[at] not in self.single and (score[at + 1] is None or here + self.unknown > score[at + 1]):
                score[at + 1], count[at + 1] = here + self.unknown, so_far - 1 + len(text[at].encode())
        return count[n]

    def count(self, texts: list[bytes]) -> list[int]:
        """The number of tokens of each text."""
        spaced = [b" " + t.replace(SPACE.encode(), b" ") if t else b"" for t in texts]
        if self.words is None:
            return [self._count(t) for t in spaced]
        chunks = [self.words.findall(t) for t in spaced]
        known = self.cache.results(set().union(*chunks))
        number = {c: int.from_bytes(known[c], "little") for c in set().union(*chunks)}
        return [sum(map(number.__getitem__, c)) for c in chunks]


def _counter(path: str) -> TokenCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(vocabulary(path))
    return _COUNTERS[path]


def count_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in text_slices(batch):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(_counter(path).count(texts.to_pylist()), pa.int64())], names=["doc_id", "n_tokens"]
            )


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id and n_tokens of every row of `docs` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: count_rows(batches, vocabulary_path), COUNTS
    )

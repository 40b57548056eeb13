"""SentencePiece byte-pair encoding and decoding in vectorised merge rounds.

The distinct words of many texts are laid out as one flat array of symbols. A round finds the minimum pair rank of each
word with a segmented reduction, merges the leftmost non-overlapping pairs of that rank in all words at once,
and compacts the array; words without a pair left are set aside. Rounds end when none is left.

Rank order is the library's: the higher score first, of equal scores the pair further left. Merging several pairs of a
word in one round is the same as merging them one by one unless a merge brings forth a pair that would come before
the next of them; words in which that happens merge only their leftmost pair in that round.

No piece holds U+2581 after another character, so spaces part words; with a vocabulary for which this does not hold
the whole text is one word. Null and empty texts have no ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlens.llm.chunks import ChunkCache
from larderlens.llm.common import text_slices

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_NONE = np.iinfo(np.int64).max
_CODECS: dict[str, Codec] = {}


def _merge_table(pieces: dict[str, int], rank_of: dict[str, int], symbols: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (left symbol, right symbol), and for each the rank and the symbol of the merged piece."""
    rows = []
    for piece, made in pieces.items():
        for cut in range(1, len(piece)):
            left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
            if left is not None and right is not None:
                rows.append((left << 32 | right, rank_of[piece], made))
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


class Codec:
    """Ids for texts and texts for ids, as the library makes them from the same model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        pieces = {names[i]: i for i in range(size) if not special[i] and not model.is_byte(i)}
        scores = {piece: model.get_score(i) for piece, i in pieces.items()}
        ranks = {score: n for n, score in enumerate(sorted(set(scores.values()), reverse=True))}
        # Characters that occur in pieces only are symbols too: they can be merged, and else become bytes.
        inner = sorted({c for piece in pieces for c in piece} - pieces.keys())
        symbols = pieces | {c: size + n for n, c in enumerate(inner)}
        self.keys, self.ranks, self.made = _merge_table(pieces, {p: ranks[s] for p, s in scores.items()}, symbols)
        # Other characters are symbols below zero.
        self.symbol_of = -np.arange(1, 0x110001, dtype=np.int64)
        for char, symbol in symbols.items():
            if len(char) == 1:
                self.symbol_of[ord(char)] = symbol
        self.size, self.inner = size, inner
        byte_id = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_ids = np.array([byte_id[b] for b in range(256)], dtype="<u4") if len(byte_id) == 256 else None
        self.unknown_id = model.unk_id()
        self.id_names = [str(i) for i in range(size)]
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        self.is_control = np.array([model.is_control(i) for i in range(size)])
        self.starts_space = np.array([p.startswith(SPACE) and not self.is_byte[i] for i, p in enumerate(names)])
        self.surface = [
            bytes([int(p[3:5], 16)]) if self.is_byte[i]
            else b"" if self.is_control[i]
            else UNKNOWN_SURFACE.encode() if i == self.unknown_id
            else p.replace(SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        alone = b"" if any("\n" in piece for piece in pieces) else b"\n"
        by_word = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        self.words = re.compile(b" *[^ " + alone + b"]+| +" + (b"|\n" if alone else b"")) if by_word else None
        self.cache = ChunkCache(self.encode_words)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; _NONE where there is no such piece."""
        wanted = np.where((left >= 0) & (right >= 0), left << 32 | np.maximum(right, 0), -1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = self.keys[at] == wanted
        return np.where(known, self.ranks[at], _NONE), self.made[at]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit numbers."""
        texts = [w.decode().replace(" ", SPACE) for w in words]
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
        symbol, word = self.merged(self.symbol_of[chars], np.repeat(np.arange(len(texts)), lengths))
        return self._as_ids(symbol, word, len(texts))

    def merged(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat symbols; `word` tells which word each belongs to, in order."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbol), _NONE)
        made = np.zeros(len(symbol), dtype=np.int64)
        if len(symbol) > 1:
            rank[:-1], made[:-1] = self._pairs(symbol[:-1], symbol[1:])
            rank[:-1][word[1:] != word[:-1]] = _NONE
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[first, len(symbol)])
            least = np.repeat(np.minimum.reduceat(rank, first), sizes)
            open_ = least != _NONE
            done.append((symbol[~open_], word[~open_]))
            symbol, word, rank, made, least = symbol[open_], word[open_], rank[open_], made[open_], least[open_]
            if not len(symbol):
                break
            chosen = self._leftmost(rank == least)
            step = self._merge(symbol, word, rank, made, chosen)
            early = step[1][step[4] & (step[2] <= least[~np.r_[False, chosen[:-1]]])]
            # Between two merges side by side, the first meets the left symbol of the second.
            between = np.flatnonzero(chosen[:-2] & chosen[2:])
            between = between[self._pairs(made[between], symbol[between + 2])[0] <= least[between]]
            early = np.r_[early, word[between]]
            if len(early):
                hasty = np.isin(word, early)
                one = np.r_[True, word[1:] != word[:-1]]
                before = np.cumsum(chosen) - chosen
                chosen &= ~hasty | (before == before[np.flatnonzero(one)][np.cumsum(one) - 1])
                step = self._merge(symbol, word, rank, made, chosen)
            symbol, word, rank, made = step[:4]
        symbol = np.concatenate([s for s, _ in done]) if done else symbol
        word = np.concatenate([w for _, w in done]) if done else word
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    @staticmethod
    def _leftmost(match: np.ndarray) -> np.ndarray:
        """Of pairs that follow each other without a break, every other one from the left."""
        place = np.arange(len(match))
        run = np.maximum.accumulate(np.where(match & ~np.r_[False, match[:-1]], place, 0))
        return match & ((place - run) % 2 == 0)

    def _merge(self, symbol, word, rank, made, chosen):
        """Arrays after merging each chosen pair, and which pairs of the result are new."""
        keep = ~np.r_[False, chosen[:-1]]
        new = np.where(chosen, made, symbol)[keep]
        at = chosen[keep]
        word, rank, made = word[keep], rank[keep].copy(), made[keep].copy()
        changed = at | np.r_[at[1:], False]
        pair = np.flatnonzero(changed[:-1])
        rank[changed] = _NONE
        within = pair[word[pair] == word[pair + 1]]
        rank[within], made[within] = self._pairs(new[within], new[within + 1])
        return new, word, rank, made, changed

    def _as_ids(self, symbol: np.ndarray, word: np.ndarray, n_words: int) -> list[bytes]:
        ids = symbol.astype("<u4")
        other = np.flatnonzero((symbol < 0) | (symbol >= self.size))
        if len(other):
            parts, counts, last = [], np.ones(len(symbol), dtype=np.int64), 0
            for at in other.tolist():
                s = int(symbol[at])
                char = chr(-s - 1) if s < 0 else self.inner[s - self.size]
                spelled = [self.unknown_id] if self.byte_ids is None else self.byte_ids[list(char.encode())]
                parts += [ids[last:at], np.asarray(spelled, dtype="<u4")]
                counts[at], last = len(spelled), at + 1
            ids = np.concatenate([*parts, ids[last:]])
            word = np.repeat(word, counts)
        edges = (np.searchsorted(word, np.arange(n_words + 1)) * 4).tolist()
        held = ids.tobytes()
        return [held[lo:hi] for lo, hi in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each UTF-8 text as little-endian 32-bit numbers."""
        spaced = [b" " + t.replace(SPACE.encode(), b" ") if t else b"" for t in texts]
        if self.words is None:
            return iter(self.encode_words(spaced))
        return self.cache.joined([self.words.findall(t) for t in spaced])

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of one sequence of ids in UTF-8. The space that encoding puts in front is taken off; bytes that are
        no valid character become U+FFFD each."""
        ids = np.asarray(ids)
        if not len(ids):
            return b""
        text = b"".join(map(self.surface.__getitem__, ids.tolist()))
        control = self.is_control[ids]
        if control.any() or not _is_text(text):
            text = b"".join(self._repaired(ids))
        first = ids[np.argmin(control)]
        return text[1:] if self.starts_space[first] else text

    def _repaired(self, ids: np.ndarray) -> Iterator[bytes]:
        for is_byte, run in _runs(self.is_byte[ids], ids):
            held = b"".join(self.surface[i] for i in run)
            if not is_byte:
                yield held
            while is_byte and held:
                size = next((n for n in (1, 2, 3, 4) if _is_text(held[:n])), 0)
                yield held[:size] if size else "\N{REPLACEMENT CHARACTER}".encode()
                held = held[max(size, 1) :]


def _is_text(held: bytes) -> bool:
    try:
        held.decode()
    except UnicodeDecodeError:
        return False
    return True


def _runs(flags: np.ndarray, values: np.ndarray) -> Iterable[tuple[bool, list[int]]]:
    edges = np.flatnonzero(np.r_[True, flags[1:] != flags[:-1], True]).tolist()
    return ((bool(flags[lo]), values[lo:hi].tolist()) for lo, hi in zip(edges[:-1], edges[1:], strict=True))


def codec(path: str) -> Codec:
    """The codec of a model file, made once per Python worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """doc_id, ids."""
    for batch in batches:
        for rows, texts in text_slices(batch):
            ids = [np.frombuffer(i, dtype="<u4").astype("<i4") for i in codec(path).encode(texts.to_pylist())]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ids (array of int) of every row of `docs` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: encoded(batches, model_path), "doc_id long, ids array<int>"
    )


def digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = codec(path)
    for batch in batches:
        for rows, texts in text_slices(batch):
            out: list[list] = [[], [], []]
            for held in own.encode(texts.to_pylist()):
                ids = np.frombuffer(held, dtype="<u4")
                listed = ",".join(map(own.id_names.__getitem__, ids.tolist()))
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(listed.encode()).hexdigest())
                out[2].append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode every row of `docs` (doc_id, text): the token count and digests of ids and of the decoded text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: digests(batches, model_path), CODED
    )

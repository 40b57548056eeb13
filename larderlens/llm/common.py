"""What the operators share: staged tables, safe column names, and text columns as flat arrays.

White space is always `[\\x20\\x09-\\x0D]` and a word is a run of other characters. All of these are single
bytes in UTF-8, so texts are cut as bytes and never decoded for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from larderlens.functions.staging import new_path, settle, shared_folder

__all__ = ["new_path", "settle", "shared_folder"]

# The characters that separate words.
WHITE_SPACE = " \t\n\x0b\x0c\r"

# Text handled at once inside a task. A longer document is a slice of its own.
SLICE_BYTES = 6 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def free_name(taken: DataFrame, wish: str) -> str:
    """A column name that `taken` does not have."""
    names = {c.lower() for c in taken.columns}
    while wish.lower() in names:
        wish = f"_{wish}"
    return wish


def text_slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 30
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut a batch into runs with about `limit` bytes of text and at most `rows` rows: the rows, and their texts as
    bytes (null: empty)."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    texts = pc.fill_null(texts, b"")
    part = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // limit
    part = part + np.arange(len(part)) // rows
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array in a row, and the n + 1 edges of its values."""
    width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    edges = np.frombuffer(texts.buffers()[1], dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[edges[0] : edges[-1]], edges - edges[0]


def is_white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


# Powers that a process keeps: of each base as many as were asked for, up to this many.
KEPT_POWERS = 1 << 18
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    held = _POWERS.get(int(base), np.zeros(0, dtype=np.uint64))
    if len(held) >= n:
        return held[:n]
    steps = np.full(n if n > KEPT_POWERS else min(2 * n, KEPT_POWERS), base, dtype=np.uint64)
    steps[0] = 1
    held = np.cumprod(steps, dtype=np.uint64)
    held.flags.writeable = False
    if n <= KEPT_POWERS:
        _POWERS[int(base)] = held
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of a slice of texts: byte spans, a 64-bit hash each, and the edges of each text's words.

    Hashes are polynomials modulo 2^64, made for all words at once from running sums, then mixed.
    """

    def __init__(self, texts: pa.Array):
        self.data, self.text_edges = flat_bytes(texts)
        dark = np.zeros(len(self.data) + 2, dtype=bool)
        dark[1:-1] = ~is_white(self.data)
        inner = self.text_edges[1:-1]
        step = dark[1:] != dark[:-1]
        starts = np.flatnonzero(step & dark[1:])
        ends = np.flatnonzero(step & dark[:-1])
        # A word does not run on into the next text.
        cut = inner[(inner > 0) & (inner < len(self.data))]
        cut = np.unique(cut[dark[cut] & dark[cut + 1]])
        self.starts = np.sort(np.concatenate([starts, cut]))
        self.ends = np.sort(np.concatenate([ends, cut]))
        self.edges = np.searchsorted(self.starts, self.text_edges)

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        # Bytes are moved by one so that a zero byte counts.
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(n, _INVERSE), dtype=np.uint64, out=sums[1:])
        ups = _powers(n + 1, _ODD)
        return mixed((sums[self.ends] - sums[self.starts]) * ups[self.ends])


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive values; those that run over the edge of a text are the caller's to leave out."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(n, _INVERSE), dtype=np.uint64, out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * _powers(n + 1, _ODD)[size:])


def spread(edges: np.ndarray) -> np.ndarray:
    """For each item between the edges, the number of the range it lies in."""
    return np.repeat(np.arange(len(edges) - 1), np.diff(edges))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)

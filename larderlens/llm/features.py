"""Hashed n-gram features of texts as dense rows, and linear models on them.

A row holds the logarithm of the counts of hashed n-grams, scaled to length 1. The number of buckets is fixed, so
memory per document does not depend on its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from larderlens.llm.common import Words, flat_bytes, mixed, spread, window_hashes

# Rows turned into features at once.
SLICE_ROWS = 128
SLICE_TEXT = 1 << 20

_CASE = np.arange(0x110000, dtype=np.uint32)
_CASE[65:91] += 32
_LETTERS: list[np.ndarray] = []


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts (ASCII letters in lower case) and the edges of the texts."""
    data, edges = flat_bytes(texts)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4")
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return _CASE[points], lead[edges]


def has_letter(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each text, whether it has a Unicode letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    seen = np.zeros(len(points) + 1, dtype=np.int64)
    np.cumsum(_LETTERS[0][points], out=seen[1:])
    return seen[edges[1:]] > seen[edges[:-1]]


def _tally(counts: np.ndarray, hashes: np.ndarray, owner: np.ndarray, size: int) -> None:
    """Count the windows of `size` that lie within one text."""
    n, buckets = counts.shape
    if len(hashes):
        within = owner[: len(hashes)] == owner[size - 1 :]
        bucket = (hashes >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)
        cell = owner[: len(hashes)] * buckets + bucket
        counts += np.bincount(cell[within], minlength=n * buckets).reshape(n, buckets)


def hashed_rows(texts: pa.Array, buckets: int, chars: tuple[int, ...], words: tuple[int, ...] = ()) -> np.ndarray:
    """A row of `buckets` (a power of two) for each text, from character n-grams and word n-grams of the given sizes."""
    counts = np.zeros((len(texts), buckets), dtype=np.int64)
    points, edges = code_points(texts)
    owner = spread(edges)
    rolling = np.zeros(len(points), dtype=np.uint64)
    for size in range(1, max(chars, default=0) + 1):
        held = max(len(points) - size + 1, 0)
        rolling = rolling[:held] * np.uint64(0x100000001B3) + points[size - 1 :].astype(np.uint64) + np.uint64(1)
        if size in chars:
            _tally(counts, mixed(rolling + np.uint64(size << 58)), owner, size)
    if words:
        found = Words(texts)
        hashes, owner = found.hashes(), spread(found.edges)
        for size in words:
            _tally(counts, window_hashes(hashes, size), owner, size)
    rows = np.log1p(counts, dtype=np.float32)
    norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.maximum(norm, 1e-9)[:, None]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _descend(gradient, width: tuple[int, ...], rate: float, rounds: int) -> np.ndarray:
    """Accelerated descent from zero."""
    at, ahead = np.zeros(width, dtype=np.float32), np.zeros(width, dtype=np.float32)
    for n in range(rounds):
        step = (ahead - rate * gradient(ahead)).astype(np.float32)
        ahead = step + n / (n + 3) * (step - at)
        at = step
    return at


def fit_logistic(rows: np.ndarray, classes: np.ndarray, n_classes: int, penalty: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Softmax regression with classes of equal weight: (buckets + 1, classes), the last row being the bias."""
    wide = np.hstack([rows, np.ones((len(rows), 1), dtype=np.float32)])
    weight = 1 / np.maximum(np.bincount(classes, minlength=n_classes), 1)[classes] / n_classes
    target = np.eye(n_classes, dtype=np.float32)[classes]

    def gradient(at):
        return wide.T @ ((softmax(wide @ at) - target) * weight[:, None].astype(np.float32)) + penalty * at

    return _descend(gradient, (wide.shape[1], n_classes), 1.0, rounds)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_svm(rows: np.ndarray, positive: np.ndarray, penalty: float = 1e-3, rounds: int = 150) -> np.ndarray:
    """Linear support vector machine with squared hinge loss and sides of equal weight: (buckets + 1,), bias last."""
    wide = np.hstack([rows, np.ones((len(rows), 1), dtype=np.float32)])
    sign = np.where(positive, 1, -1).astype(np.float32)
    weight = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)).astype(np.float32)

    def gradient(at):
        short = np.maximum(1 - sign * (wide @ at), 0)
        return -2 * wide.T @ (weight * sign * short) + penalty * at

    return _descend(gradient, (wide.shape[1],), 0.2, rounds)


def apply(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return rows @ weights[:-1] + weights[-1]

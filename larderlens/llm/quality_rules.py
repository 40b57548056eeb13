"""Quality rules: base signals with fixed limits, then a classifier for what passes them.

The classifier is a logistic regression on hashed word and character n-grams, fitted on labelled rows and calibrated by
Platt's method on labelled rows that the fit has not seen. It learns from a bounded sample: at most ROWS_PER_CLASS
whole texts of either label, chosen by a hash of doc_id, the same on every run; a third of them calibrate. A document
labelled both ways counts as bad. Null and empty texts have no words and fail the base rules. Without both labels to learn
from, the base rules alone decide.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlens.llm import features
from larderlens.llm.common import Words, is_white, mixed, spread, text_slices, window_hashes

ROWS_PER_CLASS = 1500
BUCKETS = 8192
CHARS = (2, 3, 4)
WORDS = (1, 2)

# Fixed limits.
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
LEAST_QUALITY = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

RATED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, quality double"
)


def _sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many flags are set between each pair of edges."""
    running = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=running[1:])
    return running[edges[1:]] - running[edges[:-1]]


def repeated_words(words: Words, size: int = 3) -> np.ndarray:
    """Words of each text in windows of `size` that the text has twice or more."""
    owner = spread(words.edges)
    hashes = window_hashes(words.hashes(), size)
    covered = np.zeros(len(owner), dtype=bool)
    if len(hashes):
        starts = np.flatnonzero(owner[: len(hashes)] == owner[size - 1 :])
        own = mixed(hashes[starts] ^ mixed(owner[starts].astype(np.uint64)))
        order = np.argsort(own)
        same = own[order[1:]] == own[order[:-1]]
        twice = np.zeros(len(own), dtype=bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        for step in range(size):
            covered[starts[twice] + step] = True
    return _sums(covered, words.edges)


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_signals(texts: pa.Array) -> dict[str, np.ndarray]:
    words = Words(texts)
    data, edges = words.data, words.text_edges
    n_words = np.diff(words.edges)
    repeats = repeated_words(words)
    return {
        "n_words": n_words,
        "word_chars": _sums(((data & 0xC0) != 0x80) & ~is_white(data), edges),
        "n_symbols": _sums(_SYMBOL[data], edges),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts.to_pylist()], dtype=np.int64),
        "n_repeat_words": repeats,
        "base_failed": (n_words < LEAST_WORDS) | (100 * repeats > MOST_REPEAT_PERCENT * n_words),
    }


def _rows(texts: pa.Array) -> np.ndarray:
    return features.hashed_rows(texts, BUCKETS, CHARS, WORDS)


def fit(texts: list[str], good: np.ndarray, calibrates: np.ndarray) -> dict:
    """Weights of the regression, and slope and shift that turn its margin into a probability."""
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    rows = np.vstack([_rows(part) for _, part in text_slices(batch, limit=features.SLICE_TEXT, rows=features.SLICE_ROWS)])
    both = len(set(good[~calibrates].tolist())) == 2 and len(set(good[calibrates].tolist())) == 2
    learn = ~calibrates if both else np.ones(len(rows), dtype=bool)
    check = calibrates if both else learn
    weights = features.fit_logistic(rows[learn], good[learn].astype(int), 2, penalty=1e-5, rounds=200)
    plane = weights[:, 1] - weights[:, 0]
    slope, shift = _platt(features.apply(rows[check], plane), good[check])
    return {"plane": plane, "slope": slope, "shift": shift}


def _platt(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Logistic curve through margins and softened labels, by Newton steps."""
    n_good, n_bad = int(good.sum()), int((~good).sum())
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    design = np.stack([margins, np.ones_like(margins)], axis=1).astype(np.float64)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = features.sigmoid(design @ at)
        slope = design.T @ (p - target) + 1e-3 * at
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        at = at - np.clip(np.linalg.solve(curve, slope), -1, 1)
    return float(at[0]), float(at[1])


def train(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Fit on labelled rows of `docs` (doc_id, text); `labels` has doc_id and quality (1: good, 0: bad)."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min("quality").alias("quality"))
    hashed = F.xxhash64("doc_id")
    one, other = (known.where(F.col("quality") == q).orderBy(hashed, "doc_id").limit(ROWS_PER_CLASS) for q in (0, 1))
    sample = F.broadcast(one.unionByName(other))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text"])
        good = group["quality"].to_numpy() == 1
        model = fit(group["text"].tolist(), good, group["calibrates"].to_numpy()) if 0 < good.sum() < len(good) else None
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    drawn = rows.join(sample, "doc_id").withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3)) == 0)
    found = drawn.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fitted, "model binary").collect()
    return pickle.loads(found[0][0]) if found else None


def rate(docs: DataFrame, model: dict | None) -> DataFrame:
    """Base signals, calibrated quality and verdict of every row of `docs` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, limit=features.SLICE_TEXT, rows=features.SLICE_ROWS):
                base, own = base_signals(texts), shared.value
                if own is None:
                    quality = np.ones(len(texts))
                else:
                    quality = features.sigmoid(own["slope"] * features.apply(_rows(texts), own["plane"]) + own["shift"])
                base |= {"kept": ~base["base_failed"] & (quality >= LEAST_QUALITY), "quality": quality.astype(np.float64)}
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(v) for v in base.values())], names=["doc_id", *base]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rated, RATED)

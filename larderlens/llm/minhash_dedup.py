"""Near-duplicate documents by DartMinHash.

A document is a weighted set: its word five-grams with the number of times they occur. Over the plane of weight and rank
of each element, darts fall as a Poisson process that depends on the element's hash alone. A dart belongs to one of
COORDINATES coordinates; of the darts within a document's weights each coordinate keeps the one of least rank. Two documents
agree in a coordinate with the probability of their weighted Jaccard similarity. Ranks are followed only as
far as needed to fill all coordinates, so the work for a document is about COORDINATES * ln(COORDINATES) darts plus
one look at each element, however many coordinates there are.

BANDS bands of coordinates are buckets; a pair of similarity 0.8 shares one with probability 0.99993. Pairs from
`linked_groups` are near if their exact weighted Jaccard similarity is SIMILARITY or more. Texts that are equal as they
stand are folded first. A text with 1 to 4 words is one element; texts without words (null, empty, white space) are
near to equal texts only. The first document of a class by doc_id (null last) stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlens.functions.skew import attach_by_key
from larderlens.llm.common import Words, free_name, mixed, ranges, settle, spread, text_slices, window_hashes
from larderlens.llm.groups import Joined, linked_groups

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 5
COORDINATES = BANDS * ROWS

_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)]))
_LIMITS = (_POISSON * 2.0**53).astype(np.uint64)
_RANK_BITS = 18  # of the fraction of a rank; whole ranks have the 14 bits above
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the elements of each text, repeats included, and the edges of the texts."""
    words = Words(texts)
    hashes = words.hashes()
    lengths = np.diff(words.edges)
    windows = np.maximum(lengths - size + 1, 0)
    at = ranges(words.edges[:-1], windows)
    found = window_hashes(hashes, size)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(lengths)), windows)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        whole = [window_hashes(hashes[words.edges[i] : words.edges[i + 1]], int(lengths[i]))[0] for i in short.tolist()]
        order = np.argsort(np.concatenate([owner, short]), kind="stable")
        found = np.concatenate([found, np.array(whole, dtype=np.uint64)])[order]
        windows[short] = 1
    return found, np.concatenate([[0], np.cumsum(windows)])


def weighted(hashes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text, their counts, and the texts they belong to."""
    owner = spread(edges)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(hashes) else np.zeros(0, dtype=int)
    counts = np.diff(np.r_[first, len(hashes)])
    return hashes[first], counts.astype(np.float64), owner[first]


def sketches(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, size: int = COORDINATES) -> np.ndarray:
    """DartMinHash of n weighted sets: for each set and coordinate the packed rank and name of its least dart. Sets without
    elements have no darts (all bits set)."""
    out = np.full((n, size), _EMPTY)
    total = np.bincount(owner, weights=weights, minlength=n)
    # Unit cells of rank * size per set, so that all coordinates are filled with probability 0.95 at first.
    reach = np.ceil(size * (np.log(size) + 3) / np.maximum(total, 1e-9)).astype(np.int64)
    todo = total > 0
    while todo.any():
        mine = np.flatnonzero(todo[owner])
        _throw(out, elements[mine], weights[mine], owner[mine], reach[owner[mine]], size)
        todo &= (out == _EMPTY).any(axis=1)
        reach = np.where(todo, np.minimum(2 * reach, 1 << 14), reach)
    return out


def _throw(out: np.ndarray, elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, reach: np.ndarray, size: int) -> None:
    """Darts of each element in the unit cells of weight below its weight and rank below its reach."""
    layers = np.ceil(weights).astype(np.int64)
    cells = layers * reach
    item = np.repeat(np.arange(len(elements)), cells)
    cell = ranges(np.zeros(len(cells), dtype=np.int64), cells)
    layer, rank = cell // reach[item], cell % reach[item]
    own = mixed(elements[item] ^ mixed((layer.astype(np.uint64) << np.uint64(20)) + rank.astype(np.uint64)))
    darts = np.searchsorted(_LIMITS, own >> np.uint64(11), side="right")
    dart = np.repeat(np.arange(len(own)), darts)
    number = ranges(np.zeros(len(darts), dtype=np.int64), darts)
    name = mixed(own[dart] + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    item = item[dart]
    inside = layer[dart] + (mixed(name) >> np.uint64(11)) * 2.0**-53 < weights[item]
    name, item, rank = name[inside], item[inside], rank[dart[inside]]
    fine = (rank.astype(np.uint64) << np.uint64(_RANK_BITS)) + (name >> np.uint64(64 - _RANK_BITS))
    coordinate = ((name & np.uint64(0xFFFFFFFF)) * np.uint64(size)) >> np.uint64(32)
    packed = (fine << np.uint64(32)) | (mixed(name ^ np.uint64(0x5BD1E995)) >> np.uint64(32))
    np.minimum.at(out.reshape(-1), owner[item] * size + coordinate.astype(np.int64), packed)


def band_keys(found: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A key for each band of each sketch."""
    n, size = found.shape
    parts = found.reshape(n, bands, size // bands)
    keys = np.zeros((n, bands), dtype=np.uint64) + mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for row in range(parts.shape[2]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, row])
    return keys.view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, bands, for texts with words."""
    for batch in batches:
        for rows, texts in text_slices(batch, limit=1 << 19, rows=256):
            found = sketches(*weighted(*shingles(texts)), len(texts))
            with_words = found[:, 0] != _EMPTY
            bands = pa.array(list(band_keys(found[with_words])), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column("key").filter(pa.array(with_words)), bands], names=["key", "bands"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets as sorted elements and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def linked_texts(nodes: list[int], groups: list[int], texts: list[str]) -> list[tuple[int, int]]:
    """Links that connect the groups of some texts, from all their similarities at once.

    The k-th occurrence of an element is an element of its own, so weighted similarity is that of sets. Shared elements are
    counted by products of 0/1 matrices, a bounded number of elements at a time.
    """
    elements, counts, owner = weighted(*shingles(pa.array([t.encode() for t in texts], pa.binary())))
    whole = counts.astype(np.int64)
    owner = np.repeat(owner, whole)
    elements = mixed(np.repeat(elements, whole) + ranges(np.zeros(len(whole), dtype=np.int64), whole).astype(np.uint64))
    sizes = np.bincount(owner, minlength=len(nodes)).astype(np.float64)
    _, column, uses = np.unique(elements, return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    both = np.zeros((len(nodes), len(nodes)))
    width = 8192
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at = slice(*np.searchsorted(column, [low, low + width]))
        part = np.zeros((len(nodes), width), dtype=np.float32)
        part[owner[at], column[at] - low] = 1
        both += part @ part.T
    joined, links = Joined(groups), []
    a, b = np.nonzero(np.triu(both >= SIMILARITY * (sizes[:, None] + sizes[None, :] - both), 1) & (np.triu(both, 1) > 0))
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if joined.join(groups[x], groups[y]):
            links.append((nodes[x], nodes[y]))
    return links


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text_a, text_b) whose texts are near."""
    for batch in batches:
        for rows, texts in text_slices(batch, column="text_a", limit=1 << 20):
            sets = []
            for side in (texts, rows.column("text_b").cast(pa.binary())):
                elements, counts, owner = weighted(*shingles(side))
                edges = np.searchsorted(owner, np.arange(len(side) + 1))
                sets.append([(elements[lo:hi], counts[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:], strict=True)])
            near = [similarity(x, y) >= SIMILARITY for x, y in zip(*sets, strict=True)]
            yield rows.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, class_id (doc_id of the one that stays), class_size, kept, and
    text_key (MD5 of the text)."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.md5(F.coalesce("text", F.lit(""))).alias("key")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    facts = settle(keyed.select("doc_id", "key", F.monotonically_increasing_id().alias("row")), "near-facts")
    nodes = facts.groupBy("key").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = settle(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    sketched = settle(keyed.select("key", "text").mapInArrow(_sketched, "key string, bands array<long>"), "near-bands")
    banded = sketched.dropDuplicates(["key"]).join(nodes.select("key", "node"), "key")
    members = settle(banded.select(F.explode("bands").alias("bucket"), "node"), "near-members")
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("weight"))
    shared = settle(shared.where("low <> high").select("bucket", "weight"), "near-buckets")
    members = settle(attach_by_key(members, shared, "bucket", "weight"), "near-shared")
    wanted = members.select("node").distinct().join(nodes.select("node", "key"), "node")
    texts = keyed.select("key", "text").join(wanted.hint("merge"), "key").dropDuplicates(["key"]).select("node", "text")
    texts = settle(texts, "near-texts")

    def near(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            side = texts.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}"))
            pairs = pairs.join(side.hint("merge"), end)
        return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long")

    contents = texts.select("node", F.col("text").alias("content"), F.length("text").alias("weight"))
    groups = linked_groups(members, near, contents, linked_texts)
    grouped = nodes.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    grouped = settle(grouped.select("key", "group", "first", "copies"), "near-grouped")
    sizes = grouped.groupBy("group").agg(F.min("first").alias("best"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("weight"))
    named = attach_by_key(grouped.select("key", "group", "copies"), settle(sizes, "near-sizes"), "group", "weight")
    told = settle(
        named.select("key", "class_size", F.col("best.doc_id").alias("class_id"), F.col("best.row").alias("best_row"), F.col("copies").alias("weight")),
        "near-classes",
    )
    return attach_by_key(facts, told, "key", "weight").select(
        "doc_id", "class_id", "class_size", (F.col("row") == F.col("best_row")).alias("kept"), F.col("key").alias("text_key")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Of rows that repeat a doc_id with the same text, one stays."""
    kept = classes(docs).where("kept").select("doc_id", "text_key")
    name = free_name(docs, "text_key")
    keyed = docs.withColumn(name, F.md5(F.coalesce("text", F.lit(""))))
    same = keyed["doc_id"].cast("long").eqNullSafe(kept["doc_id"]) & (keyed[name] == kept["text_key"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)

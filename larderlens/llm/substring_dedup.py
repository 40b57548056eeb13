"""Substring dedup with suffix automata: passages of 50 words or more that an earlier document has are taken out.

A window is WINDOW consecutive words. A word goes if a window over it also starts in a document with a smaller doc_id
(null comes after all others; equal ids do not remove from each other). Windows are judged on the input.

1. Every document is winnowed: of the hashes of its 25-word runs those are anchors that are least in some window of
   WINDOW words, so equal windows have equal anchors. Anchors that two documents share mark the stretches in which
   shared windows can lie; the rest of the text takes no further part.
2. The windows of these stretches are hashed, and each hash is folded to the first place that has it. A place is a
   shard: SHARD windows of one document, in document order. This gives each shard the earlier shards that may hold
   its windows: one for each of its windows, so a passage shared by many documents leads all of them to its first.
3. A suffix automaton is built from the words of each reference shard, and the shards led to it are streamed through it.
   Where the matching statistic reaches WINDOW, the words are taken out. Hashes only choose what is compared.

A reference shard has at most SHARD + WINDOW - 1 words and so has what is sent with it. Hot anchors, windows and
reference shards are folded before shuffles, met by bounded broadcasts, or left to skew-join splitting.
Null, empty and short texts keep all their words. Rows that repeat a document get the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlens.functions.skew import attach_by_key
from larderlens.llm.common import Words, free_name, ranges, settle, spread, text_slices, window_hashes

WINDOW = 50
ANCHOR = 25
SHARD = 256

# A place is one number: range partition of the document, number in it, shard. It sorts as doc_id does.
MOST_PARTITIONS = 4096
_DOC_BITS, _SHARD_BITS = 30, 20


def _sliding(values: np.ndarray, size: int, of) -> np.ndarray:
    """Least or greatest of each `size` consecutive values, in about log2(size) steps."""
    width = 1
    while 2 * width <= size:
        values = of(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return of(values[:-rest], values[rest:]) if rest else values


def anchors(hashes: np.ndarray, edges: np.ndarray, size: int = ANCHOR, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed runs of `size` words: their hashes and first words."""
    held = window_hashes(hashes, size)
    span = window - size + 1
    if len(held) < span:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    owner = spread(edges)
    within = owner[: len(owner) - window + 1] == owner[window - 1 :]  # windows, by their first word
    least = np.where(within, _sliding(held, span, np.minimum), np.uint64(0))
    padded = np.concatenate([np.zeros(span - 1, dtype=np.uint64), least, np.zeros(span - 1, dtype=np.uint64)])
    greatest = _sliding(padded, span, np.maximum)
    at = np.flatnonzero((greatest == held) & (greatest > 0))
    return held[at], at


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _winnowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, key, n_words, all_sha256, anchors, spots."""
    for batch in batches:
        for rows, texts in text_slices(batch, limit=2 << 20):
            words = Words(texts)
            found, at = anchors(words.hashes(), words.edges)
            cut = np.searchsorted(at, words.edges)
            spots = (at - np.repeat(words.edges[:-1], np.diff(cut))).astype(np.int32)
            cut = pa.array(cut, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("key"),
                    pa.array(np.diff(words.edges), pa.int64()),
                    pa.array([_digest(t.split()) for t in texts.to_pylist()], pa.string()),
                    pa.ListArray.from_arrays(cut, pa.array(found.view(np.int64))),
                    pa.ListArray.from_arrays(cut, pa.array(spots)),
                ],
                names=["doc_id", "key", "n_words", "all_sha256", "anchors", "spots"],
            )


def _stretches(spots: np.ndarray, n_words: int) -> list[tuple[int, int]]:
    """Stretches of words that hold all windows around the anchors at `spots` (sorted)."""
    lows = np.maximum(spots - (WINDOW - ANCHOR), 0)
    highs = np.minimum(spots + WINDOW, n_words)
    new = np.flatnonzero(np.r_[True, lows[1:] > highs[:-1]])
    return list(zip(lows[new].tolist(), highs[np.r_[new[1:] - 1, len(highs) - 1]].tolist(), strict=True))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """window (hash), place, of all windows in the stretches of each document (place, text, spots)."""
    for batch in batches:
        for rows, texts in text_slices(batch, limit=2 << 20):
            words = Words(texts)
            held = window_hashes(words.hashes(), WINDOW)
            out_hash, out_place = [], []
            for n, (place, spots) in enumerate(zip(rows.column("place").to_pylist(), rows.column("spots").to_pylist(), strict=True)):
                begin, end = int(words.edges[n]), int(words.edges[n + 1])
                found = _stretches(np.array(spots, dtype=np.int64), end - begin)
                starts = np.array([lo for lo, _ in found])
                lengths = np.array([max(hi - lo - WINDOW + 1, 0) for lo, hi in found])
                at = np.unique(ranges(starts, lengths))
                out_hash.append(held[begin + at])
                out_place.append(place + at // SHARD)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_hash).view(np.int64)), pa.array(np.concatenate(out_place))], names=["window", "place"]
            )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place, words (joined by spaces), of all shards with anchors of each document."""
    for batch in batches:
        for rows, texts in text_slices(batch, limit=2 << 20):
            places, held = [], []
            for place, spots, text in zip(
                rows.column("place").to_pylist(), rows.column("spots").to_pylist(), texts.to_pylist(), strict=True
            ):
                words, found = text.split(), np.array(spots, dtype=np.int64)
                starts = np.unique(np.concatenate([np.maximum(found - (WINDOW - ANCHOR), 0) // SHARD, found // SHARD]))
                for shard in starts.tolist():
                    places.append(place + shard)
                    held.append(b" ".join(words[shard * SHARD : (shard + 1) * SHARD + WINDOW - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(held, pa.binary())], names=["place", "words"])


class SuffixAutomaton:
    """All runs of words of a text, as states with the longest run and the fallback of each."""

    def __init__(self, words: list[bytes]):
        self.step: list[dict[bytes, int]] = [{}]
        self.length, self.fallback = [0], [-1]
        step, length, fallback = self.step, self.length, self.fallback
        last = 0
        for word in words:
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            fallback.append(0)
            state = last
            while state >= 0 and word not in step[state]:
                step[state][word] = new
                state = fallback[state]
            if state >= 0:
                onto = step[state][word]
                if length[onto] == length[state] + 1:
                    fallback[new] = onto
                else:
                    twin = len(step)
                    step.append(dict(step[onto]))
                    length.append(length[state] + 1)
                    fallback.append(fallback[onto])
                    while state >= 0 and step[state].get(word) == onto:
                        step[state][word] = twin
                        state = fallback[state]
                    fallback[onto] = fallback[new] = twin
            last = new

    def statistics(self, words: list[bytes]) -> Iterator[int]:
        """For each word, how long a run that ends with it is in the text."""
        step, length, fallback = self.step, self.length, self.fallback
        state, size = 0, 0
        for word in words:
            while state and word not in step[state]:
                state = fallback[state]
                size = length[state]
            if word in step[state]:
                state = step[state][word]
                size += 1
            yield size


def matched_spans(automaton: SuffixAutomaton, words: list[bytes], least: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of words covered by runs of at least `least` words that the automaton knows."""
    spans: list[tuple[int, int]] = []
    for at, size in enumerate(automaton.statistics(words)):
        if size >= least:
            low = at + 1 - size
            if spans and low <= spans[-1][1]:
                spans[-1] = (min(low, spans[-1][0]), at + 1)
            else:
                spans.append((low, at + 1))
    return spans


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place, low, high: spans of each shard's document that its reference shard has."""
    known, automaton = None, None
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        columns = (batch.column(c).to_pylist() for c in ("place", "words", "first", "reference"))
        for place, words, first, reference in zip(*columns, strict=True):
            if first != known:
                known, automaton = first, SuffixAutomaton(reference.split())
            begin = (place & ((1 << _SHARD_BITS) - 1)) * SHARD
            out += [(place, begin + low, begin + high) for low, high in matched_spans(automaton, words.split())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[n] for x in out], pa.int64()) for n in range(3)], names=["place", "low", "high"]
        )


def remove_spans(text: bytes, lows: list[int], highs: list[int]) -> tuple[bytes, int]:
    """A text without the words that a span covers, and how many those are. What stays keeps its white space; where words
    went, the white space in front of the next word stays."""
    words = Words(pa.array([text], pa.binary()))
    starts, ends = words.starts, words.ends
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(cover, lows, 1)
    np.add.at(cover, highs, -1)
    gone = np.cumsum(cover)[:-1] > 0
    step = np.flatnonzero(np.diff(np.r_[True, gone, True])).reshape(-1, 2)
    parts: list[bytes] = []
    for low, high in step.tolist():
        parts.append(text[ends[low - 1] if parts else starts[low] : ends[high - 1]])
    return b"".join(parts), int(gone.sum())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, key, n_removed, kept_sha256, kept (text): the documents that lose words."""
    for batch in batches:
        for rows, texts in text_slices(batch):
            kept, removed = [], []
            for text, spans in zip(texts.to_pylist(), rows.column("spans").to_pylist(), strict=True):
                left, n = remove_spans(text, [s["low"] for s in spans], [s["high"] for s in spans])
                kept.append(left)
                removed.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("key"),
                    pa.array(removed, pa.int64()),
                    pa.array([_digest(k.split()) for k in kept], pa.string()),
                    pa.array([k.decode() for k in kept], pa.string()),
                ],
                names=["doc_id", "key", "n_removed", "kept_sha256", "kept"],
            )


def _doc_of(place: str) -> Column:
    return F.shiftright(place, _SHARD_BITS)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def _same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["key"] == right["key"])


def shortened(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For `docs` (doc_id, text): doc_id, key, n_words and all_sha256 of every row; and doc_id, key, n_removed,
    kept_sha256 (of the remaining words joined by one space) and kept (the remaining text) of the documents that lose words.
    `key` is the hash of the text."""
    keyed = _keyed(docs)
    winnowed = keyed.mapInArrow(
        _winnowed, "doc_id long, key long, n_words long, all_sha256 string, anchors array<long>, spots array<int>"
    )
    facts = settle(winnowed.withColumn("id", F.monotonically_increasing_id()), "substring-facts")
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1))

    # Anchors of two documents or more, and the stretches around them.
    sown = facts.select(order.alias("ord"), F.explode("anchors").alias("anchor"))
    shared = sown.groupBy("anchor").agg(F.min("ord").alias("low"), F.max("ord").alias("high"), F.count(F.lit(1)).alias("weight"))
    shared = settle(shared.where("low < high").select("anchor", "weight"), "substring-anchors")
    spotted = facts.select("id", F.explode(F.arrays_zip("anchors", "spots")).alias("x")).select("id", "x.spots", F.col("x.anchors").alias("anchor"))
    spotted = attach_by_key(spotted, shared, "anchor", "weight").groupBy("id").agg(F.array_sort(F.collect_set("spots")).alias("spots"))
    marked = spotted.join(facts.select("id", "doc_id", "key"), "id").dropDuplicates(["doc_id", "key"])
    parts = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_PARTITIONS)
    marked = marked.select("doc_id", "key", "spots").repartitionByRange(parts, order, "key").sortWithinPartitions(order, "key")
    number = F.monotonically_increasing_id()
    place = F.shiftleft(F.shiftleft(F.shiftright(number, 33), _DOC_BITS) + number.bitwiseAND((1 << 33) - 1), _SHARD_BITS)
    marked = settle(marked.withColumn("place", place), "substring-marked")
    own = marked.withColumnsRenamed({"doc_id": "own_id", "key": "own_key"})
    texts = keyed.join(own.hint("merge"), keyed["doc_id"].eqNullSafe(own["own_id"]) & (keyed["key"] == own["own_key"]))
    texts = settle(texts.dropDuplicates(["place"]).select("doc_id", "key", "place", "spots", "text"), "substring-texts")

    # From each shard to the first shards that have its windows.
    windows = texts.select("place", "spots", "text").mapInArrow(_windows, "window long, place long")
    windows = settle(windows, "substring-windows")
    firsts = windows.groupBy("window").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("weight"))
    firsts = settle(firsts.where(_doc_of("first") < _doc_of("last")).select("window", "first", "weight"), "substring-firsts")
    led = attach_by_key(windows, firsts, "window", "weight").where(_doc_of("first") < _doc_of("place")).select("place", "first").distinct()
    # Rows that repeat a doc_id have numbers of their own, one after the other: what counts is the first of them.
    numbered = marked.select(order.alias("ord"), _doc_of("place").alias("doc"))
    repeated = numbered.groupBy("ord").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("weight"))
    repeated = settle(repeated.where("least < most").select("ord", "least", "weight"), "substring-repeated")
    if not repeated.isEmpty():
        least = settle(attach_by_key(numbered, repeated, "ord", "weight").select("doc", "least"), "substring-least")
        led = led.withColumn("doc", _doc_of("place")).join(least.hint("merge"), "doc", "left")
        led = led.where(F.col("least").isNull() | (_doc_of("first") < F.col("least"))).select("place", "first")
    led = settle(led, "substring-led")

    # The matching itself.
    shards = settle(texts.select("place", "spots", "text").mapInArrow(_shards, "place long, words binary"), "substring-shards")
    pairs = led.join(shards.hint("merge"), "place")
    pairs = pairs.join(shards.select(F.col("place").alias("first"), F.col("words").alias("reference")).hint("merge"), "first")
    spans = settle(
        pairs.select("place", "words", "first", "reference").mapInArrow(_streamed, "place long, low long, high long"), "substring-spans"
    )
    spans = spans.groupBy(_doc_of("place").alias("doc")).agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    losing = texts.withColumn("doc", _doc_of("place")).join(spans.hint("merge"), "doc")
    cut = losing.select("doc_id", "key", "text", "spans").mapInArrow(_cut, "doc_id long, key long, n_removed long, kept_sha256 string, kept string")
    return facts.select("doc_id", "key", "n_words", "all_sha256"), settle(cut, "substring-cut")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of `docs` (doc_id, text)."""
    facts, cut = shortened(docs)
    # One short row per document that loses words; documents that repeat are few, and both sides are small.
    lost = cut.select("doc_id", "key", "n_removed", "kept_sha256").hint("merge")
    told = facts.join(lost, _same_document(facts, lost), "left")
    return told.select(
        facts["doc_id"], "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256")
    )


def shorten(docs: DataFrame) -> DataFrame:
    """`docs` with the text of each document that loses words replaced by what is left; it may be empty.

    All other texts stay as they are. If there is an n_chars column of a whole-number type it is set to the new length.
    """
    _, cut = shortened(docs)
    key, kept, own = (free_name(docs, wish) for wish in ("key", "kept", "own_id"))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    lost = cut.select(F.col("doc_id").alias(own), F.col("key").alias(f"{own}_key"), F.col("kept").alias(kept)).hint("merge")
    joined = keyed.join(lost, keyed["doc_id"].cast("long").eqNullSafe(lost[own]) & (keyed[key] == lost[f"{own}_key"]), "left")
    kinds = {f.name: f.dataType for f in docs.schema}
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.coalesce(kept, "text").alias("text"))
        elif name == "n_chars" and kinds[name].typeName() in ("long", "integer"):
            columns.append(F.coalesce(F.length(kept).cast(kinds[name]), "n_chars").alias("n_chars"))
        else:
            columns.append(F.col(name))
    return joined.select(*columns)

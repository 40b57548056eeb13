"""Phrase collocation mining with FM-indexes of shards.

Each task gathers its texts into shards of bounded size, each of one language and over word ids of its own, and builds two FM-indexes of a shard:
of its text and of the reversed text. A pattern is an interval in both, and is extended by one word to either side with the
Burrows-Wheeler transform of one index while its interval in the other is kept in step; all patterns are extended at once.
Counts of shards are summed over all of them by hashes of the words.

Two passes read the texts. The first extends words to the right and gives the counts of all pairs. The second counts words
and extends pairs to the right and then to the left, which gives triples. It extends only pairs that two bit filters of frequent pairs
and words let through; what a filter lets through beyond them costs work but changes nothing, as counts below the
threshold go in the end. So a filter has a fixed size, however many frequent pairs there are.

A-Z are lower-cased, texts are cut into pieces at `[.,;:!?\\x0A-\\x0D]` and these into words `[^\\x20\\x09]+`. Null texts are empty, a
null language is `und`; rows that repeat count each time, and ids play no part. Products are exact (38 decimal digits).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larderlens.functions.skew import widen
from larderlens.llm.common import Words, flat_bytes, mixed, ranges, settle, text_slices

MIN_COUNT = 10
COVERED_PERCENT = 50
TOP = 2000
UNKNOWN = "und"
# Text of a shard, and what a task gathers of all languages before it makes shards of them.
SHARD_BYTES, GATHERED_BYTES = 2 << 20, 4 << 20
# Rows that a task hands on at once: both sides hold them.
SENT_ROWS = 1 << 15
# Text that is cut into words at once.
CUT_BYTES = 1 << 20
# Bits of a filter: 2^27 for pairs and 2^25 for words, 20 MB in all whatever the corpus.
PAIR_BITS, WORD_BITS = 27, 25
BITMAP_BITS = 32_768  # of one bitmap of Spark's

COUNTS = "lang string, word string, h1 long, h2 long, h3 long, n long"


class PieceWords(Words):
    """Lower-cased words of texts, and the piece that each lies in."""

    def __init__(self, texts: pa.Array):
        data, self.text_edges = flat_bytes(texts)
        self.data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        cut = (data >= 10) & (data <= 13)
        for sign in b".,;:!?":
            cut |= data == sign
        dark = np.zeros(len(data) + 2, dtype=bool)
        dark[1:-1] = ~(cut | (data == 32) | (data == 9))
        step = dark[1:] != dark[:-1]
        starts, ends = np.flatnonzero(step & dark[1:]), np.flatnonzero(step & dark[:-1])
        inner = self.text_edges[1:-1]
        inner = np.unique(inner[(inner > 0) & (inner < len(data))])
        meet = inner[dark[inner] & dark[inner + 1]]  # a word does not run on into the next text
        self.starts, self.ends = np.sort(np.concatenate([starts, meet])), np.sort(np.concatenate([ends, meet]))
        marks = cut.astype(np.int32)
        marks[inner] += 1
        self.pieces = np.cumsum(marks, dtype=np.int64)[self.starts]


class FMIndex:
    """The Burrows-Wheeler transform of a cyclic text of symbols, in the order of suffixes up to `depth` symbols.

    Patterns of up to `depth` symbols have the same intervals as in full order.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        width = max(1, int(symbols - 1).bit_length())
        if width * depth <= 64:
            key = np.zeros(len(text), dtype=np.uint64)
            for k in range(depth):
                key = (key << np.uint64(width)) | np.roll(text, -k).astype(np.uint64)
            places = np.argsort(key)
        else:
            places = np.lexsort([np.roll(text, -k) for k in range(depth - 1, -1, -1)])
        self.bwt = text[places - 1]
        packed = (self.bwt.astype(np.uint64) << np.uint64(32)) | np.arange(len(text), dtype=np.uint64)
        packed.sort()
        # Places by symbol, then order: that of rank r is where LF leads to r.
        self.by_symbol = (packed & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Intervals:
    """Patterns as intervals of one size in two indexes, and what each pattern is."""

    def __init__(self, size: np.ndarray, low: np.ndarray, reverse_low: np.ndarray, words: list[np.ndarray]):
        self.size, self.low, self.reverse_low, self.words = size, low, reverse_low, words

    def where(self, chosen: np.ndarray) -> Intervals:
        return Intervals(self.size[chosen], self.low[chosen], self.reverse_low[chosen], [w[chosen] for w in self.words])


class BidirectionalIndex:
    """FM-indexes of a text and of its reverse. Symbol 0 stands between pieces and is never part of a pattern."""

    def __init__(self, text: np.ndarray, symbols: int, forward_depth: int, reverse_depth: int):
        self.length = len(text)
        self.counts = np.bincount(text, minlength=symbols)
        self.forward = FMIndex(text, symbols, forward_depth) if forward_depth else None
        self.reverse = FMIndex(text[::-1], symbols, reverse_depth)

    def words(self) -> Intervals:
        """All single symbols but 0."""
        low = np.cumsum(self.counts) - self.counts
        return Intervals(self.counts[1:], low[1:], low[1:], [np.arange(1, len(self.counts))])

    def extended(self, patterns: Intervals, left: bool) -> Intervals:
        """All extensions that occur of `patterns` (disjoint intervals) by one symbol to the left or to the right."""
        index = self.forward if left else self.reverse
        low, other = (patterns.low, patterns.reverse_low) if left else (patterns.reverse_low, patterns.low)
        of = np.full(self.length, -1, dtype=np.int32)
        of[ranges(low, patterns.size)] = np.repeat(np.arange(len(low), dtype=np.int32), patterns.size)
        held = of[index.by_symbol]
        rank = np.flatnonzero(held >= 0)
        parent, symbol = held[rank], index.bwt[index.by_symbol[rank]]
        # Places of one symbol and one pattern follow each other: each run is an extension, and its rank is where it begins.
        first = np.flatnonzero(np.diff(parent, prepend=-1) | np.diff(symbol, prepend=-1)) if len(rank) else rank
        size = np.diff(first, append=len(rank))
        parent, symbol, new_low = parent[first], symbol[first], rank[first]
        # In the other index, extensions of a pattern divide its interval in the order of their symbols.
        order = np.argsort(parent, kind="stable")
        inside = np.cumsum(size[order]) - size[order]
        begins = np.flatnonzero(np.diff(parent[order], prepend=-1))
        within = inside - np.repeat(inside[begins], np.diff(begins, append=len(order)))
        new_other = np.empty_like(new_low)
        new_other[order] = other[parent[order]] + within
        words = [w[parent] for w in patterns.words]
        words = [symbol, *words] if left else [*words, symbol]
        found = Intervals(size, new_low, new_other, words) if left else Intervals(size, new_other, new_low, words)
        return found.where(symbol > 0)


def filter_places(hashes: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each item, as Spark's side computes them too."""
    shift = np.uint64(64 - bits)
    joined = hashes[0].view(np.uint64)
    for h in hashes[1:]:
        joined = (joined << np.uint64(1) | joined >> np.uint64(63)) ^ h.view(np.uint64)
    return (joined >> shift).astype(np.int64), ((joined * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)


class BitFilter:
    """A set of items by two bits each; it holds all that were put in, and some others."""

    def __init__(self, bits: int, held: bytes):
        self.bits, self.held = bits, np.frombuffer(held, dtype=np.uint8)

    def passes(self, *hashes: np.ndarray) -> np.ndarray:
        first, second = filter_places(list(hashes), self.bits)
        return self._has(first) & self._has(second)

    def _has(self, at: np.ndarray) -> np.ndarray:
        return (self.held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def place_batches(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The bits of items whose columns are hashes."""
    for batch in batches:
        hashes = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(filter_places(hashes, bits))))], names=["at"])


def bit_filter(items: DataFrame, bits: int) -> BitFilter:
    """A filter of all rows of `items` (hash columns). Bits are put together by the executors; the driver gets 2^bits of them."""
    at = items.mapInArrow(lambda batches: place_batches(batches, bits), "at long")
    maps = at.groupBy(F.floor(F.col("at") / BITMAP_BITS).alias("bucket")).agg(F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("map"))
    held = bytearray(max(1, (1 << bits) // 8))
    for row in maps.collect():
        start = row.bucket * BITMAP_BITS // 8
        held[start : start + BITMAP_BITS // 8] = row.map[: len(held) - start]
    return BitFilter(bits, bytes(held))


def bounded(texts: pa.Array, limit: int = CUT_BYTES) -> pa.Array:
    """The texts, with long ones cut at ends of pieces, which no phrase crosses."""
    if len(texts) > 1 or not len(texts) or len(texts[0].as_py()) <= 2 * limit:
        return texts
    data, _ = flat_bytes(texts)
    ends = np.flatnonzero(np.isin(data, np.frombuffer(b".,;:!?\n\x0b\x0c\r", dtype=np.uint8)))
    at = ends[np.unique(np.searchsorted(ends, np.arange(limit, len(data), limit)).clip(max=max(len(ends) - 1, 0)))] if len(ends) else []
    edges = [0, *(int(e) + 1 for e in at), len(data)]
    return pa.array([data[lo:hi].tobytes() for lo, hi in zip(edges[:-1], edges[1:], strict=True)], pa.binary())


class Shard:
    """Words of texts of one language: their hashes and pieces, and where they are spelled."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.data = bytearray()
        self.pieces_before = 0

    def add(self, texts: pa.Array) -> None:
        words = PieceWords(texts)
        if not len(words.starts):
            return
        self.parts.append((words.hashes(), words.pieces + self.pieces_before, words.starts + len(self.data), words.ends + len(self.data)))
        self.pieces_before += int(words.pieces[-1]) + 1
        self.data += words.data.tobytes()

    def joined(self) -> Shard:
        self.hashes, self.pieces, self.starts, self.ends = (np.concatenate(column) for column in zip(*self.parts, strict=True))
        self.parts = []
        return self


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Shard]]:
    """Shards of a task's texts, for each language some of bounded size."""
    held: dict[str, Shard] = {}
    for batch in batches:
        for rows, texts in text_slices(batch, limit=CUT_BYTES):
            langs = rows.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                parts = bounded(texts.filter(pc.equal(langs.indices, code)))
                step = len(parts) if len(parts) == len(rows) or len(rows) > 1 else 1
                for at in range(0, len(parts), max(1, step)):
                    held.setdefault(lang, Shard()).add(parts.slice(at, step))
                    full = len(held[lang].data) >= SHARD_BYTES
                    if full or sum(len(s.data) for s in held.values()) >= GATHERED_BYTES:
                        most = lang if full else max(held, key=lambda name: len(held[name].data))
                        yield most, held.pop(most).joined()
    for lang, shard in held.items():
        if shard.parts:
            yield lang, shard.joined()


def numbered(words: Shard, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shard as symbols with 0 before, between and after pieces; the hash of each symbol; and where it first occurs."""
    hashes, first, ids = np.unique(words.hashes, return_index=True, return_inverse=True)
    # Words of different languages are different things.
    salt = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), dtype=np.uint64)
    hashes = mixed(hashes ^ salt).view(np.int64)
    gaps = np.flatnonzero(np.diff(words.pieces))
    ends = np.zeros(1, dtype=np.int32)
    text = np.insert(ids.astype(np.int32) + 1, gaps + 1, 0)
    return np.concatenate([ends, text, ends]), hashes, first


def _counts(lang=None, word=None, h1=None, h2=None, h3=None, n=None) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    columns = (lang, word, h1, h2, h3, n)
    arrays = [pa.nulls(len(n), k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "h1", "h2", "h3", "n"])


def _sent(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a shard, some at a time; what they took is free for the next shard after that."""
    for at in range(0, len(batch), SENT_ROWS):
        yield batch.slice(at, SENT_ROWS)
    del batch
    pa.default_memory_pool().release_unused()


def pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h1, h2, n: the pairs of each shard."""
    for lang, words in shards(batches):
        text, hashes, _ = numbered(words, lang)
        index = BidirectionalIndex(text, len(hashes) + 1, 0, 2)
        pairs = index.extended(index.words(), left=False)
        columns = [pa.array(hashes[w - 1]) for w in pairs.words] + [pa.array(pairs.size)]
        del words, text, hashes, index, pairs
        yield from _sent(pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "n"]))


def word_and_triple_batches(batches: Iterator[pa.RecordBatch], pair_filter: BitFilter, word_filter: BitFilter) -> Iterator[pa.RecordBatch]:
    """Counts of all words of a language together (no word), of words of frequent pairs, and of triples made of them."""
    for lang, words in shards(batches):
        text, hashes, first = numbered(words, lang)
        index = BidirectionalIndex(text, len(hashes) + 1, 3, 2)
        singles = index.words()
        singles = singles.where(word_filter.passes(hashes[singles.words[0] - 1]))
        at = first[singles.words[0] - 1]
        held = bytes(words.data)
        spelled = [held[a:b].decode(errors="replace") for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]
        total, held = len(words.starts), None
        del words, first, at
        yield _counts([lang], n=[total])
        yield from _sent(_counts([lang] * len(spelled), spelled, hashes[singles.words[0] - 1], n=singles.size))
        del spelled
        pairs = index.extended(singles, left=False)
        pairs = pairs.where(pair_filter.passes(*(hashes[w - 1] for w in pairs.words)))
        triples = index.extended(pairs, left=True)
        triples = triples.where(pair_filter.passes(*(hashes[w - 1] for w in triples.words[:2])))
        counts = _counts(None, None, *(hashes[w - 1] for w in triples.words), triples.size)
        del text, hashes, index, singles, pairs, triples
        yield from _sent(counts)


def mine(docs: DataFrame, min_count: int = MIN_COUNT, covered_percent: int = COVERED_PERCENT, top: int = TOP, bits: tuple[int, int] = (PAIR_BITS, WORD_BITS)) -> DataFrame:
    """The best phrases of each language of `docs` (lang, text): lang, rank, phrase, a, l, r, n, score."""
    texts = widen(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text"))
    pairs = texts.mapInArrow(pair_batches, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    pairs = settle(pairs.where(F.col("n") >= min_count), "pairs")

    context = docs.sparkSession.sparkContext
    of_words = pairs.select(F.explode(F.array("h1", "h2")).alias("h")).distinct()
    sent = context.broadcast((bit_filter(pairs.select("h1", "h2"), bits[0]), bit_filter(of_words, bits[1])))
    counts = texts.mapInArrow(lambda batches: word_and_triple_batches(batches, *sent.value), COUNTS)
    counts = counts.groupBy("lang", "word", "h1", "h2", "h3").agg(F.sum("n").alias("n"))
    counts = settle(counts.where((F.col("n") >= min_count) | F.col("h1").isNull()), "words-and-triples")
    totals = counts.where(F.col("h1").isNull()).select("lang", "n")
    words = counts.where(F.col("h1").isNotNull() & F.col("h2").isNull()).select("lang", "word", F.col("h1").alias("h"), "n")
    triples = counts.where(F.col("h3").isNotNull()).select("h1", "h2", "h3", F.col("n").alias("a"))
    return best_phrases(pairs, words, triples, totals, covered_percent, top)


def best_phrases(pairs: DataFrame, words: DataFrame, triples: DataFrame, totals: DataFrame, covered_percent: int, top: int) -> DataFrame:
    """Scores of all cuts, phrases that longer ones cover left out, the first `top` of each language."""

    def word(at: str, name: str) -> DataFrame:
        return words.select(F.col("h").alias(at), F.col("n").alias(name))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return pairs.select(F.col("h1").alias(first), F.col("h2").alias(second), F.col("n").alias(name))

    # Counts are looked up in plain joins, of which Spark splits what a frequent word makes uneven.
    two = pairs.withColumnRenamed("n", "a").join(word("h1", "l"), "h1").join(word("h2", "r"), "h2")
    covers = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    covers = covers.groupBy("h1", "h2").agg(F.max("a").alias("longer"))
    two = two.join(covers, ["h1", "h2"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * covered_percent, F.lit(True)))
    two = two.select("h1", "h2", F.lit(None).cast("long").alias("h3"), "a", F.array(_cut("l", "r", 1)).alias("cuts"))

    three = triples.join(word("h1", "l1"), "h1").join(word("h3", "r2"), "h3")
    three = three.join(pair("h2", "h3", "r1"), ["h2", "h3"]).join(pair("h1", "h2", "l2"), ["h1", "h2"])
    three = three.select("h1", "h2", "h3", "a", F.array(_cut("l1", "r1", 1), _cut("l2", "r2", 2)).alias("cuts"))

    scored = two.unionByName(three).select("h1", "h2", "h3", "a", F.array_min("cuts").alias("cut"))
    scored = scored.select("h1", "h2", "h3", "a", "cut.score", "cut.l", "cut.r")
    named = scored.join(words.select("lang", F.col("h").alias("h1"), F.col("word").alias("w1")), "h1")
    # All that tie with the last place go on, as their order is that of the phrases.
    ahead = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    chosen = settle(named.withColumn("ahead", ahead).where(F.col("ahead") <= top).drop("ahead"), "chosen-phrases")
    for at in ("2", "3"):
        spelled = words.select(F.col("h").alias(f"h{at}"), F.col("word").alias(f"w{at}"))
        chosen = chosen.join(spelled, f"h{at}", "left")
    phrase = F.concat_ws(" ", "w1", "w2", "w3")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = chosen.withColumn("phrase", phrase).withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals) if totals.count() < 100_000 else totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _cut(left: str, right: str, k: int):
    """score, k, l, r of one cut; structs compare by score, then k."""
    exact = lambda c: f"cast({c} AS decimal(19, 0))"
    score = F.expr(f"(1000000 * {exact('a')} * {exact('a')}) div ({exact(left)} * {exact(right)})")
    return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

"""Phrase mining: index steps against counting, the query against its SQL, and odd tables."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larderlens.llm import phrases
from larderlens.llm.phrases import BidirectionalIndex, BitFilter, PieceWords, mine


def brute_phrases(texts, min_count=10, covered=50, top=2000):
    """lang -> [(phrase, a, l, r, n, score)] from (lang, text)."""
    counts, totals = Counter(), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in (1, 2, 3):
                counts.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    candidates = {g: a for g, a in counts.items() if len(g) > 2 and a >= min_count}
    longer = Counter()
    for (lang, *words), a in candidates.items():
        if len(words) == 3:
            for part in (words[:2], words[1:]):
                longer[lang, *part] = max(longer[lang, *part], a)
    out = {}
    for (lang, *words), a in candidates.items():
        if 100 * longer[lang, *words] >= covered * a and longer[lang, *words]:
            continue
        cuts = [(counts[lang, *words[:k]], counts[lang, *words[k:]], k) for k in range(1, len(words))]
        score, _, left, right = min((1000000 * a * a // (lo * r), k, lo, r) for lo, r, k in cuts)
        out.setdefault(lang, []).append((" ".join(words), a, left, right, totals[lang], score))
    return {lang: sorted(rows, key=lambda x: (-x[5], -x[1], x[0].encode()))[:top] for lang, rows in out.items()}


def told(docs, **how):
    out = {}
    for r in sorted(mine(docs, **how).collect(), key=lambda r: (r.lang, r["rank"])):
        rows = out.setdefault(r.lang, [])
        rows.append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r["rank"] == len(rows)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60))
def test_intervals_are_those_of_all_occurrences(symbols):
    text = np.array([0, *symbols, 0])
    index = BidirectionalIndex(text, 5, 3, 3)
    words = index.words().where(index.words().size > 0)
    seen = text.tolist()
    for m, found in (
        (2, index.extended(words, left=True)),
        (2, index.extended(words, left=False)),
        (3, index.extended(index.extended(words, left=False), left=True)),
        (3, index.extended(index.extended(words, left=True), left=False)),
    ):
        want = Counter(tuple(seen[i : i + m]) for i in range(len(seen) - m + 1) if 0 not in seen[i : i + m])
        assert dict(zip(zip(*(w.tolist() for w in found.words), strict=True), found.size.tolist(), strict=True)) == want
        # Intervals of one index do not meet.
        for low in (found.low, found.reverse_low):
            order = np.argsort(low)
            assert (low[order][1:] >= low[order][:-1] + found.size[order][:-1]).all()


def test_words_and_pieces():
    texts = pa.array(["One TWO,three\tfour\nÉa b".encode(), b"", b"five.  ", b"six"], pa.binary())
    words = PieceWords(texts)
    held = words.data.tobytes()
    assert [held[a:b].decode() for a, b in zip(words.starts, words.ends, strict=True)] == ["one", "two", "three", "four", "Éa", "b", "five", "six"]
    assert np.diff(words.pieces).astype(bool).tolist() == [False, True, False, True, False, True, True]


def test_a_filter_that_lets_everything_through_changes_nothing(spark, monkeypatch, documents):
    docs = documents.limit(60)
    want = told(docs)
    monkeypatch.setattr(BitFilter, "_has", lambda self, at: np.ones(len(at), dtype=bool))
    assert told(docs, bits=(8, 8)) == want == told(docs, bits=(8, 8))


def test_equals_brute_force_also_with_many_small_shards(spark, documents, monkeypatch):
    texts = [(r.lang, r.text) for r in documents.select("lang", "text").collect()]
    want = brute_phrases(texts)
    assert told(documents) == want
    assert told(documents.repartition(13)) == want


def test_a_task_sends_few_rows_at_a_time(monkeypatch):
    # A shard's counts were one batch, however many they were.
    texts = [" ".join(f"w{n * 7919 % 5003}" for n in range(start, start + 2500)) for start in range(0, 10000, 2500)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(texts)], names=["lang", "text"])
    monkeypatch.setattr(phrases, "SENT_ROWS", 1000)
    sent = list(phrases.pair_batches(iter([batch])))
    every = BitFilter(8, b"\xff" * 32)
    more = list(phrases.word_and_triple_batches(iter([batch]), every, every))
    assert max(map(len, sent + more)) <= 1000 and sum(b.column("n").to_numpy().sum() for b in sent) == 4 * 2499
    assert sum(len(b) for b in more) > 2 * 5000 and more[0].to_pylist()[0]["n"] == 10000


@pytest.mark.parametrize("low", [1, 3])
def test_odd_documents(odd, none, low):
    texts = [(r.lang, r.text) for r in odd.select("lang", "text").collect()] + [(None, "A b c. a B c, \x0b a b\x0cc"), ("und", "a b"), ("en", None)]
    docs = odd.select("lang", "text").unionByName(odd.sparkSession.createDataFrame(texts[-3:], "lang string, text string"))
    assert told(docs, min_count=low) == brute_phrases(texts, min_count=low)
    assert told(none) == {}
    assert set(told(odd, min_count=low)) == {"en"}


def test_a_language_is_cut_at_its_first_phrases(spark, documents):
    want = {lang: rows[:5] for lang, rows in brute_phrases([(r.lang, r.text) for r in documents.select("lang", "text").collect()]).items()}
    assert told(documents, top=5) == want


def test_products_beyond_64_bits(spark):
    big = 3_000_000_001
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    pairs = frame([(1, 2, big)], "h1 long, h2 long, n long")
    words = frame([("en", "a", 1, big + 7), ("en", "b", 2, big + 9)], "lang string, word string, h long, n long")
    triples = frame([], "h1 long, h2 long, h3 long, a long")
    row = phrases.best_phrases(pairs, words, triples, frame([("en", 10 * big)], "lang string, n long"), 50, 10).first()
    assert row.score == 1000000 * big * big // ((big + 7) * (big + 9))

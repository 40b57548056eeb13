"""The conversation trie against brute force, with every way of cutting it."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larderlens.llm import conversation_trie
from larderlens.llm.common import settle
from larderlens.llm.conversation_trie import bands, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_trie(rows):
    """All nodes, from (conv_id, turn, role, text) without ties of turn."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = sorted(own.get(conv - conv % 5, []))
        paths[conv] = tuple(t[2:] for t in base[:h] + sorted(turns)[h:])
    members, children = defaultdict(list), defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        saved[node] = sum(saved[c] for c in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(paths[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def told(conversations, **how):
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie(conversations, **how).collect()), key=repr)


def plain(conversations):
    return [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture(scope="module")
def grown_together(spark):
    """Snapshots of one conversation after every turn, copies, a shared first turn, one very long one, and odd rows."""
    rows = [(5 * n, t, "user", f"turn {t}") for n in range(1, 30) for t in range(n)]
    rows += [(5 * n, t, "user", f"turn {t}") for n in range(100, 160) for t in range(4)]
    rows += [(5 * n, t, "user", "hello" if t == 0 else f"{n} {t}") for n in range(200, 260) for t in range(3)]
    rows += [(5000, t, "assistant", f"long {t}") for t in range(700)]
    rows += [(n, t, "user", f"é {n % 3}") for n in range(6001, 6060) for t in range(n % 12)]
    rows += [(7000, None, None, None), (7000, 1, None, "x"), (7003, None, "user", ""), (None, 0, "user", "lost"), (8004, 3, "a", "bc"), (8009, 3, "ab", "c")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


@pytest.mark.parametrize("cut_rows", [20_000, 300, 20])
def test_equals_brute_force_wherever_it_is_cut(grown_together, cut_rows):
    assert told(grown_together, cut_rows=cut_rows) == brute_trie(plain(grown_together))


@pytest.mark.parametrize("band_rows", [40, 2])
def test_equals_brute_force_with_every_way_of_banding(grown_together, band_rows):
    assert told(grown_together, cut_rows=20, band_rows=band_rows) == brute_trie(plain(grown_together))


def test_bands_cover_all_depths():
    assert list(bands([], 5)) == []
    assert list(bands([(0, 9)], 5)) == [(0, 0, 9)]
    assert list(bands([(4, 1), (3, 2), (2, 3), (1, 7), (0, 1)], 5)) == [(3, 4, 3), (2, 2, 3), (1, 1, 7), (0, 0, 1)]


def test_a_long_shared_beginning_takes_one_step(spark, monkeypatch):
    rows = [(5 * n, t, "user", f"turn {t}" if t < 50 + n % 9 else f"{n} {t}") for n in range(1, 41) for t in range(60)]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    names = []
    monkeypatch.setattr(conversation_trie, "settle", lambda frame, name: (names.append(name), settle(frame, name))[1])
    assert told(conversations, cut_rows=20) == brute_trie(rows)
    assert names.count("trunk-nodes") == 1


def test_equals_brute_force_on_conversations(spark, sf):
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    assert told(conversations) == brute_trie(plain(conversations))


def test_no_conversations_and_clashing_names(spark, grown_together):
    assert told(grown_together.limit(0)) == []
    few = grown_together.where("conv_id < 50")
    extra = {name: F.lit("clash") for name in ("base", "n", "digest", "place", "bytes", "head", "depth", "last", "cut")}
    assert told(few.withColumns(extra)) == brute_trie(plain(few))


def test_turns_of_one_number_are_in_one_order(spark):
    rows = [(5, 1, "user", t) for t in ("b", "a", "c", "a")]
    one, two = (told(spark.createDataFrame(r, "conv_id long, turn long, role string, text string")) for r in (rows, rows[::-1]))
    assert one == two and len(one) == 5

"""Sharding by virtual slots: the law of equal bytes, places without gaps, and versions of the map."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from larderlens.llm.common import new_path
from larderlens.llm.slot_shards import SlotMap, Unit, grown, rebalanced, shard_documents, slot_facts


def size_of(text):
    return 16 + len((text or "").encode())


def check(rows, texts, shards):
    """`texts`: how often each (doc_id, checksum, size) is in the input."""
    want = Counter((i, zlib.crc32((t or "").encode()), size_of(t)) for i, t in texts)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_are_near_equal_in_bytes(spark, documents, rows):
    docs = documents.unionByName(documents.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(documents.withColumn("doc_id", F.col("doc_id") + 2000))
    told = shard_documents(docs, shards=8).collect()
    check(told, [(i + n, t) for i, t in rows.items() for n in (0, 1000, 2000)], 8)
    loads = Counter()
    for r in told:
        loads[r.shard] += r.size
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) <= 0.01 * sum(loads.values()) / 8


def test_a_row_repeated_very_often_is_dealt_out(spark, documents):
    docs = documents.unionByName(documents.where("doc_id = 3").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("n"))
    loads = Counter()
    for r in shard_documents(docs, shards=5).collect():
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.05 * min(loads.values())


def test_odd_and_no_documents(spark, odd, none):
    check(shard_documents(odd).collect(), [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], 40)
    assert shard_documents(none).collect() == []


def test_the_slot_of_a_record_does_not_depend_on_its_place(documents):
    slots = [{r.doc_id: r.slot for r in slot_facts(docs).collect()} for docs in (documents, documents.repartition(7))]
    assert slots[0] == slots[1]


def test_versions_stay_and_growing_moves_rows_only_into_the_new_shard(spark, documents):
    facts = slot_facts(documents)
    slot_map = SlotMap(spark, new_path(spark, "test-map"))
    assert [slot_map.create(4), slot_map.rebalance(facts), slot_map.grow(), slot_map.rebalance(facts)] == [0, 1, 2, 3]
    assert slot_map.versions() == [0, 1, 2, 3]
    before, after = ({r.row: r.shard for r in slot_map.place(facts, v).collect()} for v in (1, 2))
    moved = [row for row in before if before[row] != after[row]]
    assert moved and all(after[row] == 4 for row in moved)
    assert slot_map.read(0).where("shard <> slot * 4 div 4096").isEmpty()  # version 0 is as it was
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        slot_map.create(4)


def test_balancing_closes_the_gap_and_moves_little():
    sizes = [(n * 7919) % 1000 + 1 for n in range(400)]
    units = [Unit(n, 1, 0, b, n * 8 // 400) for n, b in enumerate(sizes)]
    first = {u.slot: u.shard for u in units}
    loads = Counter()
    for u in rebalanced(units, 8):
        loads[u.shard] += u.bytes
    assert max(loads.values()) - min(loads.values()) <= 0.001 * sum(sizes) / 8
    assert sum(first[u.slot] != u.shard for u in units) < 100
    share = sum(sizes) / 9
    old = {u.slot: u.shard for u in units}
    new = grown(units, 8)
    assert all(u.shard in (old[u.slot], 8) for u in new)
    assert 0.9 * share <= sum(u.bytes for u in new if u.shard == 8) <= share

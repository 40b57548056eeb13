"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's slot is a hash of its id and its text's checksum, and never changes. Bytes are added up per slot, and a map
of a few thousand entries says which shard each slot belongs to. Balancing edits the map and stores it as a new version;
records are not hashed anew. A version is one file, written whole or not at all, and never changed afterwards.

Rows that are equal in id and text have one slot, so a slot can grow past its share. Such a slot is dealt out: its rows go
to as many parts as keep a part small, by a hash of the row, and the map holds an entry for each part.

A record takes the UTF-8 bytes of its text (null: none) and 16 more. All rows are kept: rows without an id, empty texts and
repeated rows are records like any other. Only ids, sizes and checksums are shuffled, never texts. No table of more than
`slots` entries and a few for each shard reaches the driver.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlens.llm.common import new_path, settle

SLOTS = 4096
SHARDS = 40
RECORD_BYTES = 16
# A slot that holds more than this share of a shard is dealt out in parts.
PART_SHARE = 8
# Exchanges between two shards after slots are moved; each lessens the gap.
EXCHANGES = 2000

MAP = "slot int, parts int, part int, shard int, bytes long, shards int"


class Unit:
    """A slot, or a part of one that is dealt out, with its bytes."""

    __slots__ = ("slot", "parts", "part", "bytes", "shard")

    def __init__(self, slot: int, parts: int, part: int, bytes_: int, shard: int = -1):
        self.slot, self.parts, self.part, self.bytes, self.shard = slot, parts, part, bytes_, shard

    def key(self) -> tuple[int, int]:
        return self.slot, self.part


def even_shard(slot: int, slots: int, shards: int) -> int:
    """The first map: runs of slots, as even as they can be."""
    return slot * shards // slots


def rebalanced(units: list[Unit], shards: int) -> list[Unit]:
    """Edit the shards of `units` until all hold about the same bytes, moving little.

    Shards above the mean give up their largest units that fit into the excess. These go, the largest first, to the
    emptiest shard. What gap is left between the fullest and the emptiest shard is closed by moves and swaps between them.
    """
    mean = sum(u.bytes for u in units) / shards
    held: list[list[Unit]] = [[] for _ in range(shards)]
    for u in units:
        held[u.shard].append(u)
    loads = [sum(u.bytes for u in own) for own in held]
    loose: list[Unit] = []
    for shard, own in enumerate(held):
        for u in sorted(own, key=lambda u: (-u.bytes, u.key())):
            if 0 < u.bytes <= loads[shard] - mean:
                own.remove(u)
                loads[shard] -= u.bytes
                loose.append(u)
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    for u in sorted(loose, key=lambda u: (-u.bytes, u.key())):
        load, shard = heapq.heappop(heap)
        u.shard = shard
        held[shard].append(u)
        loads[shard] = load + u.bytes
        heapq.heappush(heap, (loads[shard], shard))
    for _ in range(EXCHANGES):
        full, empty = max(range(shards), key=lambda s: (loads[s], s)), min(range(shards), key=lambda s: (loads[s], s))
        if not _exchange(held, loads, full, empty):
            break
    return units


def _exchange(held: list[list[Unit]], loads: list[int], full: int, empty: int) -> bool:
    """Hand over the unit, or swap the two units, whose difference is nearest to half the gap. False if that gains nothing."""
    gap = loads[full] - loads[empty]
    ups = sorted((u for u in held[full] if u.bytes), key=lambda u: (u.bytes, u.key()))
    downs: list[Unit | None] = [None, *sorted((u for u in held[empty] if u.bytes), key=lambda u: (u.bytes, u.key()))]
    best, at = gap, None
    j = 0
    for up in ups:
        # As `up` grows, so does the unit whose exchange comes nearest to half the gap.
        off = lambda n: abs(gap - 2 * (up.bytes - (downs[n].bytes if downs[n] else 0)))  # noqa: B023, E731
        while j + 1 < len(downs) and off(j + 1) <= off(j):
            j += 1
        if off(j) < best:
            best, at = off(j), (up, downs[j])
    if at is None:
        return False
    up, down = at
    held[full].remove(up)
    held[empty].append(up)
    up.shard = empty
    if down is not None:
        held[empty].remove(down)
        held[full].append(down)
        down.shard = full
    moved = up.bytes - (down.bytes if down is not None else 0)
    loads[full] -= moved
    loads[empty] += moved
    return True


def grown(units: list[Unit], shards: int) -> list[Unit]:
    """Give a new shard, number `shards`, its share. Every other shard only gives units up, the fullest first."""
    share = sum(u.bytes for u in units) / (shards + 1)
    held: list[list[Unit]] = [[] for _ in range(shards)]
    for u in sorted(units, key=lambda u: (-u.bytes, u.key())):
        held[u.shard].append(u)
    loads = [sum(u.bytes for u in own) for own in held]
    taken = 0
    for shard in sorted(range(shards), key=lambda s: (-loads[s], s)):
        for u in held[shard]:
            if u.bytes and loads[shard] - u.bytes >= share * 0.999 and taken + u.bytes <= share:
                u.shard = shards
                loads[shard] -= u.bytes
                taken += u.bytes
    return units


class SlotMap:
    """The map under `path`, a folder with one version after the other. `slots` is fixed when it is made.

    Two editors at once are kept apart only as far as the file system refuses to make one folder twice.
    """

    def __init__(self, spark: SparkSession, path: str, slots: int = SLOTS):
        self.spark, self.path, self.slots = spark, path.rstrip("/"), slots

    def versions(self) -> list[int]:
        rows = self.spark.read.schema(f"{MAP}, version int").parquet(self.path).select("version").distinct().collect()
        return sorted(r.version for r in rows)

    def read(self, version: int | None = None) -> DataFrame:
        """slot, parts, part, shard, bytes, shards: of one version, by default the last."""
        version = self.versions()[-1] if version is None else version
        return self.spark.read.schema(MAP).parquet(f"{self.path}/version={version}")

    def _units(self, version: int | None = None) -> tuple[list[Unit], int]:
        rows = self.read(version).collect()
        return [Unit(r.slot, r.parts, r.part, r.bytes, r.shard) for r in rows], rows[0].shards

    def _store(self, units: list[Unit], shards: int, version: int) -> int:
        rows = [(u.slot, u.parts, u.part, u.shard, u.bytes, shards) for u in sorted(units, key=Unit.key)]
        self.spark.createDataFrame(rows, MAP).coalesce(1).write.parquet(f"{self.path}/version={version}")
        return version

    def create(self, shards: int) -> int:
        """Version 0: the slots in even runs, nothing known about bytes."""
        return self._store([Unit(s, 1, 0, 0, even_shard(s, self.slots, shards)) for s in range(self.slots)], shards, 0)

    def rebalance(self, facts: DataFrame) -> int:
        """A new version for the records in `facts` (slot, row, size), edited from the last one."""
        last = self.versions()[-1]
        old, shards = self._units(last)
        by_slot = {r.slot: r.bytes for r in facts.groupBy("slot").agg(F.sum("size").alias("bytes")).collect()}
        most = max(1, sum(by_slot.values()) // shards // PART_SHARE)
        parts = {s: min(-(-b // most), PART_SHARE * shards) for s, b in by_slot.items() if b > most}
        of_part: dict[tuple[int, int], int] = {}
        if parts:
            heavy = self.spark.createDataFrame([(s, int(n)) for s, n in parts.items()], "slot int, parts int")
            dealt = facts.join(F.broadcast(heavy), "slot").groupBy("slot", part_of("row", "parts").alias("part"))
            of_part = {(r.slot, r.part): r.bytes for r in dealt.agg(F.sum("size").alias("bytes")).collect()}
        shard_of, first = {u.key(): u.shard for u in old}, {u.slot: u.shard for u in old if u.part == 0}
        units = []
        for slot in range(self.slots):
            n = int(parts.get(slot, 1))
            for part in range(n):
                size = of_part.get((slot, part), 0) if n > 1 else by_slot.get(slot, 0)
                units.append(Unit(slot, n, part, size, shard_of.get((slot, part), first[slot])))
        return self._store(rebalanced(units, shards), shards, last + 1)

    def grow(self) -> int:
        """A new version with one more shard, which takes slots from the others; no other slot moves."""
        last = self.versions()[-1]
        units, shards = self._units(last)
        return self._store(grown(units, shards), shards + 1, last + 1)

    def place(self, facts: DataFrame, version: int | None = None) -> DataFrame:
        """Add `shard` and `place`, the record's number in its shard, to `facts` (slot, row, ... as `slot_facts` makes them).

        Records of a shard are numbered by slot, part, reading task and row: the starts of slots come from their counts,
        those of tasks from a sum within each slot, and only the records of one task and slot are put in order together.
        """
        entries = F.broadcast(self.read(version).select("slot", "parts", "part", "shard"))
        width = F.broadcast(self.read(version).select("slot", "parts").distinct())
        keyed = facts.join(width, "slot").withColumn("part", part_of("row", "parts")).withColumn("task", F.shiftright("row", 33))
        counts = settle(keyed.groupBy("slot", "part", "task").agg(F.count(F.lit(1)).alias("n")), "slot-counts")
        whole = counts.groupBy("slot", "part").agg(F.sum("n").alias("n")).join(entries, ["slot", "part"]).collect()
        starts, used = [], {}
        for r in sorted(whole, key=lambda r: (r.slot, r.part)):
            starts.append((r.slot, r.part, r.shard, used.get(r.shard, 0)))
            used[r.shard] = used.get(r.shard, 0) + r.n
        first = F.broadcast(self.spark.createDataFrame(starts, "slot int, part int, shard int, first long"))
        before = "coalesce(sum(n) OVER (PARTITION BY slot, part ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        tasks = counts.select("slot", "part", "task", F.expr(before).alias("before")).join(first, ["slot", "part"])
        tasks = settle(tasks.select("slot", "part", "task", "shard", (F.col("first") + F.col("before")).alias("first")), "slot-starts")
        own = F.expr("row_number() OVER (PARTITION BY slot, part, task ORDER BY row) - 1")
        placed = keyed.withColumn("own", own).join(tasks.hint("merge"), ["slot", "part", "task"])
        return placed.withColumn("place", F.col("first") + F.col("own")).drop("parts", "part", "task", "own", "first")


def part_of(row: str, parts: str):
    """The part of a slot that a row goes to."""
    return F.when(F.col(parts) == 1, 0).otherwise(F.pmod(F.xxhash64(row), F.col(parts))).cast("int")


def slot_facts(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, slot and row (a number of its own) of each document, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + RECORD_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    return settle(facts.withColumn("slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")), "slot-facts")


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """All of `docs` (doc_id, text) in shards of about equal bytes: doc_id, size, text_crc32, law, shard, slot (the
    record's place in its shard), grown_shard (null under this law), virtual_slot.

    The map goes to `path`, by default a new folder of the shared one: an even version, then a balanced one.
    """
    spark = docs.sparkSession
    facts = slot_facts(docs, slots)
    slot_map = SlotMap(spark, path or new_path(spark, "slot-map"), slots)
    slot_map.create(shards)
    version = slot_map.rebalance(facts)
    return slot_map.place(facts, version).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("slot").alias("virtual_slot"),
    )

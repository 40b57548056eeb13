"""The prefix trie of conversations by truncation peeling.

A conversation becomes the digests of its prefixes, one for each depth. Peeling goes from the greatest depth to the root: at each
depth the conversations that end there are merged with the nodes left from below, which have just lost their last turn and are
regrouped by what remains of them. So a node's members, children, leaves and savings are added up while it is found, and each
node is met once.

Equal conversations count as one from the start. Most of the trie is narrow: below a certain depth, a node has few rows, or
one conversation with its copies. All nodes below such a cut are peeled in one task, all its subtrees at once over flat arrays. Above
the cuts lie the nodes with more than CUT_ROWS rows of different conversations below them, the trunk. What comes up to it is added up
for each node by one grouping, folded before the shuffle, so a first turn that a third of all conversations share is
no burden. Then the trunk is peeled in bands of depths with at most BATCH_ROWS nodes in all, the deepest first, each in one task; a depth that
has more by itself is a band of its own, whose nodes are dealt to tasks. So the steps grow with the nodes of the trunk, not with its depth.

Turns are ordered by turn (null first), then by digest. A null role or text is empty. Rows without a conv_id belong to no
conversation and are left out; repeated rows are turns of their own. A conversation's digests pass through one
task as a stream, of which only one hash state is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderlens.functions.skew import attach_by_key
from larderlens.llm.common import settle

# A conversation takes its beginning from the first of the GROUP ids it lies among: fewer than MOST_HEADS turns.
GROUP = 5
MOST_HEADS = 9
CUT_ROWS = 20_000
# Ids of a group of copies are put in order in spans of this many.
ID_SPAN = 4096
# Rows of subtrees that a task peels at once; a subtree is never divided.
BATCH_ROWS = 100_000

ROOT = b""
MOST_ID = (1 << 63) - 1
NO_ENDS = hashlib.sha256(b"").hexdigest()

PREFIXES = "conv_id long, depth long, digest binary, parent binary, bytes long, last boolean"
NODES = "digest binary, parent binary, cut boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, n (place in the conversation, from 0), turn_digest, bytes; dealt by groups of ids."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps apart pairs that read the same in a row.
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))))
    conv = F.col("conv_id").cast("long")
    rows = conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % GROUP).alias("base"), F.col("turn").alias("turn"), digest.alias("turn_digest"), F.octet_length(text).cast("long").alias("bytes")
    )
    order = Window.partitionBy("base", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_digest")
    return rows.repartition("base").withColumn("n", F.row_number().over(order) - 1).drop("turn")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1; 0 for the root row that each conversation has), turn_digest, bytes.

    A conversation begins with the first h turns of the one whose id is the next lower multiple of GROUP, and goes
    on with its own turns after its first h; h is the CRC-32 of its id modulo MOST_HEADS.
    """
    heads = turns.where((F.col("conv_id") == F.col("base")) & (F.col("n") < MOST_HEADS - 1))
    heads = heads.groupBy("base").agg(F.sort_array(F.collect_list(F.struct("n", "turn_digest", "bytes"))).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEADS
    convs = turns.groupBy("base", "conv_id").agg(F.count(F.lit(1)).alias("length"))
    headed = convs.join(heads, "base", "left").select("conv_id", "base", F.slice(F.coalesce("head", F.array().cast("array<struct<n:int,turn_digest:binary,bytes:bigint>>")), F.lit(1), h.cast("int")).alias("head"))
    empty = F.array(F.struct(F.lit(-1).alias("n"), F.lit(b"").alias("turn_digest"), F.lit(0).cast("long").alias("bytes")))
    first = headed.select("conv_id", "base", F.explode(F.concat(empty, "head")).alias("t"))
    first = first.select("conv_id", "base", (F.col("t.n") + 1).alias("place"), "t.turn_digest", "t.bytes")
    own = turns.where(F.col("n") >= h).join(headed.select("base", "conv_id", F.size("head").alias("taken")), ["base", "conv_id"])
    own = own.select("conv_id", "base", (F.col("taken") + F.col("n") - h + 1).alias("place"), "turn_digest", "bytes")
    return first.unionByName(own)


def prefix_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix rows of conversations whose rows come one after the other, in order of place from 0."""
    held: tuple | None = None  # the row before, not yet known to be the last of its conversation
    state = hashlib.blake2b(digest_size=16)
    for batch in batches:
        out: list[tuple] = []
        for conv, place, turn, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "turn_digest", "bytes")), strict=True):
            if held is not None:
                out.append((*held, place == 0))
            if place == 0:
                state = hashlib.blake2b(digest_size=16)
                held = (conv, 0, ROOT, None, 0)
            else:
                state.update(turn)
                held = (conv, place, state.digest(), held[2], size)
        yield _prefix_batch(out)
    if held is not None:
        yield _prefix_batch([(*held, True)])


def _prefix_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "depth", "digest", "parent", "bytes", "last"]
    )


def end_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each digest from its spans of ids, which come one after the other in order."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ["digest", "depth", "conv_id", "n", "ends_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    held, state = None, hashlib.sha256()
    for batch in batches:
        out: list[tuple] = []
        for digest, depth, low, n, ids in zip(*(batch.column(c).to_pylist() for c in ("digest", "depth", "low", "n", "ids")), strict=True):
            if held is not None and held[0] == digest:
                held[3] += n
                state.update(b",")
            else:
                if held is not None:
                    out.append((*held, state.hexdigest()))
                held, state = [digest, depth, low, n], hashlib.sha256()
            state.update(ids.encode())
        yield made(out)
    if held is not None:
        yield made([(*held, state.hexdigest())])


def endings(prefixes: DataFrame) -> DataFrame:
    """The different conversations: digest, depth, conv_id (smallest), n, ends_sha256."""
    last = prefixes.where("last").select("digest", "depth", "conv_id", F.floor(F.col("conv_id") / ID_SPAN).alias("span"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    spans = last.groupBy("digest", "span").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n"), ids.alias("ids")
    )
    streamed = spans.repartition("digest").sortWithinPartitions("digest", "span").select("digest", "depth", "low", "n", "ids")
    return streamed.mapInArrow(end_stream, "digest binary, depth long, conv_id long, n long, ends_sha256 string")


def peel(table: pa.Table) -> pa.RecordBatch:
    """All nodes of the subtrees in `table` (prefix rows of different conversations from their cut down, those that end
    with n and ends_sha256; or rows of nodes from their cut down, with n and what has come up to them from below).

    From the greatest depth to the least: conversations that end at a depth and nodes that came up to it are one by their
    digest; each adds what it holds to the node that is left when its last turn is gone.
    """
    both = pa.concat_arrays([table["digest"].combine_chunks(), table["parent"].combine_chunks()]).dictionary_encode()
    codes = both.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    rows, ups, size = codes[: len(table)], codes[len(table) :], len(both.dictionary)
    column = lambda name: table[name].to_numpy()
    parent, depth, bytes_ = np.full(size, -1), np.full(size, -1), np.zeros(size, dtype=np.int64)
    parent[rows], depth[rows], bytes_[rows] = ups, column("depth"), column("bytes")
    top = np.zeros(size, dtype=bool)
    top[rows[column("depth") == column("cut_depth")]] = True
    convs, members, children, leaves, saved = np.full(size, MOST_ID), *(np.zeros(size, dtype=np.int64) for _ in range(4))
    held = np.flatnonzero(table["n"].is_valid().to_numpy())
    members[rows[held]] = table["n"].take(pa.array(held)).to_numpy()
    convs[rows[held]] = column("conv_id")[held]
    if "n_children" in table.column_names:
        for into, name in ((children, "n_children"), (leaves, "n_leaves"), (saved, "saved_tokens")):
            into[rows] = column(name)
    ended = np.flatnonzero(table["ends_sha256"].is_valid().to_numpy())
    nodes = np.flatnonzero(depth >= 0)
    nodes = nodes[np.argsort(-depth[nodes], kind="stable")]
    edges = np.flatnonzero(np.diff(depth[nodes], prepend=-2, append=-2))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        at = nodes[lo:hi]
        leaves[at] += children[at] == 0
        saved[at] += (members[at] - 1) * bytes_[at]
        on = at[~top[at]]
        up = parent[on]
        np.minimum.at(convs, up, convs[on])
        for into, what in ((members, members[on]), (children, 1), (leaves, leaves[on]), (saved, saved[on])):
            np.add.at(into, up, what)
    ends = np.full(size, NO_ENDS, dtype=object)
    ends[rows[ended]] = table["ends_sha256"].take(pa.array(ended)).to_pylist()
    above = top[nodes]
    known = both.dictionary.take(pa.array(np.where(parent[nodes] >= 0, parent[nodes], 0)))
    return pa.RecordBatch.from_arrays(
        [
            both.dictionary.take(pa.array(nodes)), pa.array(known.to_pylist(), pa.binary(), mask=parent[nodes] < 0), pa.array(above),
            pa.array(convs[nodes]), pa.array(depth[nodes]), pa.array(convs[np.where(above, 0, parent[nodes])], mask=above), pa.array(members[nodes]),
            pa.array(children[nodes]), pa.array(leaves[nodes]), pa.array(saved[nodes]), pa.array(ends[nodes].tolist(), pa.string()),
        ],
        names=[part.strip().split()[0] for part in NODES.split(",")],
    )


def peel_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`peel` over all rows of a task."""
    if held := [batch for batch in batches if len(batch)]:
        yield peel(pa.Table.from_batches(held).combine_chunks())


def bands(counts: list[tuple[int, int]], most: int) -> Iterator[tuple[int, int, int]]:
    """Runs of depths, the deepest first: least and greatest depth, nodes. `counts` are depths, from the greatest down to 0, and nodes of each; a run
    has at most `most` nodes, or one depth."""
    high, held = None, 0
    for depth, n in counts:
        if high is not None and held + n > most:
            yield depth + 1, high, held
            high, held = None, 0
        high, held = depth if high is None else high, held + n
    if high is not None:
        yield 0, high, held


def peel_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`peel` over whole subtrees, whose rows come one after the other, many subtrees at once."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < BATCH_ROWS:
            continue
        table = pa.Table.from_batches(held)
        cuts = table["cut_digest"]
        last = cuts[n - 1].as_py()
        lo, hi = 0, n - 1  # the first row of the subtree that may go on
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if cuts[mid].as_py() == last else (mid + 1, hi)
        if lo:
            yield peel(table.slice(0, lo).combine_chunks())
            held, n = table.slice(lo).to_batches(), n - lo
    if n:
        yield peel(pa.Table.from_batches(held).combine_chunks())


def trie(conversations: DataFrame, cut_rows: int = CUT_ROWS, band_rows: int = BATCH_ROWS) -> DataFrame:
    """All nodes of the rebuilt conversations (conv_id, turn, role, text): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No conversations, no nodes."""
    placed = rebuilt(settle(turn_rows(conversations), "turns")).repartition("base").sortWithinPartitions("conv_id", "place")
    prefixes = settle(placed.select("conv_id", "place", "turn_digest", "bytes").mapInArrow(prefix_stream, PREFIXES), "prefixes")
    return peeled(prefixes, settle(endings(prefixes), "endings"), cut_rows, band_rows)


def peeled(prefixes: DataFrame, ends: DataFrame, cut_rows: int, band_rows: int) -> DataFrame:
    """The nodes, from prefix rows and the different conversations among them."""
    told = ends.select("conv_id", F.col("depth").alias("length"), "n", "ends_sha256")
    own = settle(prefixes.drop("last").join(told, "conv_id"), "different-conversations")

    # Nodes that are too large to be peeled with all below them. Whatever lies above one of them is one as well.
    sizes = own.groupBy("digest").agg(F.count(F.lit(1)).alias("convs"), F.sum(F.col("length") - F.col("depth") + 1).alias("rows"))
    heavy = sizes.where(F.col("rows") > cut_rows).where("convs > 1").select("digest", F.col("convs").alias("weight"))
    heavy = settle(heavy, "heavy")
    upper = attach_by_key(own.select("digest", "parent", "depth", "bytes", "conv_id"), heavy, "digest", "weight")
    upper = settle(upper, "heavy-rows")
    cut_depth = upper.groupBy("conv_id").agg((F.max("depth") + 1).alias("cut_depth"))
    low = own.join(cut_depth, "conv_id", "left").withColumn("cut_depth", F.coalesce("cut_depth", F.lit(0).cast("long")))
    low = low.where(F.col("depth") >= F.col("cut_depth"))
    tops = low.where(F.col("depth") == F.col("cut_depth")).select("conv_id", F.col("digest").alias("cut_digest"))
    ended = F.col("depth") == F.col("length")
    rows = low.join(tops, "conv_id").select(
        "cut_digest", "cut_depth", "conv_id", "depth", "digest", "parent", "bytes",
        F.when(ended, F.col("n")).alias("n"), F.when(ended, F.col("ends_sha256")).alias("ends_sha256"),
    )
    found = settle(rows.repartition("cut_digest").sortWithinPartitions("cut_digest").mapInArrow(peel_stream, NODES), "nodes")

    # Above the cuts: what comes up from below, and from each band to the next, is added up for each node.
    def come_up(nodes: DataFrame) -> DataFrame:
        return nodes.where("cut AND parent IS NOT NULL").select(
            F.col("parent").alias("digest"), "conv_id", F.col("n_convs").alias("n"), F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens"
        )

    def added(parts: DataFrame) -> DataFrame:
        sums = [F.sum(c).cast("long").alias(c) for c in ("n", "n_children", "n_leaves", "saved_tokens")]
        once = [F.max(c).alias(c) for c in ("ends_sha256", "parent", "depth", "bytes") if c in parts.columns]
        return parts.groupBy("digest").agg(F.min("conv_id").alias("conv_id"), *sums, *once)

    trunk = upper.groupBy("digest", "depth").agg(F.any_value("parent").alias("parent"), F.any_value("bytes").alias("bytes"))
    none = [F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    ending = ends.join(heavy.select("digest"), "digest", "left_semi").select("digest", "conv_id", "n", *none, "ends_sha256")
    trunk = settle(trunk.join(added(come_up(found).unionByName(ending, allowMissingColumns=True)), "digest", "left"), "trunk")
    counts = trunk.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("depth").desc()).collect()
    last = found.limit(0)
    for low_depth, high_depth, n in bands([tuple(row) for row in counts], band_rows):
        facts = trunk.where(F.col("depth").between(low_depth, high_depth)).fillna(0, ["n", "n_children", "n_leaves", "saved_tokens"])
        band = added(facts.unionByName(come_up(last), allowMissingColumns=True)).withColumn("cut_depth", F.lit(low_depth).cast("long"))
        # At least one row comes up to each node, so that its smallest conversation is known when it is met.
        band = band.withColumn("conv_id", F.coalesce("conv_id", F.lit(MOST_ID).cast("long")))
        tasks = -(-n // band_rows)
        last = settle((band.repartition(tasks, "digest") if tasks > 1 else band.coalesce(1)).mapInArrow(peel_whole, NODES), "trunk-nodes")
        found = found.unionByName(last)
    trunk = trunk.select("digest")

    inner = found.where(~F.col("cut") | F.col("parent").isNull())
    outer = found.where(F.col("cut") & F.col("parent").isNotNull()).drop("parent_conv_id")
    parents = found.join(trunk, "digest", "left_semi").select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight"))
    under = attach_by_key(outer, settle(parents, "trunk-parents"), "parent", "weight")
    names: list[str | Column] = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(*names).unionByName(under.select(*names))

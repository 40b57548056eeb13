"""Connected groups of near things, found through shared buckets without comparing all pairs of a bucket.

Two things are compared only if they share a bucket. A bucket is worked through in rounds: some of its members become
pivots, each is compared with all members that are not yet known to be in its group, and is done with afterwards. A
bucket ends when all its members are in one group. So every two members of a bucket are either compared or connected by
links that were found, and a bucket of n copies of one thing takes one round of n comparisons, not n * n.

What PIVOT_ROUNDS rounds leave open are large buckets of things that are alike but not near. Their members are dealt to
blocks of bounded size, and each two blocks of a bucket are compared in one task, which returns only the links that connect
groups. No pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlens.functions.skew import attach_by_key
from larderlens.llm.common import settle


PIVOT_ROUNDS = 2
# Members of a block, and what their contents may weigh in all.
BLOCK_MEMBERS = 512
BLOCK_WEIGHT = 4 << 20
# Members of blocks that a task takes in all.
TASK_MEMBERS = 4096
# Edges of which one task finds the components: some 100 MB of arrays.
FEW_EDGES = 1_000_000

# Gets nodes, the groups they are in so far, and their contents; returns links between nodes of different groups.
Compare = Callable[[list[int], list[int], list], list[tuple[int, int]]]


class Joined:
    """Groups while a task joins them."""

    def __init__(self, groups: list[int]):
        self.up = {g: g for g in groups}

    def find(self, group: int) -> int:
        while self.up[group] != group:
            self.up[group] = group = self.up[self.up[group]]
        return group

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and group of all edges (u, v) of a task: a group's top is handed on to the smallest one it has an edge to, until all edges are within groups."""
    held = [np.stack([column.to_numpy() for column in batch.columns]) for batch in batches]
    if not held:
        return
    ends = np.concatenate(held, axis=1)
    nodes, code = np.unique(ends, return_inverse=True)
    u, v = code.reshape(ends.shape)
    top = np.arange(len(nodes))
    while (open_ := top[u] != top[v]).any():
        u, v = u[open_], v[open_]
        low, high = np.minimum(top[u], top[v]), np.maximum(top[u], top[v])
        np.minimum.at(top, high, low)
        while not np.array_equal(top, up := top[top]):
            top = up
    for lo in range(0, len(nodes), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[top[part]])], names=["node", "group"])


def components(edges: DataFrame) -> DataFrame:
    """The connected components of `edges` (a, b: long): node, group = smallest node. Nodes without an edge are left out.

    At most FEW_EDGES are worked through by one task. Of more, alternates large stars and small stars (every node hands its neighbours on to the
    smallest of them) until only stars are left. Hubs meet their one row through `attach_by_key`, so no task holds a hub's edges.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = settle(edges.distinct(), "edges")
    if edges.count() <= FEW_EDGES:
        return settle(edges.coalesce(1).mapInArrow(_components, "node long, group long"), "components")

    def least_of(rows: DataFrame) -> DataFrame:
        least = settle(rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("weight")), "least")
        return attach_by_key(rows, least, "u", "weight").withColumn("m", F.least("u", "m"))

    def are_stars(rows: DataFrame) -> bool:
        """Whether every node has one edge down, or edges from above only: then the lower ends are the groups."""
        ends = rows.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(
            rows.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("low"))
        )
        told = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
        return told.where("up > 1 OR up + low > 1").isEmpty()

    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = least_of(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        found = least_of(settle(large, "large-star"))
        small = found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(found.select("u", F.col("m").alias("v"))).where("u <> v")
        edges = settle(small.distinct(), "small-star")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("group")).distinct()
    return settle(edges.select(F.col("u").alias("node"), F.col("v").alias("group")).unionByName(tops), "components")


def linked_groups(
    members: DataFrame, near: Callable[[DataFrame], DataFrame], contents: DataFrame, compare: Compare, groups: DataFrame | None = None
) -> DataFrame:
    """Groups of the nodes in `members` (bucket, node: long): node, group, for nodes with a link.

    `near` gets distinct pairs (a, b: long) and returns those that are near. `contents` has node, content and weight;
    `compare` finds the links among some of them. `groups` are those known before, also of other nodes.
    """
    spark = members.sparkSession
    members = settle(members.distinct(), "members")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumn("weight", F.col("size"))
    shared = settle(attach_by_key(members, settle(sizes, "bucket-sizes"), "bucket", "weight"), "shared")
    # A thing that others were derived from meets most of them again and again, and is the better pivot.
    scores = shared.groupBy("node").agg(F.sum("size").alias("score"))
    open_ = settle(shared.drop("size").join(scores, "node"), "open")
    groups = _no_groups(spark) if groups is None else groups
    for turn in range(PIVOT_ROUNDS + 1):
        sized = groups.join(groups.groupBy("group").agg(F.count(F.lit(1)).alias("of")), "group")
        state = open_.join(sized, "node", "left").withColumn("group", F.coalesce("group", "node"))
        state = settle(state.withColumn("of", F.coalesce("of", F.lit(1))), "state")
        unlike = state.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("weight"))
        unlike = settle(unlike.where("low <> high").select("bucket", "weight"), "unlike")
        if unlike.isEmpty():
            return groups
        state = settle(attach_by_key(state, unlike, "bucket", "weight"), "unlike-members")
        if turn == PIVOT_ROUNDS:
            links = settle(block_links(state, contents, compare), "block-links")
            return groups if links.isEmpty() else _joined(groups, links)
        part = F.pmod(F.xxhash64("node"), F.lit(1 << min(turn, 20)))
        best = F.struct((-F.col("of")).alias("few"), "score", (-F.col("node")).alias("low"), "node", "group")
        pivots = state.groupBy("bucket", part.alias("part")).agg(F.max(best).alias("p"), F.count(F.lit(1)).alias("weight"))
        pivots = settle(pivots.select("bucket", "weight", F.col("p.node").alias("pivot"), F.col("p.group").alias("of_pivot")), "pivots")
        # One row a bucket, whose weight is that of all its parts: a bucket is joined in one way, and meets all its pivots.
        held = pivots.groupBy("bucket").agg(F.sum("weight").alias("weight"), F.collect_list(F.struct("pivot", "of_pivot")).alias("pivots"))
        met = attach_by_key(state, settle(held, "bucket-pivots"), "bucket", "weight")
        others = F.filter("pivots", lambda p: p["of_pivot"] != F.col("group"))
        met = met.select("node", F.explode(others).alias("p")).select("node", "p.pivot")
        pairs = met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        links = settle(near(settle(pairs, "pairs")).select("a", "b"), "links")
        left = pivots.select("bucket", F.col("pivot").alias("node"))
        open_ = settle(state.select("bucket", "node", "score").join(left, ["bucket", "node"], "left_anti"), "open")
        if not links.isEmpty():
            groups = _joined(groups, links)


def _no_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "node long, group long")


def with_links(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """Groups (none: each node by itself) after adding links (a, b) between their nodes."""
    groups = _no_groups(links.sparkSession) if groups is None else groups
    return groups if links.isEmpty() else _joined(groups, links)


def block_links(state: DataFrame, contents: DataFrame, compare: Compare) -> DataFrame:
    """Links (a, b) among the members of each bucket in `state` (bucket, node, group). If it has a `mark`, that and a space go
    before the content."""
    marked = "mark" in state.columns
    held = state.select("bucket", "node", "group", *(["mark"] if marked else [])).join(contents.hint("merge"), "node")
    if marked:
        held = held.withColumn("content", F.concat_ws(" ", "mark", "content")).drop("mark")
    held = settle(held, "block-contents")
    sizes = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("sum"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("sum") / BLOCK_WEIGHT)).cast("int")
    sizes = settle(sizes.select("bucket", blocks.alias("blocks"), F.col("n").alias("size")), "block-sizes")
    dealt = attach_by_key(held.drop("weight"), sizes, "bucket", "size")
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def linked(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        found = compare(group["node"].tolist(), group["group"].tolist(), group["content"].tolist())
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    # Their tasks are many by work, not by bytes: Spark would put these short rows together into a task or two.
    rows = sizes.agg(F.sum(F.col("size") * F.col("blocks"))).first()[0] or 0
    tasks = max(state.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_MEMBERS))
    found = dealt.select("bucket", "low", "high", "node", "group", "content").repartition(tasks, "bucket", "low", "high")
    return found.groupBy("bucket", "low", "high").applyInPandas(linked, "a long, b long").distinct()


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups after adding links between their nodes."""

    def of(end: str) -> DataFrame:
        return groups.select(F.col("node").alias(end), F.col("group").alias(f"group_{end}"))

    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    found = components(ends.select(F.coalesce("group_a", "a").alias("a"), F.coalesce("group_b", "b").alias("b")))
    moved = found.select(F.col("node").alias("group"), F.col("group").alias("new"))
    old = groups.join(moved, "group", "left").select("node", F.coalesce("new", "group").alias("group"))
    known = groups.select("node")
    return settle(old.unionByName(found.join(known, "node", "left_anti").select("node", "group")), "groups")

"""Exact dedup against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by digest. A batch of new documents is
folded to one row per digest, anti-joined with the index by sort-merge on the buckets, and what is new is appended.
Only digests are shuffled, never texts.

Texts are equal when they are identical after white space is deleted; null counts as the empty text. Of the equal
texts of one batch the one with the most code points stays, then the smallest doc_id (null last), then the first
row. A text that an earlier batch has brought is dropped whatever its length. Adding a batch again changes nothing
and gives the same answer. An index takes one writer at a time; two that add at once may both keep a text.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlens.functions.skew import attach_by_key
from larderlens.llm.common import WHITE_SPACE, free_name, new_path, settle

BUCKETS = 64


def digest(text: str):
    """SHA-256 of the text without white space."""
    return F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, ""), 256)


class DigestIndex:
    """The digest table under `path`, known to the session's catalog by a hash of the whole path.

    The bucket count is fixed when it is made; choose it for the final size. Opening it with another one is an error.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.buckets = buckets
        self.path = path.rstrip("/")
        self.table = f"digests_{hashlib.sha256(self.path.encode()).hexdigest()[:32]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (text_sha256 STRING, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )
        told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").collect()}
        if told["Num Buckets"] != str(buckets):
            raise ValueError(f"the index at {self.path} has {told['Num Buckets']} buckets")
        if not told["Location"].rstrip("/").endswith(re.sub(r"^[a-z0-9+.-]+:/*", "", self.path)):
            raise ValueError(f"{self.table} is the index at {told['Location']}")

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: str) -> DataFrame:
        """Deduplicate `docs` (doc_id, text), append what is new, and return one row per input row:
        doc_id, keep_id, group_size (equal rows in this batch), kept, text_sha256."""
        facts = settle(
            docs.select(
                F.col("doc_id").cast("long").alias("doc_id"),
                digest("text").alias("text_sha256"),
                F.length(F.coalesce("text", F.lit(""))).alias("n"),
                F.monotonically_increasing_id().alias("row"),
            ),
            "digest-facts",
        )
        best = F.struct("n", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("low"), F.bitwise_not("row").alias("first"))
        groups = settle(
            facts.groupBy("text_sha256").agg(
                F.max(F.struct(best.alias("by"), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
            ).select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")),
            "digest-groups",
        )
        fresh = groups.join(self.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
        (
            fresh.select("text_sha256", "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "text_sha256")
            .write.insertInto(self.table)
        )
        held = self.read().select("text_sha256", F.col("keep_id").alias("stored_id"), (F.col("batch") == batch).alias("own"))
        decided = groups.join(held.hint("merge"), "text_sha256").select(
            "text_sha256", "group_size", F.col("stored_id").alias("keep_id"), F.when(F.col("own"), F.col("keep_row")).alias("keep_row"),
            F.col("group_size").alias("weight"),
        )
        return attach_by_key(facts, settle(decided, "digest-decided"), "text_sha256", "weight").select(
            "doc_id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "text_sha256"
        )


def decide(docs: DataFrame) -> DataFrame:
    """All of `docs` as the first batch of a new index."""
    spark = docs.sparkSession
    return DigestIndex(spark, new_path(spark, "digest_index")).add(docs, "0")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Of rows that repeat a doc_id with the same text, one stays."""
    kept = decide(docs).where("kept").select("doc_id", "text_sha256")
    name = free_name(docs, "text_sha256")
    keyed = docs.withColumn(name, digest("text"))
    same = keyed["doc_id"].cast("long").eqNullSafe(kept["doc_id"]) & (keyed[name] == kept["text_sha256"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)

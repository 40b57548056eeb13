"""Repeated incremental runs as a stream over new page files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from threading import Event

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from larderlens import schemas, session
from larderlens.operators import extract
from larderlens.plans.catalogue import SOURCES, Source, enabled, log_url, register_sources, write_batch
from larderlens.sources.folders import exists
from larderlens.sources.pages import stream_pages
from larderlens.sources.tables import Catalogue

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# One row for each arrival, and for each time that a URL becomes known or is forgotten.
_ARRIVALS = "url string, told_at timestamp, loaded boolean, arrival long, outcome string, page string"
_STATUS = "url string, status string, page string"


def arrival_states(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The status of every arrival of one URL. The state is whether the URL is loaded.

    What the catalogue tells of the URL comes first, in the order it was told; then the arrivals by number. The first good
    one while the URL is not loaded is the success, and what comes after it is skipped.
    """
    rows = pd.concat(parts, ignore_index=True)
    loaded = state.get[0] if state.exists else False
    told = rows[rows["page"].isna()].sort_values("told_at")
    if len(told):
        loaded = bool(told["loaded"].iloc[-1])
    seen = rows[rows["page"].notna()].sort_values(["arrival", "page"], na_position="first")
    statuses = []
    for outcome in seen["outcome"]:
        if pd.isna(key[0]):
            statuses.append("failed")
        elif loaded:
            statuses.append("skipped")
        else:
            statuses.append(outcome)
            loaded = outcome == "success"
    state.update((loaded,))
    yield pd.DataFrame({"url": seen["url"], "status": statuses, "page": seen["page"]})


def start_loading(
    spark: SparkSession,
    pages_path: str,
    root: str,
    sources: tuple[Source, ...] = SOURCES,
    every: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Load page files that have not been loaded yet into the catalogue at `root`.

    With `every` (such as "24 hours") the query keeps running at that interval; without it, it takes what is
    there and ends. Progress is kept in the catalogue folder. The stream writes as a run of its own, named by the
    id that is kept with its progress, so a batch that is repeated after a failure rewrites its own folders and no others.

    Which URLs are loaded is the stream's keyed state. Each is read from the catalogue once, when the stream is new or when
    another writer has loaded or deleted it; a batch then meets only the state of its own URLs, however many recipes there are.
    If the progress folder is lost, the stream is a new run: it reads all page files again and finds their URLs known.
    """
    tables = Catalogue(session.configure(spark), root)
    active = enabled(sources)
    progress = f"{tables.root}/_progress"
    if not exists(spark, f"{progress}/offsets") or not exists(spark, tables.known_path):
        tables.tell_known(tables.read("recipes").select("url"), 0, f"seed-{uuid.uuid4().hex}")
    if spark.conf.get(_PROVIDER, "").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)  # state beyond the memory of the executors

    pages = stream_pages(spark, pages_path, files_per_batch=files_per_batch).where(F.col("source").isin([s.base_url for s in active]))
    parsed = extract.parse_pages(pages, [s.base_url for s in active if s.cuisine_in_category])
    page_schema = parsed.schema
    arrived = parsed.select("url", "arrival", "outcome", F.to_json(F.struct(*parsed.columns)).alias("page"))
    known = spark.readStream.schema("url string, loaded boolean, told_at timestamp").parquet(tables.known_path).select("url", "loaded", "told_at")
    both = arrived.unionByName(known, allowMissingColumns=True).select("url", "told_at", "loaded", "arrival", "outcome", "page")
    told = both.groupBy("url").applyInPandasWithState(arrival_states, _STATUS, "loaded boolean", "append", GroupStateTimeout.NoTimeout)
    named, run = Event(), []

    def load(rows: DataFrame, batch: int) -> None:
        named.wait()
        if not active or len(tables.folded(batch, run[0])) == len(schemas.TABLES):
            return
        staged = tables.stage("parsed", rows.select("status", F.from_json("page", page_schema).alias("p")).select("p.*", "status"), batch, run[0])
        if staged.isEmpty():
            return
        register_sources(tables, active, batch, run[0])
        missing = F.when(F.col("url").isNull(), "url missing").otherwise(F.col("error_message"))
        log = staged.select(
            log_url().alias("url"), "source", "status", F.when(F.col("status") == "failed", missing).alias("error_message")
        )
        write_batch(tables, staged.where(F.col("status") == "success"), log, batch, run[0])

    writer = told.writeStream.foreachBatch(load).option("checkpointLocation", progress)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    query = writer.trigger(**trigger).start()
    run.append(f"stream-{query.id}")
    named.set()
    return query

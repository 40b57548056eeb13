"""The catalogue as Parquet tables under one folder.

Each table is a folder of batches, `<table>/run=<run>/batch=<n>`. A run is one writer that numbers its batches: the
batch loads of a user, or one stream. A batch is written by overwriting its own folder, so a task, job or batch that is run
again after a failure replaces its rows and never adds them twice, and no writer touches another's rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from larderlens import schemas
from larderlens.functions.skew import deal, tasks_for
from larderlens.operators import quality
from larderlens.sources import seeds
from larderlens.sources.folders import below, exists, remove
from larderlens.sources.segments import Batch, Segment, Versions, batches_in, bins, outside, replaced, spans


#: The run of batch loads that name none.
DEFAULT_RUN = "loads"

#: Segments smaller than this are put together with their neighbours.
SEGMENT_BYTES = 1 << 30
#: About the size of a file of a compacted segment.
FILE_BYTES = 256 << 20
#: Rows of such a file at most, about; the task that writes it sorts them.
FILE_ROWS = 2_000_000


class Catalogue:
    """Reads and writes the tables of one catalogue folder."""

    def __init__(self, spark: SparkSession, root: str, staging: str | None = None):
        """Intermediate results go to `staging`: by default the shared folder named in `spark.checkpoint.dir`, or,
        where none is named, a folder of the catalogue."""
        self.spark = spark
        self.root = root.rstrip("/")
        shared = spark.conf.get("spark.checkpoint.dir", None)
        own = hashlib.sha256(self.root.encode()).hexdigest()[:24]
        self.versions = Versions(spark, self.root)
        self.staging = staging or (f"{shared.rstrip('/')}/larderlens/{own}" if shared else f"{self.root}/_staging")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, before_batch: int | None = None, run: str = DEFAULT_RUN) -> DataFrame:
        """A table without its folder columns. A table not written yet is empty.

        With `before_batch`, the rows that this batch of `run` builds on: all but those of the batch itself and of later
        ones of its run.
        """
        rows = self._rows(table)
        if before_batch is not None:
            rows = rows.where(~((F.col("run") == run) & (F.col("batch") >= before_batch)))
        return rows.drop("run", "batch")

    def read_batch(self, table: str, batch: int, run: str = DEFAULT_RUN) -> DataFrame:
        """The rows of one batch."""
        return self._rows(table).where((F.col("run") == run) & (F.col("batch") == batch)).drop("run", "batch")

    def _with_batch(self, table: str) -> StructType:
        return StructType([*schemas.TABLES[table].fields]).add("run", StringType()).add("batch", LongType())

    def _loaded(self, table: str) -> DataFrame:
        """All batches as they were loaded, also those that segments have taken the place of."""
        if not exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], self._with_batch(table))
        return self.spark.read.schema(self._with_batch(table)).parquet(self.path(table))

    def _rows(self, table: str, segments: list[Segment] | None = None) -> DataFrame:
        own = [s for s in (self.versions.current()[1] if segments is None else segments) if s.table == table]
        rows = self._loaded(table)
        if not own:
            return rows
        rows = rows.where(outside(spans(own)))
        folders = sorted(s.folder for s in own if s.folder)
        return rows.unionByName(self.spark.read.schema(self._with_batch(table)).parquet(*folders)) if folders else rows

    def folded(self, batch: int, run: str = DEFAULT_RUN) -> set[str]:
        """The tables in which a batch is part of a segment."""
        return {s.table for s in self.versions.current()[1] if s.covers(run, batch)}

    def write(self, table: str, rows: DataFrame, batch: int, run: str = DEFAULT_RUN) -> None:
        """Write one batch in schema order. A batch that is part of a segment stays as it is there."""
        if not re.fullmatch(r"[\w-]+", run):
            raise ValueError("a run is named by letters, digits, _ and -")
        if table in self.folded(batch, run):
            return
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[table].fields]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.path(table)}/run={run}/batch={batch}")

    def import_rows(self, table: str, rows: DataFrame) -> None:
        """Write rows that carry their `run` and `batch`, each batch as if it had been loaded by itself."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._with_batch(table).fields]
        rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch").parquet(self.path(table))

    @property
    def known_path(self) -> str:
        """URLs as they become known or are forgotten, (url, loaded, told_at), for streams to follow."""
        return f"{self.root}/known_urls"

    def tell_known(self, urls: DataFrame, batch: int, run: str = DEFAULT_RUN, loaded: bool = True) -> None:
        """Tell streams that recipes of `urls` are in the catalogue, or no longer are."""
        told = urls.select("url", F.lit(loaded).alias("loaded"), F.current_timestamp().alias("told_at"))
        told.write.mode("overwrite").parquet(f"{self.known_path}/run={run}/batch={batch}")

    def stage(self, name: str, rows: DataFrame, batch: int = 0, run: str = DEFAULT_RUN) -> DataFrame:
        """Write an intermediate result of a batch and read it back.

        Several tables are made from it, so it is computed once; what follows does not depend on lost executors
        of what came before. Only the same batch of the same run and catalogue overwrites it.
        """
        path = f"{self.staging}/run={run}/batch={batch}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def allergens(self) -> DataFrame:
        return seeds.allergens(self.spark)

    def dietary_tags(self) -> DataFrame:
        return seeds.dietary_tags(self.spark)

    def _batches(self, table: str) -> set[Batch]:
        return batches_in(self._loaded(table).inputFiles()) if exists(self.spark, self.path(table)) else set()

    def open_batches(self) -> set[Batch]:
        """Batches that a load has begun and not ended: their sources are written, their log is not."""
        return self._batches("sources") - self._batches("run_log")

    def delete_recipes(self, deleted: DataFrame) -> DataFrame:
        """Remove recipes (`deleted` has `id`) and every row that links to them from storage, from all tables at once.

        Returns the ids that stay because the batch that brings them is not fully loaded yet. Only batches and segments
        with a row to delete are rewritten.
        """
        keys = {"recipes": "id"} | dict.fromkeys(("recipe_ingredients", "recipe_allergens", "recipe_dietary_tags"), "recipe_id")
        ids = self._noted(deleted.select("id").distinct())
        urls = self._noted(deal(self.read("recipes").select("id", "url"), "id").join(ids, "id", "left_semi"))
        self._delete(keys, ids)
        left = self.read("recipes").select("id").join(ids, "id", "left_semi")
        self.tell_known(urls.join(left, "id", "left_anti"), 0, f"delete-{uuid.uuid4().hex}", loaded=False)
        return left

    def delete_ingredients(self, deleted: DataFrame) -> DataFrame:
        """Remove ingredients (`deleted` has `id`) that no recipe has, and their allergen rows, from storage.

        Returns the ids that stay: those that a recipe has, and those of batches that are not fully loaded yet.
        """
        ids = self._noted(deleted.select("id").distinct())
        used = quality.used_ingredients({"recipe_ingredients": self.read("recipe_ingredients")}, ids)
        free = self._noted(quality.without_keys(ids, "id", used, "id"))
        self._delete({"ingredients": "id", "ingredient_allergens": "ingredient_id"}, free)
        return self.read("ingredients").select("id").join(ids, "id", "left_semi")

    def _noted(self, ids: DataFrame) -> DataFrame:
        return self.stage("ids", ids, run=f"delete-{uuid.uuid4().hex}")

    def _delete(self, keys: dict[str, str], ids: DataFrame) -> None:
        """Rewrite what holds one of `ids` in the key column of each table, then switch."""
        version, segments = self.versions.current()
        unfinished = self.open_batches()
        new: list[Segment] = []
        for table, key in keys.items():
            rows = self._rows(table, segments)
            keyed = deal(rows.select(key, "run", "batch"), key)
            hit = keyed.join(ids.withColumnRenamed("id", key), key, "left_semi").select("run", "batch").distinct().collect()
            batches = {(r.run, r.batch) for r in hit} - unfinished
            old = [s for s in segments if s.table == table and any(s.covers(*b) for b in batches)]
            units = [(s.run, s.first, s.last) for s in old] + [(r, b, b) for r, b in sorted(batches) if not any(s.covers(r, b) for s in old)]
            if units:
                found = self._unit_rows(table, segments, units)
                kept = quality.without_keys(deal(found, key, tasks=tasks_for(found, FILE_ROWS)), key, ids, "id")
                new += self.versions.write(table, kept, units)
        if new:
            self.versions.switch(version, replaced(segments, new))

    def _unit_rows(self, table: str, segments: list[Segment], units: list[tuple[str, int, int]]) -> DataFrame:
        """The rows of some units, read from their own folders only."""
        wanted = [s for s in segments if s.table == table and any(s.covers(r, b) for r, b, _ in units)]
        loaded = [f"{r}/{n}" for r, first, last in units for n in range(first, last + 1) if not any(s.covers(r, n) for s in wanted)]
        rows = self._loaded(table).where(F.concat_ws("/", "run", F.col("batch").cast("string")).isin(loaded))
        folders = sorted(s.folder for s in wanted if s.folder)
        return rows.unionByName(self.spark.read.schema(self._with_batch(table)).parquet(*folders)) if folders else rows

    def compact(self, segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES) -> int:
        """Put small neighbouring batches and segments together; returns how many segments were made.

        Batches that are still being loaded are left out. Rows keep the number of their batch, so what a batch builds on
        stays the same.
        """
        version, segments = self.versions.current()
        unfinished = self.open_batches()
        new: list[Segment] = []
        for table in schemas.TABLES:
            own = [s for s in segments if s.table == table]
            single = {b for b in self._batches(table) - unfinished if not any(s.covers(*b) for s in own)}
            size = self._sizes(table, own)
            units = [(s.run, s.first, s.last, size.get(s.folder, (0, 0))[0]) for s in own]
            units += [(r, b, b, size.get(f"{r}/{b}", (0, 0))[0]) for r, b in single]
            chosen = bins(units, segment_bytes)
            if not chosen:
                continue
            wide = [(b[0][0], b[0][1], b[-1][2]) for b in chosen]
            held = {(s.run, s.first): size.get(s.folder, (0, 0))[1] for s in own} | {(r, b): size.get(f"{r}/{b}", (0, 0))[1] for r, b in single}
            files = {
                n: max(1, -(-sum(u[3] for u in b) // file_bytes), -(-sum(held[u[0], u[1]] for u in b) // FILE_ROWS)) for n, b in enumerate(chosen)
            }
            parts = [(r, first, last) for b in chosen for r, first, last, _ in b]
            new += self.versions.write(table, self._unit_rows(table, own, parts), wide, files)
        if new:
            self.versions.switch(version, replaced(segments, new))
        return len(new)

    def _sizes(self, table: str, segments: list[Segment]) -> dict[str | None, tuple[int, int]]:
        """Bytes and rows of files by batch (run/batch) and by folder of a segment; files without rows count nothing."""
        scans = [self._loaded(table)] if self._batches(table) else []
        if any(s.folder for s in segments):
            scans.append(self.spark.read.schema(self._with_batch(table)).parquet(*sorted(s.folder for s in segments if s.folder)))
        files = [r for scan in scans for r in scan.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").agg(F.count(F.lit(1))).collect()]
        found: dict[str | None, tuple[int, int]] = {}
        folders = {s.folder.rsplit("/_versions/", 1)[1]: s.folder for s in segments if s.folder}
        for path, size, rows in files:
            m = re.search(r"/run=([^/]+)/batch=(\d+)/", path)
            name = f"{m[1]}/{m[2]}" if m else folders.get(path.rsplit("/_versions/", 1)[-1].rsplit("/", 1)[0])
            before = found.get(name, (0, 0))
            found[name] = (before[0] + size, before[1] + rows)
        return found

    def tidy(self) -> int:
        """Remove what the current version does not read; returns how many folders. Readers of older versions, and rewrites
        that are under way, must have ended."""
        version, segments = self.versions.current()
        if version < 0:
            return 0
        inside = lambda p: below(self.spark, p)
        held = {s.folder.rsplit("/_versions/", 1)[1] for s in segments if s.folder}
        gone = [f"{self.path(t)}/run={r}/batch={b}" for t in schemas.TABLES for r, b in sorted(self._batches(t)) if any(s.table == t and s.covers(r, b) for s in segments)]
        units = [u for made in inside(f"{self.versions.root}/data") for table in inside(made) for u in inside(table) if "/segment=" in u]
        gone += [u for u in units if u.rsplit("/_versions/", 1)[1] not in held]
        gone += [f"{self.versions.root}/list/version={n}" for n in self.versions.numbers() if n < version]
        for folder in gone:
            remove(self.spark, folder)
        return len(gone)

    def save_bucketed(self, table: str, key: str, buckets: int, name: str) -> None:
        """Copy a table into a bucketed catalog table, so joins and roll-ups on `key` need no shuffle.

        Its files lie in the catalogue folder.
        """
        rows = self.read(table)
        (
            rows.repartition(buckets, key)
            .write.mode("overwrite")
            .bucketBy(buckets, key)
            .sortBy(key)
            .format("parquet")
            .option("path", f"{self.root}/_bucketed/{name}")
            .saveAsTable(name)
        )

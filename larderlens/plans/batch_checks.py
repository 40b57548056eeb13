"""The checks of one batch against the whole catalogue, from counts that are kept for every batch.

A batch is noted once: how often each key occurs in it, how many of its rows point to each parent, and its faulty values. Counts of
batches add up, so rules on keys and links over all batches need the notes and no table, and the check of a new batch
needs the notes of the keys that it touches. After a deletion, the batches it rewrote are noted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlens import schemas
from larderlens.operators import quality
from larderlens.plans.checks import check_values
from larderlens.sources.tables import DEFAULT_RUN, Catalogue

# kind: `key` (rule = table.columns), `link` (rule = table.column) or what a faulty value is reported as.
_NOTES = "kind string, rule string, key string, rows long"
_FIXED = ("allergens", "dietary_tags")  # tables that no batch writes


def _marks(table: str) -> list[Column]:
    """What each row of a table counts for."""
    mark = lambda kind, rule, key: F.struct(F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), key.cast("string").alias("key"))
    own = [mark("key", f"{name}.{'+'.join(keys)}", F.concat_ws("|", *keys)) for name, keys in schemas.KEYS if name == table]
    return own + [mark("link", f"{child}.{key}", F.col(key)) for child, key, _ in schemas.LINKS if child == table]


def _path(tables: Catalogue) -> str:
    return f"{tables.root}/batch_notes"


def note_batch(tables: Catalogue, batch: int, run: str = DEFAULT_RUN) -> None:
    """Count the keys, links and faults of one batch. Reads that batch only; noting it again replaces the notes."""
    frames = {name: tables.read_batch(name, batch, run) for name in schemas.TABLES}
    marks = quality.union_all([rows.select(F.inline(F.array(*_marks(name)))) for name, rows in frames.items() if _marks(name)])
    counts = marks.groupBy("kind", "rule", "key").agg(F.count(F.lit(1)).alias("rows"))
    # Notes are narrow; their order lets a check of few keys skip most of a file.
    found = counts.unionByName(check_values(frames)).repartition("kind", "rule", F.pmod(F.xxhash64("key"), F.lit(8)))
    found.sortWithinPartitions("rule", "key").write.mode("overwrite").parquet(f"{_path(tables)}/run={run}/batch={batch}")


def _notes(tables: Catalogue) -> DataFrame:
    return tables.spark.read.schema(f"{_NOTES}, run string, batch long").parquet(_path(tables))


def check_noted(tables: Catalogue) -> DataFrame:
    """(kind, rule, key, rows) of every broken rule over all noted batches, as `check_catalogue` reports it."""
    notes = _notes(tables).drop("run", "batch")
    return _report(tables, notes, notes)


def check_batch(tables: Catalogue, batch: int, run: str = DEFAULT_RUN) -> DataFrame:
    """The same for the keys and links that a noted batch touches, and its own faulty values.

    The notes of other batches are pruned by the keys of this one before anything is added up.
    """
    notes = _notes(tables)
    own = notes.where((F.col("run") == run) & (F.col("batch") == batch)).drop("run", "batch")
    touched = own.where("kind IN ('key', 'link')").select("kind", "rule", "key").distinct()
    noted = notes.drop("run", "batch")
    same = (noted["kind"] == touched["kind"]) & (noted["rule"] == touched["rule"]) & noted["key"].eqNullSafe(touched["key"])
    counts = noted.join(touched, same, "left_semi")
    return _report(tables, counts.unionByName(own.where("kind NOT IN ('key', 'link')")), notes.drop("run", "batch"))


def _report(tables: Catalogue, notes: DataFrame, parents: DataFrame) -> DataFrame:
    """All key rules from one sum, all link rules from one join with the keys of all parents."""
    sums = notes.where("kind IN ('key', 'link')").groupBy("kind", "rule", "key").agg(F.sum("rows").alias("rows"))
    repeated = sums.where("kind = 'key' AND rows > 1").select(F.lit("repeated").alias("kind"), "rule", "key", "rows")
    of_link = F.create_map(*[F.lit(x) for child, key, parent in schemas.LINKS for x in (f"{child}.{key}", f"{parent}.id")])
    held = [getattr(tables, name)().select(F.lit(f"{name}.id").alias("parent"), F.col("id").cast("string").alias("key")) for name in _FIXED]
    held.append(parents.where("kind = 'key' AND endswith(rule, '.id')").select(F.col("rule").alias("parent"), "key"))
    links = sums.where("kind = 'link'").withColumn("parent", of_link[F.col("rule")])
    lost = links.join(quality.union_all(held), ["parent", "key"], "left_anti")
    faults = notes.where("kind NOT IN ('key', 'link')").select("kind", "rule", "key", "rows")
    return quality.union_all([repeated, faults, lost.select(F.lit("no parent").alias("kind"), "rule", "key", "rows")])

"""Which folders hold the rows of a table: loaded batches, or segments that took their place.

A segment holds what is left of a span of batches of one run after they were rewritten. A version is the list of all segments, a
file of its own that is written last: until then readers see the old rows of every table, and after it the new ones of all. So a
rewrite that breaks off at any point has changed nothing and is asked for again.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlens.sources.folders import below, exists

Batch = tuple[str, int]


@dataclass(frozen=True, order=True)
class Segment:
    """Batches `first` to `last` of a run, in `folder`; None where no row is left."""

    table: str
    run: str
    first: int
    last: int
    folder: str | None = None

    def covers(self, run: str, batch: int) -> bool:
        return self.run == run and self.first <= batch <= self.last


_SCHEMA = "table string, run string, first long, last long, folder string"


def spans(segments: list[Segment]) -> list[tuple[str, int, int]]:
    """The covered batches as (run, first, last), neighbours put together."""
    found: list[tuple[str, int, int]] = []
    for s in sorted(segments, key=lambda s: (s.run, s.first)):
        if found and found[-1][0] == s.run and found[-1][2] + 1 >= s.first:
            found[-1] = (s.run, found[-1][1], max(found[-1][2], s.last))
        else:
            found.append((s.run, s.first, s.last))
    return found


def outside(covered: list[tuple[str, int, int]]) -> Column:
    """True for rows (run, batch) of no covered span; decided on folder names alone."""
    kept = F.lit(True)
    for run, first, last in covered:
        kept = kept & ~((F.col("run") == run) & F.col("batch").between(first, last))
    return kept


def batches_in(paths: list[str]) -> set[Batch]:
    """The batches whose folders the files lie in."""
    found = (re.search(r"/run=([^/]+)/batch=(\d+)/", path) for path in paths)
    return {(m[1], int(m[2])) for m in found if m}


class Versions:
    """The versions of a catalogue folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/_versions"

    def numbers(self) -> list[int]:
        if not exists(self.spark, f"{self.root}/list"):
            return []
        files = self.spark.read.schema(_SCHEMA).parquet(f"{self.root}/list").inputFiles()
        return sorted({int(m[1]) for m in (re.search(r"/version=(\d+)/", f) for f in files) if m})

    def current(self) -> tuple[int, list[Segment]]:
        """The last version and its segments; number -1 and none where nothing was ever rewritten."""
        numbers = self.numbers()
        if not numbers:
            return -1, []
        rows = self.spark.read.schema(_SCHEMA).parquet(f"{self.root}/list/version={numbers[-1]}").collect()
        return numbers[-1], sorted((Segment(*r) for r in rows), key=lambda s: (s.table, s.run, s.first))

    def switch(self, version: int, segments: list[Segment]) -> None:
        """Make `segments` the version after `version`. Fails when another rewrite has done so first."""
        rows = [(s.table, s.run, s.first, s.last, s.folder) for s in segments]
        listed = self.spark.createDataFrame(rows, _SCHEMA).coalesce(1)
        listed.write.mode("errorifexists").parquet(f"{self.root}/list/version={version + 1}")

    def write(self, table: str, rows: DataFrame, units: list[tuple[str, int, int]], files: dict[int, int] | None = None) -> list[Segment]:
        """Write `rows` (with run and batch) of `units` (run, first, last) to new folders, one for each unit.

        With `files`, the number of files of each unit, rows are brought together and ordered by batch; without it they stay
        in the order of their files.
        """
        path = f"{self.root}/data/{uuid.uuid4().hex}/{table}"
        number = [(files or {}).get(unit, 1) for unit in range(len(units))]
        told = [(run, n, unit, number[unit], sum(number[:unit])) for unit, (run, first, last) in enumerate(units) for n in range(first, last + 1)]
        # A row for each batch, of which the driver has listed the folders anyway.
        listed = self.spark.createDataFrame(told, "run string, batch long, segment int, files int, file int")
        dealt = rows.join(F.broadcast(listed), ["run", "batch"])
        if files is not None:
            key = next(f.name for f in rows.schema if f.name not in ("run", "batch"))
            # A task for each file, so that no task sorts more rows than one file has.
            place = F.col("file") + F.pmod(F.xxhash64(key), F.col("files")).cast("int")
            dealt = dealt.repartitionById(sum(number), place).sortWithinPartitions("segment", "batch")
        dealt.drop("files", "file").write.partitionBy("segment").parquet(path)
        filled = {int(p.rsplit("=", 1)[1]) for p in below(self.spark, path) if "/segment=" in p}
        return [Segment(table, *u, f"{path}/segment={n}" if n in filled else None) for n, u in enumerate(units)]


def replaced(segments: list[Segment], new: list[Segment]) -> list[Segment]:
    """`segments` after `new` ones took the place of those they cover."""
    gone = [s for s in segments if any(n.table == s.table and n.run == s.run and n.first <= s.first and s.last <= n.last for n in new)]
    return sorted([s for s in segments if s not in gone] + new, key=lambda s: (s.table, s.run, s.first))


def bins(units: list[tuple[str, int, int, int]], least_bytes: int) -> list[list[tuple[str, int, int, int]]]:
    """Runs of neighbouring units (run, first, last, bytes) to put together, each until it has `least_bytes`.

    Only batches whose numbers follow each other are put together, so no later one can fall into a segment. A run of one unit
    stays as it is.
    """
    found: list[list[tuple[str, int, int, int]]] = []
    for unit in sorted(units):
        last = found[-1] if found else None
        if last and last[-1][0] == unit[0] and last[-1][2] + 1 == unit[1] and sum(u[3] for u in last) < least_bytes:
            last.append(unit)
        else:
            found.append([unit])
    return [b for b in found if len(b) > 1]

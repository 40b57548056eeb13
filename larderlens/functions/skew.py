"""Balanced work: few-split scans, and joins in which one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is frequent when it holds at least 1 / FREQUENT_KEYS of all rows: there are at most this many.
FREQUENT_KEYS = 1000


def attach_by_key(rows: DataFrame, summary: DataFrame, key: str, weight: str) -> DataFrame:
    """Add the columns of `summary` (one short row per key, `weight` = rows of that key) to `rows`.

    Rows of frequent keys meet a broadcast of at most FREQUENT_KEYS summary rows and are not shuffled.
    No other key is large enough to unbalance the shuffled join. Keys missing from `summary` drop out.
    """
    total = summary.agg(F.sum(weight)).scalar()
    is_frequent = F.col(weight) * FREQUENT_KEYS >= total
    frequent = F.broadcast(summary.where(is_frequent))
    direct = rows.join(frequent, key)
    shuffled = rows.join(frequent, key, "left_anti").join(summary.where(~is_frequent), key)
    return direct.unionByName(shuffled).drop(weight)


# Rows of a table scan that one task takes in joins and groupings by key: some 100 MB of hash maps and sorted rows.
ROWS_PER_TASK = 250_000


def tasks_for(scan: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """How many tasks a plain table scan (or a projection of one) is dealt to: their number grows with the rows, so that
    none has more to do in a larger table. Rows are counted from the file footers."""
    return max(scan.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // rows_per_task))


def deal(scan: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """Deal the rows of a plain table scan to tasks by `keys`; groupings and joins on these need no further shuffle.

    The splits of a scan say little about its rows: a file with one row group is one task however many splits it has. And the
    shuffles that Spark plans are put together into about as many tasks as there are cores, which grow with the table.
    """
    return scan.repartition(tasks or tasks_for(scan), *keys)


def widen(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a plain table scan over all cores when it has fewer splits than there are cores.

    Meant for small files in front of costly per-row work. A scan with enough splits is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan

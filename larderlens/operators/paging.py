"""Pages by number at any depth: a positional index over rows in id order.

The rows are written once in ranges of ids, each in order, and the index holds for each range its ids and the number of rows
before it. A page reads the ranges it lies in and no others, so page 50,000 costs what page 1 does. The index belongs to
the rows it was built from; after a load or a deletion it is built anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larderlens.operators.search import _check_size
from larderlens.sources.folders import below

ROWS_PER_RANGE = 100_000


class PageIndex:
    """The index in the folder `path`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, rows: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> PageIndex:
        """Index `rows` (id unique, not null). Ranges are as even as a sample of ids can make them."""
        ranges = max(1, -(-rows.count() // rows_per_range))
        dealt = rows.repartitionByRange(ranges, "id").sortWithinPartitions("id").withColumn("range", F.spark_partition_id())
        dealt.write.mode("overwrite").partitionBy("range").parquet(f"{self.path}/rows")
        rows.limit(0).write.mode("overwrite").parquet(f"{self.path}/columns")
        sizes = self._rows().groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
        # A row for each range: the window sees as many rows as there are ranges.
        before = F.coalesce(F.sum("n").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sizes.select("range", "n", before.alias("before")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index")
        return self

    def _index(self) -> DataFrame:
        return self.spark.read.schema("range int, n long, before long").parquet(f"{self.path}/index")

    def _rows(self) -> DataFrame:
        columns = self.spark.read.parquet(f"{self.path}/columns").schema
        if not any("/range=" in p for p in below(self.spark, f"{self.path}/rows")):
            return self.spark.createDataFrame([], columns.add("range", "integer"))
        return self.spark.read.schema(columns.add("range", "integer")).parquet(f"{self.path}/rows")

    def total(self) -> int:
        return self._index().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def page(self, number: int = 1, size: int = 20) -> DataFrame:
        """One page in id order, read from the one or two ranges it lies in. Past the end it is empty."""
        if number < 1:
            raise ValueError("pages start at 1")
        _check_size(size)
        first = (number - 1) * size
        held = self._index().where((F.col("before") < first + size) & (F.col("before") + F.col("n") > first)).orderBy("before").collect()
        rows = self._rows().where(F.col("range").isin([r.range for r in held])).drop("range")
        return rows.orderBy("id").offset(first - held[0].before if held else 0).limit(size)

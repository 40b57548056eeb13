"""Work of one task stays the same in larger tables."""

import pytest
from pyspark.sql import functions as F

from larderlens.functions import skew
from larderlens.plans import bindings, queries
from larderlens.sources import tables as stored
from larderlens.sources.tables import Catalogue


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Orders and line items, each in one file with one row group."""
    folder = str(tmp_path_factory.mktemp("star"))
    orders = spark.range(2_000).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 50).alias("o_custkey"),
        F.when(F.col("id") % 5 == 0, "5-LOW").otherwise("1-URGENT").alias("o_orderpriority"),
    )
    items = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("l_linenumber"))
    orders.coalesce(1).write.parquet(f"{folder}/orders.parquet")
    items.withColumn("l_partkey", F.col("l_orderkey") + F.col("l_linenumber")).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def largest(frame):
    return frame.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]


def test_tasks_grow_with_the_rows_of_a_scan(spark, star):
    scan = bindings.table(spark, star, "lineitem")
    assert skew.tasks_for(scan, 100) == 60
    assert largest(skew.deal(scan, "l_orderkey", tasks=60).select("l_orderkey")) < 400
    assert skew.tasks_for(scan.limit(0)) == spark.sparkContext.defaultParallelism


def test_lines_and_pages_of_one_row_group_are_many_tasks(spark, star, monkeypatch):
    monkeypatch.setattr(bindings, "PAGES_PER_TASK", 50)
    assert bindings.pages(spark, star, with_lines=False).rdd.getNumPartitions() == 40
    assert bindings.lines(spark, star, tasks=30).rdd.getNumPartitions() == 30


def test_lines_are_flagged_once_for_both_links(spark, star):
    for links in queries._both_links(spark, star):
        assert "regexp_replace" not in links._jdf.queryExecution().toString()


def test_keys_are_counted_where_they_are_dealt(spark, star):
    """No grouping by URL or by recipe is left to shuffles whose tasks grow with the table."""
    plan = skew.deal(bindings.recipes(spark, star).select("url"), "url").groupBy("url").count()._jdf.queryExecution().toString()
    assert "ENSURE_REQUIREMENTS" not in plan and "REPARTITION_BY_NUM" in plan


def test_a_task_of_compaction_sorts_no_more_rows_than_a_file_has(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "FILE_ROWS", 100)
    tables = Catalogue(spark, str(tmp_path / "catalogue"))
    rows = spark.range(1_000).select(F.col("id").alias("recipe_id"), F.lit(1).alias("allergen_id"))
    for batch in range(2):
        part = rows.where(F.col("recipe_id") % 2 == batch)
        tables.import_rows("recipe_allergens", part.withColumns({"run": F.lit("loads"), "batch": F.lit(batch)}))
    assert tables.compact() == 1
    folder = tables.versions.current()[1][0].folder
    assert len(spark.read.parquet(folder).inputFiles()) == 10
    assert tables.read("recipe_allergens").count() == 1_000
    tables.delete_recipes(spark.createDataFrame([(n,) for n in range(0, 1_000, 2)], "id long"))
    assert sorted(r.recipe_id for r in tables.read("recipe_allergens").collect()) == list(range(1, 1_000, 2))

"""Stored deletes and compaction: all tables switch at once, whatever breaks off, and old batches stay harmless."""

import glob
import shutil

import pytest
from pyspark.sql import functions as F
from test_loading import FIRST, SECOND, SITE_A, content, frame, page, titles

from larderlens.functions.staging import shared_folder
from larderlens.plans.catalogue import load_batch
from larderlens.plans.checks import check_catalogue
from larderlens.sources.segments import Segment, Versions, bins, spans
from larderlens.sources.tables import Catalogue


@pytest.fixture(scope="module")
def two_batches(spark, tmp_path_factory):
    made = Catalogue(spark, str(tmp_path_factory.mktemp("loaded")), staging=str(tmp_path_factory.mktemp("staging")))
    load_batch(made, frame(spark, FIRST), 0)
    load_batch(made, frame(spark, SECOND), 1)
    return made.root


@pytest.fixture
def tables(spark, tmp_path, two_batches):
    """A catalogue of two batches that a test may change."""
    shutil.copytree(two_batches, tmp_path / "catalogue")
    return Catalogue(spark, str(tmp_path / "catalogue"))


def ids_of(tables, table, where):
    return tables.spark.createDataFrame(tables.read(table).where(where).select("id").collect(), "id long")


@pytest.mark.parametrize("table", ["recipe_ingredients", "recipe_dietary_tags"])
def test_a_deletion_that_breaks_off_changes_nothing_and_can_be_asked_again(tables, monkeypatch, table):
    gone = ids_of(tables, "recipes", "url IN ('u/1', 'u/8')")
    before = content(tables)
    write = Versions.write

    def breaks(self, name, rows, *more):
        if name == table:  # the job fails on an executor, after tables before it were written
            rows = rows.withColumn("recipe_id", F.when(F.rand() < 2, F.raise_error(F.lit("lost")).cast("long")))
        return write(self, name, rows, *more)

    monkeypatch.setattr(Versions, "write", breaks)
    with pytest.raises(Exception, match="lost"):
        tables.delete_recipes(gone)
    assert content(tables) == before
    monkeypatch.setattr(Versions, "write", write)
    assert tables.delete_recipes(gone).collect() == []
    assert sorted(titles(tables)) == ["u/2", "u/3", "u/5", "u/7"]
    after = content(tables)
    lost = {r.id for r in gone.collect()}
    for name, key in (("recipes", 0), ("recipe_ingredients", 0), ("recipe_allergens", 0), ("recipe_dietary_tags", 0)):
        assert after[name] == [r for r in before[name] if r[key] not in lost]
    assert check_catalogue(tables).collect() == []


def test_a_deletion_that_fails_at_the_switch_changes_nothing(tables, monkeypatch):
    before = content(tables)
    switch = Versions.switch
    monkeypatch.setattr(Versions, "switch", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        tables.delete_recipes(ids_of(tables, "recipes", "url = 'u/1'"))
    monkeypatch.setattr(Versions, "switch", switch)
    assert content(tables) == before


def test_only_batches_with_a_deleted_row_are_rewritten(tables):
    tables.delete_recipes(ids_of(tables, "recipes", "url = 'u/8'"))
    held = {(s.table, s.first, s.last) for s in tables.versions.current()[1]}
    assert held == {(t, 1, 1) for t in ("recipes", "recipe_ingredients", "recipe_dietary_tags")}


def test_ingredients_in_use_are_refused_and_others_go_with_their_allergens(tables):
    eggs, onion = (ids_of(tables, "ingredients", f"raw_name = '{n}'") for n in ("2 eggs", "1 onion"))
    before = content(tables)
    assert sorted(tables.delete_ingredients(eggs.union(onion)).collect()) == sorted(eggs.union(onion).collect())
    assert content(tables) == before
    tables.delete_recipes(ids_of(tables, "recipes", "url = 'u/1'"))
    assert tables.delete_ingredients(eggs.union(onion)).collect() == onion.collect()
    assert tables.read("ingredients").join(eggs, "id").isEmpty()
    assert tables.read("ingredient_allergens").join(eggs, F.col("ingredient_id") == F.col("id")).isEmpty()
    assert check_catalogue(tables).collect() == []


def test_rows_of_an_unfinished_batch_stay_and_are_told(spark, tables):
    new = [("u/9", SITE_A, page("Nine", "1 onion"), 20)]
    load_batch(tables, frame(spark, new), 2)
    spark._jvm.org.apache.commons.io.FileUtils.deleteDirectory(spark._jvm.java.io.File(f"{tables.path('run_log')}/run=loads/batch=2"))
    gone = ids_of(tables, "recipes", "url IN ('u/9', 'u/8')")
    assert [r.id for r in tables.delete_recipes(gone).collect()] == [r.id for r in ids_of(tables, "recipes", "url = 'u/9'").collect()]
    load_batch(tables, frame(spark, new), 2)
    assert check_catalogue(tables).collect() == []
    assert tables.delete_recipes(gone).collect() == [] and "u/9" not in titles(tables)


def test_many_batches_become_few_files_and_old_ones_stay_harmless(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path))
    log = tables._with_batch("run_log")
    rows = spark.range(200).select(
        F.lit(1).cast("long").alias("source_id"), F.concat(F.lit("u/"), "id").alias("url"), F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error_message"), F.current_timestamp().alias("scraped_at"), F.lit("loads").alias("run"), F.col("id").alias("batch"),
    )
    rows.to(log).repartition(1).write.partitionBy("run", "batch").parquet(tables.path("run_log"))
    urls = lambda **of: sorted(r.url for r in tables.read("run_log", **of).collect())
    want, early = urls(), urls(before_batch=80)
    assert len(want) == 200 and len(early) == 80
    assert tables.compact() == 1 and tables.compact() == 0
    assert urls() == want and urls(before_batch=80) == early
    assert len(tables.read("run_log").inputFiles()) < 203  # listed still, not read
    tables.write("run_log", tables.read("run_log").limit(1).withColumn("url", F.lit("again")), 7)
    assert urls() == want
    assert tables.tidy() == 200
    assert len(glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)) <= 3 and urls() == want
    tables.write("run_log", tables.read("run_log").limit(1).withColumn("url", F.lit("new")), 200)
    assert urls() == sorted([*want, "new"])


def test_compaction_deletion_and_loading_go_together(spark, tables):
    before = content(tables)
    tables.compact()
    assert content(tables) == before
    load_batch(tables, frame(spark, FIRST), 0)
    assert content(tables) == before
    tables.delete_recipes(ids_of(tables, "recipes", "url = 'u/8'"))
    load_batch(tables, frame(spark, SECOND), 2)
    assert "u/8" in titles(tables) and check_catalogue(tables).collect() == []
    same = content(tables)
    tables.compact()
    tables.tidy()
    assert content(tables) == same
    assert len(tables.read("recipes").inputFiles()) == 1


def test_two_rewrites_at_once_are_told_apart(tables):
    version, segments = tables.versions.current()
    tables.compact()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.versions.switch(version, segments)


def test_spans_and_bins():
    parts = [Segment("t", "a", 3, 4), Segment("t", "a", 0, 2), Segment("t", "a", 6, 6), Segment("t", "b", 7, 7)]
    assert spans(parts) == [("a", 0, 4), ("a", 6, 6), ("b", 7, 7)]
    units = [("a", n, n, 10) for n in (0, 1, 2, 4, 5, 9)] + [("b", 10, 12, 99), ("b", 13, 13, 1)]
    assert [[u[1] for u in b] for b in bins(units, 20)] == [[0, 1], [4, 5]]
    assert bins([("a", 0, 0, 5)], 100) == []


def test_a_cluster_needs_a_named_folder(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(spark.conf, "get", lambda name, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(spark)

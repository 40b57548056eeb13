"""Work per batch that does not grow with the catalogue: URL state of a stream, and checks from notes."""

import pytest
from pyspark.sql import functions as F
from test_loading import FIRST, SECOND, SITE_A, content, frame, page, titles

from larderlens.plans.batch_checks import check_batch, check_noted, note_batch
from larderlens.plans.catalogue import load_batch
from larderlens.plans.checks import check_catalogue
from larderlens.sources.tables import Catalogue
from larderlens.streaming.incremental import start_loading


def run_stream(spark, pages, root):
    query = start_loading(spark, pages, root)
    query.awaitTermination(200)
    assert query.exception() is None
    progress = query.recentProgress
    query.stop()
    return progress


def deliver(spark, pages, *rows):
    made = spark.createDataFrame(list(rows), "url string, source string, html string, arrival long")
    made.coalesce(1).write.mode("append").parquet(pages)


def statuses(tables):
    return sorted((r.url, r.status, r.error_message) for r in tables.read("run_log").collect())


def test_a_batch_meets_the_state_of_its_own_urls_only(spark, tmp_path, monkeypatch):
    pages, root = str(tmp_path / "pages"), str(tmp_path / "catalogue")
    tables = Catalogue(spark, root)
    deliver(spark, pages, *[(f"u/{n}", SITE_A, page(f"T{n}", "1 onion"), n) for n in range(60)])
    run_stream(spark, pages, root)
    # Another writer loads one and deletes one; the stream is told of both, and of nothing else.
    load_batch(tables, frame(spark, [("u/other", SITE_A, page("Other", "1 onion"), 1)]), 0)
    tables.delete_recipes(tables.read("recipes").where("url = 'u/7'").select("id"))
    deliver(spark, pages, ("u/other", SITE_A, page("Again", "1 onion"), 1), ("u/7", SITE_A, page("T7 anew", "1 onion"), 2), ("u/8", SITE_A, page("T8 anew", "1 onion"), 3), (None, SITE_A, page("No name", "x"), 4))
    reads, read = [], Catalogue.read

    def noted(self, table, *more, **names):
        reads.append(table)
        return read(self, table, *more, **names)

    monkeypatch.setattr(Catalogue, "read", noted)
    progress = run_stream(spark, pages, root)
    monkeypatch.setattr(Catalogue, "read", read)
    assert "recipes" not in reads
    # Pages, what the other writer told, and what the stream itself told of its first batch.
    assert sum(p["numInputRows"] for p in progress) <= 4 + 2 + 60
    got = titles(tables)
    assert got["u/other"] == "Other" and got["u/7"] == "T7 anew" and got["u/8"] == "T8" and len(got) == 61
    assert ("", "failed", "url missing") in statuses(tables) and ("u/8", "skipped", None) in statuses(tables)
    assert check_catalogue(tables).collect() == []
    # A third run is told of one URL only.
    deliver(spark, pages, ("u/9", SITE_A, page("T9 anew", "1 onion"), 1))
    assert sum(p["numInputRows"] for p in run_stream(spark, pages, root)) <= 1 + 2


def test_a_batch_that_breaks_off_is_repeated_with_the_same_state(spark, tmp_path, monkeypatch):
    pages, root = str(tmp_path / "pages"), str(tmp_path / "catalogue")
    deliver(spark, pages, *FIRST)
    write = Catalogue.write
    monkeypatch.setattr(Catalogue, "write", lambda self, table, *a: (_ for _ in ()).throw(OSError("lost")) if table == "recipe_allergens" else write(self, table, *a))
    query = start_loading(spark, pages, root)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination(200)
    monkeypatch.setattr(Catalogue, "write", write)
    run_stream(spark, pages, root)
    single = Catalogue(spark, str(tmp_path / "single"))
    load_batch(single, frame(spark, FIRST), 0)
    assert content(Catalogue(spark, root)) == content(single)


def rows_of(report):
    return sorted((r.kind, r.rule, r.key, r.rows) for r in report.collect())


def test_notes_of_batches_report_what_the_whole_catalogue_does(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path))
    for n, rows in enumerate((FIRST, SECOND)):
        load_batch(tables, frame(spark, rows), n)
        note_batch(tables, n)
    assert rows_of(check_noted(tables)) == rows_of(check_catalogue(tables)) == []
    # A third batch repeats a recipe, links to nothing, and has values that are not allowed.
    again = tables.read("recipes").where("url = 'u/1'").withColumn("title", F.lit("x" * 300))
    tables.write("recipes", again, 2)
    tables.write("recipe_allergens", spark.createDataFrame([(5, 3), (5, 99)], "recipe_id long, allergen_id int"), 2)
    tables.write("run_log", tables.read("run_log").limit(1).withColumn("status", F.lit("odd")), 2)
    note_batch(tables, 2)
    want = rows_of(check_catalogue(tables))
    assert len(want) == 6 and rows_of(check_noted(tables)) == want
    assert rows_of(check_batch(tables, 2)) == want and rows_of(check_batch(tables, 1)) == []
    note_batch(tables, 2)
    assert rows_of(check_noted(tables)) == want


def test_the_check_of_a_batch_finds_keys_of_earlier_batches(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path))
    for n in (0, 1):
        tables.write("ingredients", spark.createDataFrame([(n, "salt", "salt")], "id long, raw_name string, normalised_name string").withColumn("created_at", F.current_timestamp()), n)
        note_batch(tables, n)
    assert rows_of(check_batch(tables, 1)) == [("repeated", "ingredients.raw_name", "salt", 2)] == rows_of(check_catalogue(tables))

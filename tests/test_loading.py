import json

import pytest
from pyspark.sql import functions as F

from larderlens import schemas, session
from larderlens.functions.skew import attach_by_key
from larderlens.operators import arrivals, quality
from larderlens.plans.checks import check_catalogue
from larderlens.plans.catalogue import SOURCES, discover_all, load_batch
from larderlens.sources import seeds
from larderlens.sources.pages import read_pages
from larderlens.sources.tables import Catalogue
from larderlens.streaming.incremental import start_loading

SITE_A, SITE_B = SOURCES[0].base_url, SOURCES[1].base_url


def page(name, *lines, **more):
    node = {"@type": "Recipe", "name": name, "recipeIngredient": list(lines), **more}
    return f'<script type="application/ld+json">{json.dumps(node)}</script>'


FIRST = [
    ("u/1", SITE_A, page("One", "2 eggs", "100ml double cream", "2 eggs", recipeCuisine="british"), 1),
    ("u/2", SITE_B, page("Two", "1 onion", recipeCategory="Dinner Recipes"), 2),
    ("u/3", SITE_A, "<p>no recipe yet</p>", 3),
    ("u/1", SITE_A, page("One again", "beef"), 4),
    ("u/4", SITE_A, page("x" * 300, "beef"), 5),
    ("u/5", SITE_A, page("Empty"), 6),
    ("u/6", "https://unknown.org", page("Not a source"), 7),
    ("u/7", SITE_A, "<p>first nothing</p>", 8),
    ("u/7", SITE_A, page("Seven", "1 onion"), 9),
    ("u/7", SITE_A, "<p>later nothing</p>", 10),
]
SECOND = [
    ("u/1", SITE_A, page("One once more", "beef"), 11),
    ("u/3", SITE_A, page("Three", "1 onion", "1 tbsp coconut cream mayonnaise"), 12),
    ("u/8", SITE_B, page("Eight", "100g kale"), 13),
]
FACTS = ("sources", "recipes", "ingredients", "recipe_ingredients", "ingredient_allergens", "recipe_allergens", "recipe_dietary_tags", "run_log")


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.PAGES)


def content(tables):
    """All tables, without the columns that hold the time of the run."""
    times = ("created_at", "scraped_at")
    return {n: sorted((tuple(r) for r in tables.read(n).drop(*times).collect()), key=repr) for n in FACTS}


def titles(tables):
    return {r.url: r.title for r in tables.read("recipes").collect()}


def tags(tables, url):
    rows = tables.read("recipe_dietary_tags").where(F.col("recipe_id") == F.xxhash64(F.lit(url)))
    return {r.name for r in rows.join(tables.dietary_tags(), F.col("dietary_tag_id") == F.col("id")).collect()}


def allergens(tables, url):
    rows = tables.read("recipe_allergens").where(F.col("recipe_id") == F.xxhash64(F.lit(url)))
    return {r.name for r in rows.join(tables.allergens(), F.col("allergen_id") == F.col("id")).collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    tables = Catalogue(spark, str(tmp_path_factory.mktemp("catalogue")))
    load_batch(tables, frame(spark, FIRST), 0)
    load_batch(tables, frame(spark, SECOND), 1)
    return tables


def test_tables(loaded):
    assert titles(loaded) == {"u/1": "One", "u/2": "Two", "u/3": "Three", "u/5": "Empty", "u/7": "Seven", "u/8": "Eight"}
    assert {r.url: r.cuisine for r in loaded.read("recipes").collect() if r.cuisine} == {"u/1": "British", "u/2": "Dinner"}
    assert allergens(loaded, "u/1") == {"dairy", "egg"} and allergens(loaded, "u/2") == set()
    assert tags(loaded, "u/5") == {"vegetarian", "vegan", "gluten_free"}
    assert tags(loaded, "u/1") == {"vegetarian", "gluten_free"}
    assert "contains_raw_egg" in tags(loaded, "u/3")
    names = sorted((r.raw_name, r.normalised_name) for r in loaded.read("ingredients").collect())
    assert names == [
        ("1 onion", "onion"), ("1 tbsp coconut cream mayonnaise", "coconut cream mayonnaise"),
        ("100g kale", "kale"), ("100ml double cream", "double cream"), ("2 eggs", "eggs"),
    ]
    assert loaded.read("recipe_ingredients").count() == 2 + 1 + 1 + 2 + 1
    assert {r.confidence for r in loaded.read("ingredient_allergens").collect()} == {"high"}
    assert sorted(r.base_url for r in loaded.read("sources").collect()) == sorted((SITE_A, SITE_B))


def test_log(loaded):
    log = loaded.read("run_log").collect()
    assert sorted((r.url, r.status) for r in log) == sorted(
        [("u/1", "success"), ("u/2", "success"), ("u/3", "skipped"), ("u/1", "skipped"), ("u/4", "failed"), ("u/5", "success"),
         ("u/7", "skipped"), ("u/7", "success"), ("u/7", "skipped"), ("u/1", "skipped"), ("u/3", "success"), ("u/8", "success")]
    )
    assert [r.error_message for r in log if r.status == "failed"] == ["title longer than 255"]
    counts = {tuple(r)[1:] for r in arrivals.run_summary(loaded.read("run_log")).collect()}
    assert counts == {(9, 1), (2, 0)}


def test_roll_up_is_bridge_joined_with_ingredient_allergens(loaded):
    joined = loaded.read("recipe_ingredients").join(loaded.read("ingredient_allergens"), "ingredient_id")
    want = {tuple(r) for r in joined.select("recipe_id", "allergen_id").distinct().collect()}
    assert {tuple(r) for r in loaded.read("recipe_allergens").collect()} == want


def test_vegan_implies_vegetarian(loaded):
    links = loaded.read("recipe_dietary_tags")
    vegan = {r.recipe_id for r in links.where("dietary_tag_id = 2").collect()}
    assert vegan <= {r.recipe_id for r in links.where("dietary_tag_id = 1").collect()}


def test_catalogue_is_sound(loaded):
    assert check_catalogue(loaded).collect() == []


def test_check_finds_what_is_broken(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path / "c"), staging=str(tmp_path / "staging"))
    load_batch(tables, frame(spark, FIRST), 0)
    assert (tmp_path / "staging" / "run=loads" / "batch=0" / "parsed").is_dir() and not (tmp_path / "c" / "_staging").exists()
    recipes = tables.read("recipes")
    double = recipes.where("url = 'u/1'").withColumn("title", F.repeat(F.lit("x"), 300))
    stray = recipes.where("url = 'u/2'").select(F.lit(5).alias("id"), F.lit(6).alias("source_id"), F.lit(None).alias("title"), F.lit("u/x").alias("url"), *recipes.columns[4:])
    tables.write("recipes", double.unionByName(stray), 7)
    tables.write("run_log", tables.read("run_log").limit(1).withColumn("status", F.lit("odd")), 7)
    found = {(r.kind, r.rule, r.rows) for r in check_catalogue(tables).collect()}
    assert found == {
        ("repeated", "recipes.url", 2), ("repeated", "recipes.id", 2), ("no parent", "recipes.source_id", 1),
        ("value", "recipes.title longer than 255", 1), ("value", "recipes.title missing", 1), ("domain", "run_log.status=odd", 1),
    }


def test_keys_and_links_hold(loaded):
    assert quality.duplicate_keys(loaded.read("recipes"), "url", ["url"]).isEmpty()
    assert quality.duplicate_keys(loaded.read("recipes"), "id", ["id"]).isEmpty()
    assert quality.duplicate_keys(loaded.read("ingredients"), "raw_name", ["raw_name"]).isEmpty()
    for child, key, parent in (
        ("recipe_ingredients", "recipe_id", "recipes"), ("recipe_ingredients", "ingredient_id", "ingredients"),
        ("ingredient_allergens", "ingredient_id", "ingredients"), ("recipe_allergens", "recipe_id", "recipes"),
        ("recipe_dietary_tags", "recipe_id", "recipes"), ("recipes", "source_id", "sources"), ("run_log", "source_id", "sources"),
    ):
        assert quality.orphans(loaded.read(child), key, loaded.read(parent), "id", child).isEmpty(), child


def test_running_a_batch_again_changes_nothing(spark, loaded):
    before = content(loaded)
    load_batch(loaded, frame(spark, SECOND), 1)
    assert content(loaded) == before


def test_known_pages_add_no_rows(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path))
    load_batch(tables, frame(spark, FIRST), 0)
    before = content(tables)
    load_batch(tables, frame(spark, FIRST), 1)
    after = content(tables)
    assert {n: v for n, v in after.items() if n != "run_log"} == {n: v for n, v in before.items() if n != "run_log"}
    assert len(after["run_log"]) == 2 * len(before["run_log"])


def test_no_source_enabled_does_nothing(spark, tmp_path):
    from dataclasses import replace

    tables = Catalogue(spark, str(tmp_path))
    load_batch(tables, frame(spark, FIRST), 0, tuple(replace(s, enabled=False) for s in SOURCES))
    assert content(tables) == {n: [] for n in FACTS}


def test_stream_runs_equal_one_batch_run(spark, loaded, tmp_path):
    """Two runs over two deliveries, and a third that finds nothing new."""
    pages, root = str(tmp_path / "pages"), str(tmp_path / "catalogue")
    for rows in (FIRST, SECOND, []):
        if rows:
            frame(spark, rows).coalesce(1).write.mode("append").parquet(pages)
        query = start_loading(spark, pages, root)
        query.awaitTermination(120)
        assert query.exception() is None
        query.stop()
    assert content(Catalogue(spark, root)) == content(loaded)


def test_stream_and_batch_loads_share_a_catalogue(spark, tmp_path):
    """Both number their batches from 0; neither overwrites the other, also when the stream loses its progress."""
    import shutil

    pages, root = str(tmp_path / "pages"), str(tmp_path / "catalogue")
    tables = Catalogue(spark, root)
    load_batch(tables, frame(spark, [("u/old", SITE_A, page("Old", "1 onion"), 1)]), 0)
    frame(spark, FIRST).coalesce(1).write.parquet(pages)
    for _ in range(2):
        query = start_loading(spark, pages, root)
        query.awaitTermination(120)
        assert query.exception() is None
        assert titles(tables) == {"u/old": "Old", "u/1": "One", "u/2": "Two", "u/5": "Empty", "u/7": "Seven"}
        assert check_catalogue(tables).collect() == []
        shutil.move(f"{root}/_progress", str(tmp_path / "lost"))


def test_stream_configures_the_session(spark, tmp_path):
    """A page that repeats a JSON key is read as on a configured session."""
    pages, own = str(tmp_path / "pages"), spark.newSession()
    own.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    body = page("Twice", "1 onion").replace('"@type"', '"name": "First", "@type"')
    frame(spark, [("u/d", SITE_A, body, 1)]).write.parquet(pages)
    query = start_loading(own, pages, str(tmp_path / "c"))
    query.awaitTermination(120)
    assert query.exception() is None
    assert titles(Catalogue(spark, str(tmp_path / "c"))) == {"u/d": "Twice"}


def test_catalogues_stage_apart(spark, tmp_path):
    one, two = Catalogue(spark, str(tmp_path / "cat-a")), Catalogue(spark, str(tmp_path / "cat_a"))
    assert one.staging != two.staging
    left, right = (t.stage("x", spark.range(n)) for t, n in ((one, 3), (two, 5)))
    assert (left.count(), right.count()) == (3, 5)


def test_pages_without_url_are_logged_and_never_loaded(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path))
    rows = [(None, SITE_A, page("Lost", "1 onion"), 1), ("", SITE_A, page("Blank"), 2), ("u/" + "x" * 600, SITE_A, page("Long"), 3), ("u/1", SITE_A, page("One"), 4)]
    schema = "url string, source string, html string, arrival long"
    for batch in range(2):
        load_batch(tables, spark.createDataFrame(rows, schema), batch)
    assert titles(tables) == {"u/1": "One"}
    log = [(r.url[:9], r.status, r.error_message) for r in tables.read("run_log").collect()]
    assert log.count(("", "failed", "url missing")) == 4
    assert log.count(("u/xxxxxxx", "failed", "url longer than 500")) == 2 and len(log) == 8
    assert check_catalogue(tables).collect() == []


def test_only_found_urls_are_loaded(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path))
    urls = spark.createDataFrame([(SITE_A, "u/1"), (SITE_A, "u/1"), (SITE_A, "u/2"), (SITE_B, "u/9")], "source string, url string")
    load_batch(tables, frame(spark, FIRST), 0, urls=urls)
    assert titles(tables) == {"u/1": "One"}
    assert sorted(r.status for r in tables.read("run_log").collect()) == ["skipped", "success"]


def test_discovery_over_sources(spark):
    xml = "<urlset><url><loc>{}</loc></url></urlset>"
    rows = [
        (SITE_A, 0, f"{SITE_A}/2026-Q1-recipe.xml", xml.format(f"{SITE_A}/recipes/a")),
        (SITE_B, 0, f"{SITE_B}/post-sitemap.xml", xml.format(f"{SITE_B}/b")),
    ]
    maps = spark.createDataFrame(rows, schemas.SITEMAPS)
    assert sorted(r.url for r in discover_all(maps).collect()) == sorted([f"{SITE_A}/recipes/a", f"{SITE_B}/b"])
    assert discover_all(maps, ()).count() == 0


def test_sources_are_added_once(spark):
    existing = spark.createDataFrame([("A", "a.org")], "name string, base_url string")
    wanted = spark.createDataFrame([("A2", "a.org"), ("B", "b.org"), ("B", "b.org")], "name string, base_url string")
    assert [tuple(r) for r in seeds.add_sources(existing, wanted).collect()] == [("B", "b.org")]


def test_read_pages(spark, tmp_path):
    spark.createDataFrame([("u", "<p>")], "url string, html string").write.parquet(str(tmp_path / "p"))
    assert [tuple(r) for r in read_pages(spark, str(tmp_path / "p")).collect()] == [("u", None, "<p>", None)]


def test_bucketed_copy_joins_without_shuffle(spark, loaded):
    loaded.save_bucketed("recipes", "id", 4, "t_recipes")
    loaded.save_bucketed("recipe_allergens", "recipe_id", 4, "t_recipe_allergens")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = spark.table("t_recipe_allergens")
        joined = spark.table("t_recipes").join(links, F.col("id") == links.recipe_id, "left_anti")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.sql("DROP TABLE t_recipes")
        spark.sql("DROP TABLE t_recipe_allergens")


def test_cascading_deletes(spark, loaded):
    tables = {n: loaded.read(n) for n in FACTS}
    gone = tables["recipes"].where("url = 'u/1'").select("id")
    left = quality.delete_recipes(tables, gone)
    assert left["recipes"].count() == 5 and left["recipe_ingredients"].count() == 5
    assert left["recipe_allergens"].join(gone, F.col("recipe_id") == F.col("id")).isEmpty()
    assert left["recipe_dietary_tags"].join(gone, F.col("recipe_id") == F.col("id")).isEmpty()
    assert left["ingredients"].count() == 5
    eggs = tables["ingredients"].where("raw_name = '2 eggs'").select("id")
    assert quality.used_ingredients(tables, eggs).count() == 1
    assert quality.delete_ingredients(tables, eggs)["ingredients"].count() == 5
    left = quality.delete_ingredients(left, eggs)
    assert left["ingredients"].count() == 4
    assert left["ingredient_allergens"].join(eggs, F.col("ingredient_id") == F.col("id")).isEmpty()


def test_deletion_reaches_storage(spark, tmp_path):
    tables = Catalogue(spark, str(tmp_path))
    load_batch(tables, frame(spark, FIRST), 0)
    load_batch(tables, frame(spark, SECOND), 1)
    ids = tables.read("recipes").where("url IN ('u/1', 'u/8')").select("id").collect()
    gone = spark.createDataFrame(ids, "id long")
    kept = tables.read("recipe_ingredients").join(gone, F.col("recipe_id") == F.col("id"), "left_anti").count()
    for _ in range(2):
        tables.delete_recipes(gone)
        assert sorted(titles(tables)) == ["u/2", "u/3", "u/5", "u/7"]
        assert tables.read("recipe_ingredients").count() == kept
        assert check_catalogue(tables).collect() == []
    load_batch(tables, frame(spark, FIRST), 2)
    assert titles(tables)["u/1"] == "One"


def test_attach_with_a_hot_key_equals_a_join(spark):
    """One key holds a third of the rows, most others one row each."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) AS url", "id AS n")
    summary = rows.groupBy("url").agg(F.max("n").alias("last"), F.count("*").alias("w"))
    got = attach_by_key(rows, summary, "url", "w").agg(F.count("*"), F.sum("last"), F.sum("n")).first()
    want = rows.join(summary.drop("w"), "url").agg(F.count("*"), F.sum("last"), F.sum("n")).first()
    assert tuple(got) == tuple(want) and got[0] == 30_000


def test_arrival_status_equals_a_walk_in_order(spark):
    import random

    random.seed(3)
    events = [(random.choice("aaaabcde"), random.randint(0, 40), i, random.random() < 0.4) for i in range(500)]
    known = {"e"}
    done, want = set(known), {}
    for url, ts, number, good in sorted(events, key=lambda e: (e[1], e[2])):
        want[number] = "skipped" if url in done else "success" if good else "failed"
        if good:
            done.add(url)
    frame_ = spark.createDataFrame(events, "url string, ts long, event_id long, good boolean")
    loaded_ = spark.createDataFrame([(u,) for u in known], "url string")
    got = arrivals.arrival_status(frame_, loaded_, ["ts", "event_id"], F.col("good"), F.lit("failed"), F.lit("bad"))
    assert {r.event_id: r.status for r in got.collect()} == want
    new = arrivals.new_urls(frame_, loaded_, ["ts", "event_id"], F.col("good")).collect()
    assert {r.event_id for r in new} == {n for n, s in want.items() if s == "success"}


def test_quality_rules(spark):
    rows = spark.createDataFrame([(1, None, "u"), (2, "x" * 11, "u"), (3, "ok", None)], "id long, title string, url string")
    faults = quality.text_faults(rows, "id", ["title", "url"], {"title": 10}).collect()
    assert sorted((r.rule, r.id) for r in faults) == [("title longer than 10", 2), ("title missing", 1), ("url missing", 3)]
    bad = quality.outside_domain(spark.createDataFrame([(1, "high"), (2, "odd"), (3, None)], "id long, c string"), "id", "c", ("high",))
    assert [tuple(r) for r in bad.collect()] == [("c", 2, "odd")]


def test_configure_is_applied(spark):
    session.configure(spark)
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"

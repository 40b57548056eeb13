"""Counting while paging, pages from the positional index, totals from the cube, and discovery from an index."""

import pytest
from pyspark.sql import functions as F
from test_search import db, found  # noqa: F401

from larderlens.operators import search
from larderlens.operators.discover import RECIPE_SITEMAPS, DiscoveryRule, discover_from_index
from larderlens.operators.paging import PageIndex
from larderlens.operators.search import Filters


def test_count_and_page_come_from_one_job_without_a_write(spark, db, tmp_path):  # noqa: F811
    db["recipes"].write.parquet(str(tmp_path / "recipes"))
    recipes = spark.read.parquet(str(tmp_path / "recipes"))
    tracker, group = spark.sparkContext.statusTracker(), "one-pass"
    spark.sparkContext.setJobGroup(group, "page and total")
    rows, total = search.page_and_total(recipes.where("id <> 2"), 2, 2)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.id for r in rows] == [4, 5] and total == 5
    assert len(tracker.getJobIdsForGroup(group)) == 1


@pytest.mark.parametrize("where", ["id > 100", "false"])
def test_nothing_to_page(db, where):  # noqa: F811
    assert search.page_and_total(db["recipes"].where(where), 1, 10) == ([], 0)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = spark.range(5000).select((F.col("id") * F.col("id") * 7 - 1000).alias("id"), F.lit("t").alias("title"))
    return PageIndex(spark, str(tmp_path_factory.mktemp("pages"))).build(rows.repartition(6), rows_per_range=300)


def test_pages_at_any_depth(index):
    want = [n * n * 7 - 1000 for n in range(5000)]
    assert index.total() == 5000
    for number, size in ((1, 100), (2, 100), (17, 33), (50, 100), (5000, 1), (1, 1), (3, 77)):
        assert [r.id for r in index.page(number, size).collect()] == want[(number - 1) * size : number * size]
    assert index.page(51, 100).collect() == []
    with pytest.raises(ValueError):
        index.page(0)


def test_a_page_reads_the_ranges_it_lies_in(index):
    scanned = index.page(2500, 1)
    scanned.collect()
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "range" in plan.split("PartitionFilters")[1][:80]


def test_index_of_no_rows(spark, tmp_path):
    index = PageIndex(spark, str(tmp_path)).build(spark.range(0))
    assert index.total() == 0 and index.page(1).collect() == []


@pytest.mark.parametrize(
    "filters",
    [{}, {"exclude_allergens": "dairy, unknown"}, {"dietary_tags": "vegan,gluten_free"}, {"dietary_tags": "nothing"},
     {"cuisine": "it", "max_total_time": 20}, {"cuisine": "t\\_x"}, {"exclude_allergens": "egg", "dietary_tags": "vegetarian", "cuisine": "british", "max_total_time": 30},
     {"exclude_allergens": "dairy,egg,peanuts,tree_nuts", "dietary_tags": "vegan,contains_raw_egg"}],
)
def test_cube_totals_are_those_of_the_filters(db, filters):  # noqa: F811
    cube = search.filter_cube(db["recipes"], db["recipe_allergens"], db["recipe_dietary_tags"])
    total = search.cube_total(cube, db["allergens"], db["dietary_tags"], Filters(**filters)).first().total
    assert total == len(found(db, **filters))


def test_all_allergen_sets(db):  # noqa: F811
    cube = search.filter_cube(db["recipes"], db["recipe_allergens"], db["recipe_dietary_tags"])
    told = {r.excluded: r.total for r in search.allergen_set_totals(cube, db["allergens"]).collect()}
    assert len(told) == 16
    for excluded, total in told.items():
        assert total == len(found(db, exclude_allergens=excluded))


def locs(*urls):
    return "".join(f"<sitemap><loc> {u}\n</loc></sitemap>" for u in urls)


def test_an_index_decides_what_is_read_and_in_what_order(spark):
    index = [
        ("A", "<!-- <loc>s/0-recipe.xml</loc> -->" + locs("s/2-recipe.xml", "s/9-articles.xml", "s/lost-recipe.xml", "s/1-recipe.xml")),
        ("B", locs("s/&#49;-recipe.xml", "s/2-recipe.xml", "s/2-recipe.xml", "s/3-recipe.xml")),
        ("C", None),
        ("D", "no sitemap"),
    ]
    bodies = [(f"s/{n}-recipe.xml", "".join(f"<url><loc>h/recipes/{n}{c}</loc></url>" for c in "ab") + "<loc>h/recipes/same</loc>") for n in (0, 1, 2, 3)]
    bodies += [("s/lost-recipe.xml", None), ("s/9-articles.xml", "<loc>h/recipes/article</loc>"), bodies[1]]
    frames = spark.createDataFrame(index, "source string, xml string"), spark.createDataFrame(bodies, "sitemap_url string, xml string")

    def urls(rule, source):
        rows = [r for r in discover_from_index(*frames, rule).collect() if r.source == source]
        return [r.url for r in sorted(rows, key=lambda r: (r.sitemap_pos, r.pos))]

    assert urls(RECIPE_SITEMAPS, "A") == ["h/recipes/2a", "h/recipes/2b", "h/recipes/same"]  # the second is lost
    assert urls(RECIPE_SITEMAPS, "B") == ["h/recipes/1a", "h/recipes/1b", "h/recipes/same", "h/recipes/2a", "h/recipes/2b"]
    three = DiscoveryRule(max_sitemaps=3, sitemap_contains="-recipe.xml")
    assert len(urls(three, "B")) == 5  # one is listed twice, and fetched twice
    everything = DiscoveryRule(max_sitemaps=None)
    assert urls(everything, "A") == ["h/recipes/2a", "h/recipes/2b", "h/recipes/same", "h/recipes/article", "h/recipes/1a", "h/recipes/1b"]
    assert urls(everything, "C") == urls(everything, "D") == []

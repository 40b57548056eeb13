"""The query catalogue: every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlens import schemas, session
from larderlens.functions import labels
from larderlens.functions.skew import deal
from larderlens.functions.staging import new_path, settle
from larderlens.functions.text import normalise_ingredient
from larderlens.lexicon import CATEGORIES
from larderlens.operators import arrivals, discover, extract, matching, quality, rollup, search
from larderlens.operators.paging import PageIndex
from larderlens.plans import bindings as b
from larderlens.plans import catalogue
from larderlens.plans.batch_checks import check_noted, note_batch
from larderlens.sources import seeds
from larderlens.sources.tables import Catalogue

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_ARRIVAL_ORDER = ["ts", "event_id"]
_PAGE_FIELDS = ["title", "description", "cuisine", "prep_time", "cook_time", "total_time", "servings", "image_url"]


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(session.configure(spark), sf_dir)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


def _names(array: str) -> Column:
    return F.array_join(F.array_sort(F.col(f"{array}.name")), ",")


# Extraction


def _parsed(spark: SparkSession, sf_dir: str, fields: list[str]) -> DataFrame:
    """Fields of the rendered recipe pages; the ingredient lists are rendered only when they are read."""
    pages = b.pages(spark, sf_dir, with_lines="ingredients" in fields)
    return extract.project_recipes(extract.pick_recipes(pages), b.CATEGORY_SOURCES, fields)


def _small_ints(frame: DataFrame) -> DataFrame:
    names = ("prep_time", "cook_time", "total_time", "servings")
    return frame.withColumns({n: F.col(n).cast("int") for n in names if n in frame.columns})


@_query
def page_status(spark, sf_dir):
    """Outcome of every page, fetched or rendered."""
    pages = b.pages(spark, sf_dir).select("url", "source", "html").unionByName(b.fetched_pages(spark, sf_dir))
    return extract.parse_pages(pages, b.CATEGORY_SOURCES).select("url", F.col("outcome").alias("status"))


@_query
def extract_jsonld(spark, sf_dir):
    """Which node is picked from every page."""
    pages = b.pages(spark, sf_dir, with_lines=False).select("url", "html")
    picked = extract.pick_recipes(pages.unionByName(b.fetched_pages(spark, sf_dir).select("url", "html")))
    name = F.try_variant_get("recipe", "$.name", "string")
    return picked.select("url", F.col("recipe").isNotNull().alias("has_recipe"), name.alias("name"))


@_query
def extract_recipes(spark, sf_dir):
    parsed = _parsed(spark, sf_dir, [*_PAGE_FIELDS, "ingredients"]).where(F.col("title").isNotNull())
    return _small_ints(parsed.select("url", *_PAGE_FIELDS, F.size("ingredients").alias("n_lines")))


@_query
def extract_image(spark, sf_dir):
    return _parsed(spark, sf_dir, ["image_url"]).select("url", "image_url")


@_query
def extract_cuisine(spark, sf_dir):
    return _parsed(spark, sf_dir, ["cuisine"]).select("url", "source", "cuisine")


@_query
def duration_minutes(spark, sf_dir):
    times = ["prep_time", "cook_time", "total_time"]
    return _small_ints(_parsed(spark, sf_dir, times).select("url", *times))


@_query
def servings(spark, sf_dir):
    return _small_ints(_parsed(spark, sf_dir, ["servings"]).select("url", "servings"))


@_query
def ingredient_lines(spark, sf_dir):
    parsed = _parsed(spark, sf_dir, ["title", "ingredients"]).where(F.col("title").isNotNull())
    return extract.explode_lines(parsed)


@_query
def recipe_table(spark, sf_dir):
    """The recipes a load writes from pages of which some arrive twice, some have no URL and some are known."""
    parsed = extract.parse_pages(b.pages(spark, sf_dir, with_copies=True), b.CATEGORY_SOURCES)
    parsed = settle(parsed.withColumn("row_id", F.monotonically_increasing_id()), "parsed-pages")
    loaded = b.recipes(spark, sf_dir).where("id % 31 = 0").select("url")
    return _small_ints(catalogue.winning_rows(parsed, loaded, ["arrival", "row_id"]).select("url", "source", *_PAGE_FIELDS))


@_query
def load_discovered(spark, sf_dir):
    """The pages that discovery leads to."""
    here = F.lit("1").alias("source")
    found = discover.discover_urls(b.sitemaps(spark, sf_dir), discover.RECIPE_SITEMAPS).select(here, "url")
    return catalogue.choose_pages(b.recipes(spark, sf_dir).select("url", here, "title"), found).select("url", "title")


# Discovery


@_query
def discover_recipe_urls(spark, sf_dir):
    found = discover.discover_urls(b.sitemaps(spark, sf_dir), discover.RECIPE_SITEMAPS)
    return found.select("source", "url", "sitemap_pos")


@_query
def discover_post_urls(spark, sf_dir):
    found = discover.discover_urls(b.sitemaps(spark, sf_dir), discover.POST_SITEMAPS)
    return found.select("source", "url", "sitemap_pos")


@_query
def discover_index(spark, sf_dir):
    """URLs of the newest sitemaps that each index lists."""
    bodies = b.sitemaps(spark, sf_dir).select("sitemap_url", "xml")
    found = discover.discover_from_index(b.sitemap_indexes(spark, sf_dir), bodies, discover.RECIPE_SITEMAPS)
    return found.select("source", "url", "sitemap_pos")


# Sources


@_query
def source_upsert(spark, sf_dir):
    """Sources that line items name and the table lacks; the suppliers that are enabled are in it."""
    existing = seeds.enabled_sources(b.sources(spark, sf_dir))
    key = F.col("l_suppkey")
    name = F.concat(F.lit("Site "), key.cast("string"))
    wanted = b.table(spark, sf_dir, "lineitem").select(name.alias("name"), b.site_url(key).alias("base_url"))
    return seeds.add_sources(existing, wanted)


@_query
def enabled_sources(spark, sf_dir):
    return seeds.enabled_sources(b.sources(spark, sf_dir)).select("id", "name", "base_url")


# Matching and roll-up


def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = matching.flag_lines(b.lines(spark, sf_dir))
    return rollup.mask_recipes(
        b.recipes(spark, sf_dir).select(F.col("id").alias("recipe_id")), rollup.recipe_masks(flagged)
    )


def _allergen_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.allergen_links(_masks(spark, sf_dir), seeds.allergens(spark))


def _tag_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.dietary_tag_links(_masks(spark, sf_dir), seeds.dietary_tags(spark))


def _both_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Allergen and tag links from the same masks; these are settled, so that lines are flagged once for both."""
    masks = deal(settle(_masks(spark, sf_dir), "masks"), "recipe_id", tasks=b.line_tasks(spark, sf_dir))
    return (
        rollup.allergen_links(masks, seeds.allergens(spark)),
        rollup.dietary_tag_links(masks, seeds.dietary_tags(spark)),
    )


@_query
def normalise_ingredients(spark, sf_dir):
    return b.lines(spark, sf_dir).select("recipe_id", "pos", "raw", normalise_ingredient(F.col("raw")).alias("normalised"))


@_query
def ingredient_dim(spark, sf_dir):
    dimension = matching.ingredient_dimension(b.lines(spark, sf_dir))
    return dimension.select(F.col("raw").alias("raw_name"), F.col("normalised").alias("normalised_name"))


@_query
def recipe_ingredient_bridge(spark, sf_dir):
    return rollup.bridge(b.lines(spark, sf_dir)).select("recipe_id", F.col("raw").alias("raw_name"))


@_query
def ingredient_allergens(spark, sf_dir):
    dimension = matching.ingredient_dimension(b.lines(spark, sf_dir)).select("raw", "mask")
    links = rollup.allergen_links(dimension, seeds.allergens(spark), "raw")
    return links.select(
        F.col("raw").alias("raw_name"), F.col("name").alias("allergen"), F.lit("high").alias("confidence")
    )


@_query
def dictionary_scan_documents(spark, sf_dir):
    """Every category of every document, over the whole text."""
    docs = b.documents(spark, sf_dir).select("doc_id", F.lower("text").alias("folded"))
    masks = docs.select("doc_id", matching.scan_mask("folded").alias("mask"))
    return masks.select("doc_id", F.explode(matching.categories_of(F.col("mask"), CATEGORIES)).alias("category"))


@_query
def recipe_allergens(spark, sf_dir):
    return _allergen_links(spark, sf_dir).select("recipe_id", F.col("name").alias("allergen"))


@_query
def recipe_dietary_tags(spark, sf_dir):
    return _tag_links(spark, sf_dir).select("recipe_id", F.col("name").alias("tag"))


@_query
def raw_egg_recipes(spark, sf_dir):
    """Recipes with raw egg by the rule with exceptions and by the one without."""
    mask = F.col("mask")
    flags = _masks(spark, sf_dir).select(
        "recipe_id",
        matching.has(mask, "raw_egg").alias("by_tag_rule"),
        matching.has(mask, "raw_egg_any").alias("by_second_check"),
    )
    return flags.where("by_tag_rule or by_second_check")


# Incremental runs


@_query
def incremental_new_urls(spark, sf_dir):
    """The arrival to load of every URL not loaded before."""
    rows = b.arrivals(spark, sf_dir)
    good = F.col("event_type") != "error"
    return arrivals.new_urls(rows, b.loaded_urls(spark, sf_dir), _ARRIVAL_ORDER, good).select("url", "event_id")


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = b.arrivals(spark, sf_dir).withColumnRenamed("source_id", "source").withColumns(
        {
            "outcome": F.when(F.col("event_type") == "error", "failed").otherwise("success"),
            "error_message": F.concat(F.lit("error on "), F.col("url")),
        }
    )
    return catalogue.log_rows(seen, b.loaded_urls(spark, sf_dir), _ARRIVAL_ORDER).withColumnRenamed("source", "source_id")


@_query
def run_log(spark, sf_dir):
    return _run_log(spark, sf_dir).select("event_id", "source_id", "url", "status", "error_message")


@_query
def run_summary(spark, sf_dir):
    return arrivals.run_summary(_run_log(spark, sf_dir))


# Search

REQUESTS = (
    (search.Filters(exclude_allergens="dairy,egg", dietary_tags="vegetarian", max_total_time=60), 2, 20),
    (search.Filters(cuisine="ian"), 1, 50),
    (search.Filters(dietary_tags="vegan,contains_raw_egg"), 1, 20),
)


@_query
def recipes_page(spark, sf_dir):
    """Page 3 of all recipes, 20 a page."""
    return search.page(b.recipes(spark, sf_dir), 3, 20).select(*search.SUMMARY_FIELDS)


@_query
def recipes_page_deep(spark, sf_dir):
    """Page 60 of all recipes, 20 a page."""
    return search.page(b.recipes(spark, sf_dir), 60, 20).select("id", "title")


@_query
def recipes_page_after(spark, sf_dir):
    """The 20 recipes after a known id."""
    return search.page_after(b.recipes(spark, sf_dir), 1000, 20).select("id", "title")


@_query
def recipes_pages_indexed(spark, sf_dir):
    """Near, deep and last pages, each from the id range it lies in."""
    index = PageIndex(spark, new_path(spark, "page-index")).build(b.recipes(spark, sf_dir).select("id", "title"), 2_000)
    numbers = sorted({1, 60, 500, 5000, max(1, -(-index.total() // 20))})
    return quality.union_all([index.page(n, 20).select(F.lit(n).cast("long").alias("page"), "id", "title") for n in numbers])


@_query
def filter_cuisine(spark, sf_dir):
    return search.by_cuisine(b.recipes(spark, sf_dir), "iAn").select("id", "cuisine")


@_query
def filter_max_time(spark, sf_dir):
    return search.by_max_time(b.recipes(spark, sf_dir), 30).select("id", "total_time")


@_query
def exclude_allergens(spark, sf_dir):
    links = _allergen_links(spark, sf_dir)
    kept = search.without_allergens(
        b.recipes(spark, sf_dir), links, seeds.allergens(spark), "dairy, Egg ,unknown"
    )
    return kept.select("id", "title")


@_query
def require_tags(spark, sf_dir):
    links = _tag_links(spark, sf_dir)
    kept = search.with_tags(
        b.recipes(spark, sf_dir), links, seeds.dietary_tags(spark), "vegetarian, Gluten_Free,unknown,vegetarian"
    )
    return kept.select("id", "title")


def _safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filter_recipes(
        b.recipes(spark, sf_dir),
        *_both_links(spark, sf_dir),
        seeds.allergens(spark),
        seeds.dietary_tags(spark),
        search.Filters(exclude_allergens="dairy,egg", dietary_tags="vegetarian", max_total_time=60),
    )


@_query
def safe_recipes(spark, sf_dir):
    """Vegetarian, free of dairy and egg, ready in 60 minutes."""
    return _safe(spark, sf_dir).select("id", "title", "cuisine", "total_time")


@_query
def filtered_count(spark, sf_dir):
    return search.total_count(_safe(spark, sf_dir))


@_query
def allergen_set_totals(spark, sf_dir):
    """How many recipes every set of excluded allergens leaves."""
    cube = search.filter_cube(b.recipes(spark, sf_dir), *_both_links(spark, sf_dir))
    return search.allergen_set_totals(cube, seeds.allergens(spark))


@_query
def cube_totals(spark, sf_dir):
    """The totals of the saved requests, from the cube."""
    cube = settle(search.filter_cube(b.recipes(spark, sf_dir), *_both_links(spark, sf_dir)), "cube")
    totals = [search.cube_total(cube, seeds.allergens(spark), seeds.dietary_tags(spark), filters) for filters, *_ in REQUESTS]
    return quality.union_all([total.select(F.lit(n).alias("request"), "total") for n, total in enumerate(totals)])


@_query
def recipe_summary(spark, sf_dir):
    """All recipes with their allergens and tags."""
    nested = search.summaries(
        b.recipes(spark, sf_dir),
        *_both_links(spark, sf_dir),
        seeds.allergens(spark),
        seeds.dietary_tags(spark),
    )
    return nested.select(
        *search.SUMMARY_FIELDS, _names("allergens").alias("allergens"), _names("dietary_tags").alias("dietary_tags")
    )


@_query
def recipe_list(spark, sf_dir):
    """The answers to three saved requests."""
    recipes = b.recipes(spark, sf_dir)
    links = [settle(frame, "links") for frame in _both_links(spark, sf_dir)]
    shown = lambda r: F.concat_ws(
        "|", r.id, r.title, F.array_join(F.array_sort(r.allergens["name"]), ","), F.array_join(F.array_sort(r.dietary_tags["name"]), ",")
    )
    answers = []
    for n, (filters, number, size) in enumerate(REQUESTS):
        answer = search.list_recipes(recipes, *links, seeds.allergens(spark), seeds.dietary_tags(spark), filters, number, size)
        answers.append(answer.select(F.lit(n).alias("request"), "total", "page", "size", F.array_join(F.transform("results", shown), ";").alias("results")))
    return quality.union_all(answers)


@_query
def recipe_detail(spark, sf_dir):
    """The full recipes of the wanted ids."""
    rows = b.lines(spark, sf_dir)
    key = F.xxhash64("raw")
    dimension = matching.ingredient_dimension(rows).select(
        key.alias("id"), F.col("raw").alias("raw_name"), F.col("normalised").alias("normalised_name")
    )
    bridge = rollup.bridge(rows.select("recipe_id", key.alias("ingredient_id")), "recipe_id", "ingredient_id")
    nothing = F.lit(None).cast("string")
    nested = search.details(
        b.recipes(spark, sf_dir),
        b.wanted_ids(spark, sf_dir),
        *_both_links(spark, sf_dir),
        seeds.allergens(spark),
        seeds.dietary_tags(spark),
        bridge.withColumns({c: nothing for c in ("quantity", "unit", "preparation")}),
        dimension,
    )
    item = lambda i: F.concat_ws("=", i.ingredient.raw_name, i.ingredient.normalised_name)
    return nested.select(
        "id",
        "title",
        "description",
        _names("allergens").alias("allergens"),
        _names("dietary_tags").alias("dietary_tags"),
        F.array_join(F.array_sort(F.transform("ingredients", item)), ";").alias("ingredients"),
    )


@_query
def recipe_allergens_of(spark, sf_dir):
    return search.dimension_of(
        b.wanted_ids(spark, sf_dir), _allergen_links(spark, sf_dir), seeds.allergens(spark), "allergen_id"
    )


@_query
def recipe_tags_of(spark, sf_dir):
    return search.dimension_of(
        b.wanted_ids(spark, sf_dir), _tag_links(spark, sf_dir), seeds.dietary_tags(spark), "dietary_tag_id"
    )


@_query
def cuisines(spark, sf_dir):
    return search.cuisines(b.recipes(spark, sf_dir))


def _listed_with_use(dimension: DataFrame, links: DataFrame, link_id: str) -> DataFrame:
    """A dimension in display order, with the number of recipes behind each row."""
    uses = links.groupBy(F.col(link_id).alias("id")).agg(F.count(F.lit(1)).alias("recipes"))
    counted = dimension.join(uses, "id", "left").withColumn("recipes", F.coalesce("recipes", F.lit(0)))
    return search.listed(counted.select("id", "name", "display_name", "description", "recipes"))


@_query
def allergen_list(spark, sf_dir):
    return _listed_with_use(seeds.allergens(spark), _allergen_links(spark, sf_dir), "allergen_id")


@_query
def dietary_tag_list(spark, sf_dir):
    return _listed_with_use(seeds.dietary_tags(spark), _tag_links(spark, sf_dir), "dietary_tag_id")


@_query
def page_info(spark, sf_dir):
    """Page range of page 2, 20 a page, for the recipes of every source and cuisine."""
    totals = b.recipes(spark, sf_dir).groupBy("source_id", "cuisine").agg(F.count(F.lit(1)).alias("total"))
    return search.page_ranges(totals, 2, 20)


@_query
def time_label(spark, sf_dir):
    label = labels.time_label(F.col("total_time"), F.col("prep_time"), F.col("cook_time"))
    return b.recipes(spark, sf_dir).select("id", label.alias("time_label"))


@_query
def time_buckets(spark, sf_dir):
    return search.time_buckets(b.recipes(spark, sf_dir))


# Quality


@_query
def dq_duplicates(spark, sf_dir):
    """Key rules over tables in which keys were made to repeat."""
    k = F.col("id")
    urls = b.recipes(spark, sf_dir).select(b.recipe_url(F.when(k % 50 == 1, k - 1).otherwise(k)).alias("url"))
    rows = b.lines(spark, sf_dir)
    origins = b.sources(spark, sf_dir).select(b.site_url(F.when(k % 10 == 1, k - 1).otherwise(k)).alias("base_url"))
    return quality.union_all(
        [
            quality.duplicate_keys(deal(urls, "url"), "recipes.url", ["url"]),
            quality.duplicate_keys(rows, "recipe_ingredients.pair", ["recipe_id", "raw"]),
            quality.duplicate_keys(origins, "sources.base_url", ["base_url"]),
            quality.duplicate_keys(rows.select("raw"), "ingredients.raw_name", ["raw"]),
        ]
    )


@_query
def dq_orphans(spark, sf_dir):
    """Link rules after some parents were dropped."""
    recipes, rows = deal(b.recipes(spark, sf_dir), "id"), b.lines(spark, sf_dir)
    kept = recipes.join(b.recipe_ids(spark, sf_dir, "1-URGENT"), "id", "left_anti")
    origins = b.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_id"))
    names = rows.select("raw").distinct().where(~F.col("raw").startswith("a"))
    return quality.union_all(
        [
            quality.orphans(rows, "recipe_id", kept, "id", "recipe_ingredients.recipe_id"),
            quality.orphans(
                origins, "source_id", seeds.enabled_sources(b.sources(spark, sf_dir)), "id", "recipes.source_id"
            ),
            quality.orphans(rows, "raw", names, "raw", "recipe_ingredients.ingredient_id"),
        ]
    )


@_query
def dq_lengths(spark, sf_dir):
    k = F.col("id")
    long_title = F.when(k % 40 == 0, F.repeat(F.lit("x"), 300)).otherwise(F.when(k % 43 != 0, F.col("title")))
    url = F.when(k % 41 != 0, F.when(k % 47 == 0, F.concat("url", F.repeat(F.lit("y"), 500))).otherwise(F.col("url")))
    broken = b.recipes(spark, sf_dir).select("id", long_title.alias("title"), url.alias("url"), "cuisine", "image_url")
    amounts = b.lines(spark, sf_dir).select(
        F.col("recipe_id").alias("id"),
        F.when(F.col("recipe_id") % 101 == 0, F.repeat(F.lit("q"), 60)).alias("quantity"),
        F.lit("g").alias("unit"),
        F.when(F.col("recipe_id") % 103 == 0, F.repeat(F.lit("p"), 120)).alias("preparation"),
    )
    return quality.union_all(
        [
            quality.text_faults(broken, "id", ["title", "url"], schemas.LENGTHS["recipes"]),
            quality.text_faults(amounts, "id", [], schemas.LENGTHS["recipe_ingredients"]),
        ]
    )


@_query
def dq_domains(spark, sf_dir):
    status = (
        F.when(F.col("event_type") == "click", "success")
        .when(F.col("event_type") == "view", "skipped")
        .when(F.col("event_type") == "error", "failed")
        .otherwise(F.col("event_type"))
    )
    log = b.arrivals(spark, sf_dir).select("event_id", status.alias("status"))
    return quality.outside_domain(log, "event_id", "status", schemas.DOMAINS["run_log", "status"])


def _rows_left(tables: dict[str, DataFrame]) -> DataFrame:
    counts = []
    for name, rows in tables.items():
        key = "id" if name == "recipes" else "recipe_id"
        per_recipe = rows.groupBy(F.col(key).alias("recipe_id")).agg(F.count(F.lit(1)).alias("rows_left"))
        counts.append(per_recipe.select(F.lit(name).alias("table_name"), "recipe_id", "rows_left"))
    return quality.union_all(counts)


def _recipe_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    allergen_links, tag_links = _both_links(spark, sf_dir)
    return {
        "recipes": deal(b.recipes(spark, sf_dir), "id"),
        "recipe_ingredients": rollup.bridge(b.lines(spark, sf_dir)),
        "recipe_allergens": allergen_links,
        "recipe_dietary_tags": tag_links,
    }


@_query
def cascade_delete(spark, sf_dir):
    """Rows per recipe left in each table after the recipes of one priority were deleted."""
    return _rows_left(quality.delete_recipes(_recipe_tables(spark, sf_dir), b.recipe_ids(spark, sf_dir, "5-LOW")))


def _stored(spark: SparkSession, frames: dict[str, DataFrame], key: dict[str, str], batches: int) -> Catalogue:
    """A catalogue on storage with the rows of `frames`, dealt to batches by their key."""
    tables = Catalogue(spark, new_path(spark, "catalogue"))
    for name, rows in frames.items():
        missing = {f.name: F.lit(None).cast(f.dataType) for f in schemas.TABLES[name] if f.name not in rows.columns}
        dealt = rows.withColumns(missing | {"run": F.lit("loads"), "batch": F.pmod(F.col(key[name]), F.lit(batches))})
        tables.import_rows(name, dealt)
    return tables


@_query
def stored_cascade_delete(spark, sf_dir):
    """The same on stored tables that were loaded in batches, compacted before and after the deletion."""
    frames = _recipe_tables(spark, sf_dir)
    frames["recipe_ingredients"] = frames["recipe_ingredients"].withColumn("ingredient_id", F.xxhash64("raw")).drop("raw")
    frames["recipe_allergens"], frames["recipe_dietary_tags"] = (f.drop("name") for f in (frames["recipe_allergens"], frames["recipe_dietary_tags"]))
    tables = _stored(spark, frames, dict.fromkeys(frames, "recipe_id") | {"recipes": "id"}, 4)
    tables.compact(segment_bytes=1)
    tables.delete_recipes(b.recipe_ids(spark, sf_dir, "5-LOW"))
    tables.compact()
    return _rows_left({name: deal(tables.read(name), "id" if name == "recipes" else "recipe_id") for name in frames})


@_query
def delete_ingredients(spark, sf_dir):
    """Which ingredients stay after some were deleted, which of these could not go, and whose allergen rows are left."""
    rows = matching.ingredient_dimension(b.lines(spark, sf_dir)).withColumn("id", F.xxhash64("raw"))
    links = rollup.allergen_links(rows.withColumnRenamed("id", "ingredient_id"), seeds.allergens(spark), "ingredient_id")
    used = b.lines(spark, sf_dir).where(~F.col("raw").startswith("1"))
    tables = {
        "ingredients": rows.select("id", "raw"),
        "ingredient_allergens": links.select("ingredient_id", "allergen_id"),
        "recipe_ingredients": rollup.bridge(used.select("recipe_id", F.xxhash64("raw").alias("ingredient_id")), "recipe_id", "ingredient_id"),
    }
    deleted = rows.where(F.col("raw").startswith("1") | F.col("raw").startswith("2")).select("id")
    left = quality.delete_ingredients(tables, deleted)
    named = rows.select("id", F.col("raw").alias("raw_name"))
    kinds = {
        "ingredient": left["ingredients"].select("id"),
        "refused": quality.used_ingredients(tables, deleted),
        "allergen row": left["ingredient_allergens"].select(F.col("ingredient_id").alias("id")),
    }
    return quality.union_all([f.join(named, "id").select(F.lit(kind).alias("kind"), "raw_name") for kind, f in kinds.items()])


@_query
def stored_ingredient_delete(spark, sf_dir):
    """The same on stored tables; `refused` is what the deletion returns."""
    rows = matching.ingredient_dimension(b.lines(spark, sf_dir)).withColumn("id", F.xxhash64("raw"))
    links = rollup.allergen_links(rows.withColumnRenamed("id", "ingredient_id"), seeds.allergens(spark), "ingredient_id")
    used = b.lines(spark, sf_dir).where(~F.col("raw").startswith("1"))
    frames = {
        "ingredients": rows.select("id", F.col("raw").alias("raw_name"), F.col("normalised").alias("normalised_name")),
        "ingredient_allergens": links.select("ingredient_id", "allergen_id"),
        "recipe_ingredients": rollup.bridge(used.select("recipe_id", F.xxhash64("raw").alias("ingredient_id")), "recipe_id", "ingredient_id"),
    }
    tables = _stored(spark, frames, {"ingredients": "id", "ingredient_allergens": "ingredient_id", "recipe_ingredients": "recipe_id"}, 3)
    refused = tables.delete_ingredients(rows.where(F.col("raw").startswith("1") | F.col("raw").startswith("2")).select("id"))
    named = rows.select("id", F.col("raw").alias("raw_name"))
    kinds = {
        "ingredient": tables.read("ingredients").select("id"),
        "refused": refused,
        "allergen row": tables.read("ingredient_allergens").select(F.col("ingredient_id").alias("id")),
    }
    return quality.union_all([f.join(named, "id").select(F.lit(kind).alias("kind"), "raw_name") for kind, f in kinds.items()])


@_query
def noted_checks(spark, sf_dir):
    """What the notes of three stored batches report: repeated URLs across batches, and links to recipes and sources that are not there."""
    k = F.col("id")
    kept = b.recipes(spark, sf_dir).join(b.recipe_ids(spark, sf_dir, "1-URGENT"), "id", "left_anti")
    url = b.recipe_url(F.when(k % 50 == 1, k - 1).otherwise(k))
    frames = {
        "recipes": kept.withColumns({"url": url, "scraped_at": F.current_timestamp()}),
        "recipe_allergens": _allergen_links(spark, sf_dir).drop("name"),
    }
    tables = _stored(spark, frames, {"recipes": "id", "recipe_allergens": "recipe_id"}, 3)
    for batch in range(3):
        note_batch(tables, batch)
    return check_noted(tables)

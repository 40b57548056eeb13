"""The read side: filters, pages, nested results, facets.

Functions take the catalogue tables and return lazily planned DataFrames. `recipes` has the key column
`id`, the link tables have `recipe_id`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from larderlens.functions.labels import page_count, page_from, page_to

PRESET_LIMITS = (15, 30, 60, 90)
MAX_PAGE_SIZE = 100

SUMMARY_FIELDS = ("id", "title", "url", "cuisine", "prep_time", "cook_time", "total_time", "servings", "image_url")


@dataclass(frozen=True)
class Filters:
    """Name lists are comma separated, as typed by a user."""

    cuisine: str | None = None
    exclude_allergens: str | None = None
    dietary_tags: str | None = None
    max_total_time: int | None = None


def split_names(text: str | None) -> list[str]:
    """Distinct names of a comma separated list, in order."""
    return list(dict.fromkeys(part.strip().lower() for part in text.split(","))) if text else []


def by_cuisine(recipes: DataFrame, text: str | None) -> DataFrame:
    """Case-insensitive substring; `%` and `_` in the text are wildcards, a backslash takes the next character as it is."""
    if not text:
        return recipes
    pattern = re.sub(r"\\([^%_\\])", r"\1", f"%{text}%")  # only these three may follow a backslash here
    return recipes.where(F.col("cuisine").ilike(pattern))


def by_max_time(recipes: DataFrame, limit: int | None) -> DataFrame:
    return recipes.where(F.col("total_time") <= limit) if limit else recipes


def without_allergens(recipes: DataFrame, recipe_allergens: DataFrame, allergens: DataFrame, names: str | None) -> DataFrame:
    """Drop recipes with any listed allergen. Unknown names have no id and drop nothing."""
    wanted = split_names(names)
    if not wanted:
        return recipes
    ids = allergens.where(F.col("name").isin(wanted)).select(F.col("id").alias("allergen_id"))
    hits = recipe_allergens.join(ids, "allergen_id", "left_semi").select(F.col("recipe_id").alias("id"))
    return recipes.join(hits, "id", "left_anti")


def with_tags(recipes: DataFrame, recipe_dietary_tags: DataFrame, dietary_tags: DataFrame, names: str | None) -> DataFrame:
    """Keep recipes with every listed tag that exists; when there is none, nothing is filtered.

    Links are unique pairs, so one count per recipe answers all tags, where a semi join per tag would shuffle the link
    table once for each.
    """
    wanted = split_names(names)
    if not wanted:
        return recipes
    known = dietary_tags.where(F.col("name").isin(wanted)).select(F.col("id").alias("dietary_tag_id"))
    links = recipe_dietary_tags.join(known, "dietary_tag_id").groupBy(F.col("recipe_id").alias("id"))
    held = links.agg(F.count(F.lit(1)).alias("held"))
    enough = F.coalesce("held", F.lit(0)) >= known.agg(F.count(F.lit(1))).scalar()
    return recipes.join(held, "id", "left").where(enough).drop("held")


def filter_recipes(
    recipes: DataFrame,
    recipe_allergens: DataFrame,
    recipe_dietary_tags: DataFrame,
    allergens: DataFrame,
    dietary_tags: DataFrame,
    filters: Filters,
) -> DataFrame:
    """All filters of a request. Column filters come first and reach the scan."""
    kept = by_max_time(by_cuisine(recipes, filters.cuisine), filters.max_total_time)
    kept = without_allergens(kept, recipe_allergens, allergens, filters.exclude_allergens)
    return with_tags(kept, recipe_dietary_tags, dietary_tags, filters.dietary_tags)


def total_count(recipes: DataFrame) -> DataFrame:
    return recipes.agg(F.count(F.lit(1)).alias("total"))


def _check_size(size: int) -> None:
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError("size is between 1 and 100")


def page(recipes: DataFrame, number: int = 1, size: int = 20) -> DataFrame:
    """One page in id order. Past the end it is empty. Its cost grows with the page number; see `page_after`."""
    if number < 1:
        raise ValueError("pages start at 1")
    _check_size(size)
    return recipes.orderBy("id").offset((number - 1) * size).limit(size)


def page_after(recipes: DataFrame, last_id: int | None, size: int = 20) -> DataFrame:
    """The page after the one that ended with `last_id` (None: the first). It costs the same however deep it lies."""
    _check_size(size)
    left = recipes if last_id is None else recipes.where(F.col("id") > last_id)
    return left.orderBy("id").limit(size)


def _dimension_rows(links: DataFrame, dimension: DataFrame, link_id: str) -> DataFrame:
    """(recipe_id, item): link rows with their dimension row as a struct."""
    item = F.struct("id", "name", "display_name", "description").alias("item")
    rows = dimension.select(F.col("id").alias(link_id), item)
    return links.select("recipe_id", link_id).join(rows, link_id).select("recipe_id", "item")


def _nested(rows: dict[str, DataFrame], keys: DataFrame | None) -> DataFrame:
    """(id, one sorted array per name) from rows (recipe_id, item), all arrays in one aggregation. With `keys`
    (recipe_id), only their rows. The items of a recipe came from one page, which bounds their number."""
    kinds = {name: frame.schema["item"].dataType for name, frame in rows.items()}
    tagged = None
    for name, frame in rows.items():
        own = [(F.col("item") if other == name else F.lit(None).cast(kind)).alias(other) for other, kind in kinds.items()]
        part = frame.select("recipe_id", *own)
        tagged = part if tagged is None else tagged.unionByName(part)
    if keys is not None:
        tagged = tagged.join(keys, "recipe_id", "left_semi")
    arrays = [F.sort_array(F.collect_list(name)).alias(name) for name in rows]
    return tagged.groupBy(F.col("recipe_id").alias("id")).agg(*arrays)


def _with_arrays(recipes: DataFrame, rows: dict[str, DataFrame], keys: DataFrame | None) -> DataFrame:
    joined = recipes.join(_nested(rows, keys), "id", "left")
    empty = {name: F.coalesce(name, F.array().cast(joined.schema[name].dataType)) for name in rows}
    fields = [f for f in (*SUMMARY_FIELDS, "description") if f in recipes.columns]
    return joined.withColumns(empty).select(*fields, *rows)


def _names_of(recipe_allergens: DataFrame, recipe_dietary_tags: DataFrame, allergens: DataFrame, dietary_tags: DataFrame) -> dict[str, DataFrame]:
    return {
        "allergens": _dimension_rows(recipe_allergens, allergens, "allergen_id"),
        "dietary_tags": _dimension_rows(recipe_dietary_tags, dietary_tags, "dietary_tag_id"),
    }


def summaries(
    recipes: DataFrame,
    recipe_allergens: DataFrame,
    recipe_dietary_tags: DataFrame,
    allergens: DataFrame,
    dietary_tags: DataFrame,
    on_page: bool = False,
) -> DataFrame:
    """Recipes with their allergens and tags as arrays of structs.

    Set `on_page` when `recipes` is a stored page: links are then joined with its ids before they are aggregated.
    """
    keys = recipes.select(F.col("id").alias("recipe_id")) if on_page else None
    return _with_arrays(recipes, _names_of(recipe_allergens, recipe_dietary_tags, allergens, dietary_tags), keys)


def list_recipes(
    recipes: DataFrame,
    recipe_allergens: DataFrame,
    recipe_dietary_tags: DataFrame,
    allergens: DataFrame,
    dietary_tags: DataFrame,
    filters: Filters,
    number: int = 1,
    size: int = 20,
) -> DataFrame:
    """One row (total, page, size, results): how many recipes pass the filters, and the summaries of one page of them.

    The filters are evaluated once, by one job that keeps the top rows of each task and counts all rows on their way; nothing is
    written. The page, at most MAX_PAGE_SIZE rows, comes to the driver, and its ids are pushed down to the scans of the links.
    """
    _check_size(size)
    links = (recipe_allergens, recipe_dietary_tags, allergens, dietary_tags)
    kept = filter_recipes(recipes, *links, filters).select(*SUMMARY_FIELDS)
    rows, total = page_and_total(kept, number, size)
    shown, ids = recipes.sparkSession.createDataFrame(rows, kept.schema), [r.id for r in rows]
    of_page = [rows.where(F.col("recipe_id").isin(ids)) for rows in (recipe_allergens, recipe_dietary_tags)]
    results = summaries(shown, *of_page, allergens, dietary_tags).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("results"))
    return results.select(F.lit(total).cast("long").alias("total"), F.lit(number).alias("page"), F.lit(size).alias("size"), "results")


def page_and_total(recipes: DataFrame, number: int = 1, size: int = 20) -> tuple[list[Row], int]:
    """The rows of one page and the number of all `recipes`, from one pass over them."""
    counted = Observation()
    rows = page(recipes.observe(counted, F.count(F.lit(1)).alias("total")), number, size).collect()
    return rows, counted.get.get("total", 0)


def details(
    recipes: DataFrame,
    ids: DataFrame,
    recipe_allergens: DataFrame,
    recipe_dietary_tags: DataFrame,
    allergens: DataFrame,
    dietary_tags: DataFrame,
    recipe_ingredients: DataFrame,
    ingredients: DataFrame,
) -> DataFrame:
    """Full recipes of the given ids, with ingredients. A missing id gives no row.

    The ids prune the link tables once, before they are aggregated together. A common ingredient is part of very many
    recipes; its rows meet its name in a plain join, which skew-join splitting keeps even.
    """
    wanted = ids.select("id").distinct()
    keys = wanted.withColumnRenamed("id", "recipe_id")
    names = ingredients.select(
        F.col("id").alias("ingredient_id"), F.struct("id", "raw_name", "normalised_name").alias("ingredient")
    )
    pruned = recipe_ingredients.join(keys, "recipe_id", "left_semi").join(names, "ingredient_id")
    item = F.struct("ingredient", "quantity", "unit", "preparation").alias("item")
    rows = _names_of(recipe_allergens, recipe_dietary_tags, allergens, dietary_tags)
    found = recipes.join(wanted, "id", "left_semi")
    return _with_arrays(found, rows | {"ingredients": pruned.select("recipe_id", item)}, keys)


def dimension_of(ids: DataFrame, links: DataFrame, dimension: DataFrame, link_id: str) -> DataFrame:
    """(recipe_id, id, name, display_name, description): the allergens or tags of the given recipes."""
    keys = ids.select(F.col("id").alias("recipe_id")).distinct()
    rows = _dimension_rows(links.join(keys, "recipe_id", "left_semi"), dimension, link_id)
    return rows.select("recipe_id", "item.*")


def cuisines(recipes: DataFrame) -> DataFrame:
    return recipes.where(F.col("cuisine").isNotNull()).select("cuisine").distinct().orderBy("cuisine")


def listed(dimension: DataFrame) -> DataFrame:
    """A dimension in display order."""
    return dimension.orderBy("display_name")


def page_ranges(totals: DataFrame, number: int, size: int) -> DataFrame:
    """Add the page count and the row range shown to rows with a `total`."""
    total, page_no, page_size = F.col("total"), F.lit(number), F.lit(size)
    return totals.withColumns(
        {
            "pages": page_count(total, page_size),
            "row_from": page_from(total, page_no, page_size),
            "row_to": page_to(total, page_no, page_size),
        }
    )


def time_buckets(recipes: DataFrame, limits: tuple[int, ...] = PRESET_LIMITS) -> DataFrame:
    """(max_total_time, total): recipes within each preset limit, all limits from one pass."""
    counts = recipes.agg(*[F.count_if(F.col("total_time") <= n).alias(str(n)) for n in limits])
    pairs = F.array(*[F.struct(F.lit(n).alias("max_total_time"), F.col(str(n)).alias("total")) for n in limits])
    return counts.select(F.inline(pairs))


def filter_cube(recipes: DataFrame, recipe_allergens: DataFrame, recipe_dietary_tags: DataFrame) -> DataFrame:
    """(allergen_bits, tag_bits, cuisine, total_time, recipes): how many recipes there are of each combination.

    The cube answers the total of every combination of filters without recipes or links. It has no more rows than there are
    combinations in use: bits of a few allergens and tags, cuisines, and minutes. Ids of both dimensions are below 63.
    """
    bit = lambda column: F.expr(f"shiftleft(1L, {column})")
    marks = recipe_allergens.select(F.col("recipe_id").alias("id"), bit("allergen_id").alias("allergen_bits"), F.lit(0).cast("long").alias("tag_bits"))
    tags = recipe_dietary_tags.select(F.col("recipe_id").alias("id"), F.lit(0).cast("long").alias("allergen_bits"), bit("dietary_tag_id").alias("tag_bits"))
    held = marks.unionByName(tags).groupBy("id").agg(F.bit_or("allergen_bits").alias("allergen_bits"), F.bit_or("tag_bits").alias("tag_bits"))
    joined = recipes.select("id", "cuisine", "total_time").join(held, "id", "left")
    bits = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("allergen_bits", "tag_bits")]
    return joined.groupBy(*bits, "cuisine", "total_time").agg(F.count(F.lit(1)).alias("recipes"))


def cube_total(cube: DataFrame, allergens: DataFrame, dietary_tags: DataFrame, filters: Filters) -> DataFrame:
    """(total): how many recipes pass the filters, as `filter_recipes` and `total_count` tell, from the cube alone."""
    kept = by_max_time(by_cuisine(cube, filters.cuisine), filters.max_total_time)
    barred, wanted = _bits(allergens, filters.exclude_allergens), _bits(dietary_tags, filters.dietary_tags)
    kept = kept.where((F.col("allergen_bits").bitwiseAND(F.lit(barred)) == 0) & (F.col("tag_bits").bitwiseAND(F.lit(wanted)) == wanted))
    return kept.agg(F.coalesce(F.sum("recipes"), F.lit(0)).alias("total"))


def allergen_set_totals(cube: DataFrame, allergens: DataFrame) -> DataFrame:
    """(excluded, total): the recipes left by every set of allergens to exclude, names sorted and comma separated.

    All sets are answered by one pass over the cube; there are two to the power of the number of allergens, which is small.
    """
    named = sorted((r.name, r.id) for r in allergens.select("name", "id").collect())
    if len(named) > 10:
        raise ValueError("sets of at most ten allergens")
    sets = [[x for k, x in enumerate(named) if n >> k & 1] for n in range(1 << len(named))]
    told = [(",".join(name for name, _ in s), sum(1 << i for _, i in s)) for s in sets]
    free = lambda mask: F.col("allergen_bits").bitwiseAND(F.lit(mask)) == 0
    sums = [F.coalesce(F.sum(F.when(free(mask), F.col("recipes"))), F.lit(0)).alias(str(n)) for n, (_, mask) in enumerate(told)]
    pairs = F.array(*[F.struct(F.lit(name).alias("excluded"), F.col(str(n)).alias("total")) for n, (name, _) in enumerate(told)])
    return cube.agg(*sums).select(F.inline(pairs))


def _bits(dimension: DataFrame, names: str | None) -> int:
    """The bits of the listed names that exist."""
    wanted = split_names(names)
    rows = dimension.where(F.col("name").isin(wanted)).select("id").collect() if wanted else []
    return sum(1 << r.id for r in rows)

"""From flagged lines to recipes: bridges, allergens and dietary tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlens.lexicon import ALLERGENS
from larderlens.operators.matching import categories_of, has


def bridge(lines: DataFrame, recipe: str = "recipe_id", ingredient: str = "raw") -> DataFrame:
    """Distinct (recipe, ingredient) pairs."""
    return lines.select(recipe, ingredient).distinct()


def recipe_masks(flagged: DataFrame, recipe: str = "recipe_id") -> DataFrame:
    """All flags of a recipe in one integer. Lines of a recipe lie together, so the map side folds most of them."""
    return flagged.groupBy(recipe).agg(F.bit_or("mask").alias("mask"))


def mask_recipes(recipes: DataFrame, masks: DataFrame, recipe: str = "recipe_id") -> DataFrame:
    """(recipe, mask) for every recipe; one without lines has no flag set."""
    return recipes.select(recipe).join(masks, recipe, "left").select(recipe, F.coalesce("mask", F.lit(0)).alias("mask"))


DIETARY_TAGS = ("vegetarian", "vegan", "gluten_free", "contains_raw_egg")


def dietary_tags_of(mask: Column) -> Column:
    """Tags of a recipe: the first three hold when no line objects, raw egg when any line says so."""
    meat, animal = has(mask, "meat"), has(mask, "non_vegan")
    holds = (~meat, ~meat & ~animal, ~has(mask, "gluten"), has(mask, "raw_egg") | has(mask, "raw_egg_any"))
    tags = [F.when(rule, F.lit(name)) for name, rule in zip(DIETARY_TAGS, holds, strict=True)]
    return F.array_compact(F.array(*tags))


def _link(rows: DataFrame, names: Column, possible: list[str], key: str, dimension: DataFrame, id_name: str) -> DataFrame:
    """Explode names and keep those the dimension knows.

    Names are unique there and only the possible ones can match, so the broadcast side has no more rows than these.
    """
    exploded = rows.select(key, F.explode(names).alias("name"))
    ids = dimension.where(F.col("name").isin(possible)).select("name", F.col("id").alias(id_name))
    return exploded.join(F.broadcast(ids), "name").select(key, id_name, "name")


def allergen_links(masks: DataFrame, allergens: DataFrame, key: str = "recipe_id") -> DataFrame:
    """(key, allergen_id, name) for recipes or ingredients, one row per pair."""
    possible = [category.name for category in ALLERGENS]
    return _link(masks, categories_of(F.col("mask"), ALLERGENS), possible, key, allergens, "allergen_id")


def dietary_tag_links(masks: DataFrame, tags: DataFrame, key: str = "recipe_id") -> DataFrame:
    """(key, dietary_tag_id, name), one row per pair. Feed it from mask_recipes, which keeps empty recipes."""
    return _link(masks, dietary_tags_of(F.col("mask")), list(DIETARY_TAGS), key, tags, "dietary_tag_id")

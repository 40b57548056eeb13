"""Explicit schemas of the catalogue tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


_LONG, _INT, _STR, _BOOL, _TS = LongType(), IntegerType(), StringType(), BooleanType(), TimestampType()

DIMENSION = _struct(("id", _INT, False), ("name", _STR, False), ("display_name", _STR, False), ("description", _STR, True))

PAGES = _struct(("url", _STR, False), ("source", _STR, True), ("html", _STR, True), ("arrival", _LONG, True))

SITEMAPS = _struct(("source", _STR, True), ("sitemap_pos", _INT, True), ("sitemap_url", _STR, True), ("xml", _STR, True))

SOURCES = _struct(
    ("id", _LONG, False), ("name", _STR, False), ("base_url", _STR, False), ("enabled", _BOOL, False),
    ("created_at", _TS, False),
)

RECIPES = _struct(
    ("id", _LONG, False), ("source_id", _LONG, False), ("title", _STR, False), ("url", _STR, False),
    ("description", _STR, True), ("cuisine", _STR, True), ("prep_time", _INT, True), ("cook_time", _INT, True),
    ("total_time", _INT, True), ("servings", _INT, True), ("image_url", _STR, True), ("scraped_at", _TS, False),
)

INGREDIENTS = _struct(
    ("id", _LONG, False), ("raw_name", _STR, False), ("normalised_name", _STR, False), ("created_at", _TS, False),
)

RECIPE_INGREDIENTS = _struct(
    ("recipe_id", _LONG, False), ("ingredient_id", _LONG, False), ("quantity", _STR, True), ("unit", _STR, True),
    ("preparation", _STR, True),
)

INGREDIENT_ALLERGENS = _struct(("ingredient_id", _LONG, False), ("allergen_id", _INT, False), ("confidence", _STR, False))

RECIPE_ALLERGENS = _struct(("recipe_id", _LONG, False), ("allergen_id", _INT, False))

RECIPE_DIETARY_TAGS = _struct(("recipe_id", _LONG, False), ("dietary_tag_id", _INT, False))

RUN_LOG = _struct(
    ("source_id", _LONG, False), ("url", _STR, False), ("status", _STR, False), ("error_message", _STR, True),
    ("scraped_at", _TS, False),
)

TABLES = {
    "sources": SOURCES,
    "recipes": RECIPES,
    "ingredients": INGREDIENTS,
    "recipe_ingredients": RECIPE_INGREDIENTS,
    "ingredient_allergens": INGREDIENT_ALLERGENS,
    "recipe_allergens": RECIPE_ALLERGENS,
    "recipe_dietary_tags": RECIPE_DIETARY_TAGS,
    "run_log": RUN_LOG,
}

# Length limits of the text columns.
LENGTHS = {
    "sources": {"name": 100, "base_url": 255},
    "recipes": {"title": 255, "url": 500, "cuisine": 100, "image_url": 500},
    "ingredients": {"raw_name": 255, "normalised_name": 255},
    "recipe_ingredients": {"quantity": 50, "unit": 50, "preparation": 100},
    "allergens": {"name": 100, "display_name": 100},
    "dietary_tags": {"name": 100, "display_name": 100},
    "run_log": {"url": 500},
}

# Closed value sets.
DOMAINS = {
    ("ingredient_allergens", "confidence"): ("high", "medium", "low"),
    ("run_log", "status"): ("success", "failed", "skipped"),
}

# Unique keys. The id is a hash of the natural key, so it is checked like one.
KEYS = (
    ("sources", ("base_url",)),
    ("sources", ("id",)),
    ("recipes", ("url",)),
    ("recipes", ("id",)),
    ("ingredients", ("raw_name",)),
    ("ingredients", ("id",)),
    ("recipe_ingredients", ("recipe_id", "ingredient_id")),
    ("ingredient_allergens", ("ingredient_id", "allergen_id")),
    ("recipe_allergens", ("recipe_id", "allergen_id")),
    ("recipe_dietary_tags", ("recipe_id", "dietary_tag_id")),
    ("allergens", ("name",)),
    ("dietary_tags", ("name",)),
)

# Child column -> parent table; every parent key is `id`.
LINKS = (
    ("recipes", "source_id", "sources"),
    ("recipe_ingredients", "recipe_id", "recipes"),
    ("recipe_ingredients", "ingredient_id", "ingredients"),
    ("ingredient_allergens", "ingredient_id", "ingredients"),
    ("ingredient_allergens", "allergen_id", "allergens"),
    ("recipe_allergens", "recipe_id", "recipes"),
    ("recipe_allergens", "allergen_id", "allergens"),
    ("recipe_dietary_tags", "recipe_id", "recipes"),
    ("recipe_dietary_tags", "dietary_tag_id", "dietary_tags"),
    ("run_log", "source_id", "sources"),
)

"""Seeded dimensions and the sources table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names and texts shown to users.
ALLERGEN_ROWS = [
    (1, "peanuts", "Peanuts", "Includes peanuts and peanut-derived ingredients such as peanut oil or peanut butter"),
    (2, "tree_nuts", "Tree Nuts", "Includes almonds, cashews, walnuts, pecans, pistachios, hazelnuts, and similar"),
    (3, "dairy", "Dairy", "Includes milk, cheese, butter, cream, yoghurt, and other milk-derived ingredients"),
    (4, "egg", "Egg", "Includes whole eggs, egg yolks, egg whites, and egg-derived ingredients"),
]
DIETARY_TAG_ROWS = [
    (1, "vegetarian", "Vegetarian", "Contains no meat or fish"),
    (2, "vegan", "Vegan", "Contains no animal products of any kind"),
    (3, "gluten_free", "Gluten-Free", "Contains no gluten-containing ingredients"),
    (
        4,
        "contains_raw_egg",
        "Contains Raw Egg",
        "Includes raw or lightly cooked egg, such as in mayonnaise or mousse",
    ),
]


def _dimension(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The rows as a local relation: its size is known when joins are planned, so it is broadcast by size."""
    values = ", ".join(f"({key}, '{name}', '{display}', '{text}')" for key, name, display, text in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS rows(id, name, display_name, description)")


def allergens(spark: SparkSession) -> DataFrame:
    return _dimension(spark, ALLERGEN_ROWS)


def dietary_tags(spark: SparkSession) -> DataFrame:
    return _dimension(spark, DIETARY_TAG_ROWS)


def add_sources(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted (name, base_url) that do not exist yet, one row per base_url."""
    named = wanted.groupBy("base_url").agg(F.min("name").alias("name"))
    return named.join(existing.select("base_url"), "base_url", "left_anti").select("name", "base_url")


def enabled_sources(sources: DataFrame) -> DataFrame:
    return sources.where("enabled")

"""Checks for the rules a database would enforce, and deletion that follows links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(table: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """(rule, key, copies) of every key that occurs more than once. Counts fold on the map side."""
    copies = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    return copies.select(F.lit(rule).alias("rule"), F.concat_ws("|", *keys).alias("key"), "copies")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """(rule, key, rows): child keys without a parent. Children are counted per key first, so each key is joined once."""
    keys = child.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    lost = keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")
    return lost.select(F.lit(rule).alias("rule"), F.col("key").cast("string").alias("key"), "rows")


def text_faults(table: DataFrame, id_column: str, required: list[str], limits: dict[str, int]) -> DataFrame:
    """(rule, id, length) of missing and overlong values, all rules in one pass over the table."""
    missing = [
        F.when(F.col(c).isNull(), F.struct(F.lit(f"{c} missing").alias("rule"), F.lit(None).cast("int").alias("length")))
        for c in required
    ]
    long = [
        F.when(F.length(c) > n, F.struct(F.lit(f"{c} longer than {n}").alias("rule"), F.length(c).alias("length")))
        for c, n in limits.items()
    ]
    return table.select(id_column, F.inline(F.array_compact(F.array(*missing, *long)))).select("rule", id_column, "length")


def outside_domain(table: DataFrame, id_column: str, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """(column_name, id, value) of values that are not allowed. A null is allowed, as in SQL."""
    bad = table.where(~F.col(column).isin(*allowed))
    return bad.select(F.lit(column).alias("column_name"), id_column, F.col(column).alias("value"))


def without_keys(table: DataFrame, column: str, deleted: DataFrame, deleted_column: str) -> DataFrame:
    """The rows whose key is not deleted."""
    return table.join(deleted.select(F.col(deleted_column).alias(column)), column, "left_anti")


def delete_recipes(tables: dict[str, DataFrame], deleted: DataFrame) -> dict[str, DataFrame]:
    """Remove recipes (`deleted` has `id`) and every row that links to them."""
    links = ("recipe_ingredients", "recipe_allergens", "recipe_dietary_tags")
    kept = {name: without_keys(tables[name], "recipe_id", deleted, "id") for name in links if name in tables}
    return {**tables, "recipes": without_keys(tables["recipes"], "id", deleted, "id"), **kept}


def used_ingredients(tables: dict[str, DataFrame], deleted: DataFrame) -> DataFrame:
    """(id) of the ingredients to delete that a recipe still has; these cannot go."""
    used = tables["recipe_ingredients"].select(F.col("ingredient_id").alias("id")).distinct()
    return deleted.select("id").distinct().join(used, "id", "left_semi")


def delete_ingredients(tables: dict[str, DataFrame], deleted: DataFrame) -> dict[str, DataFrame]:
    """Remove ingredients that no recipe has, and their allergen rows. See `used_ingredients` for those that stay."""
    deleted = without_keys(deleted.select("id"), "id", used_ingredients(tables, deleted), "id")
    return {
        **tables,
        "ingredients": without_keys(tables["ingredients"], "id", deleted, "id"),
        "ingredient_allergens": without_keys(tables["ingredient_allergens"], "ingredient_id", deleted, "id"),
    }

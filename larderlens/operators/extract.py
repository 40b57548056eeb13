"""Pages to typed recipes: one map-only job, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlens import schemas
from larderlens.functions import jsonld, text

_INT_MAX = 2**31 - 1
NO_URL = "url missing"

# Field -> (reader of the recipe node, finisher of what was read).
FIELDS = {
    "title": (jsonld.read_text("name"), jsonld.title),
    "description": (jsonld.read_any("description"), text.clean_text),
    "prep_time": (jsonld.read_text("prepTime"), jsonld.minutes),
    "cook_time": (jsonld.read_text("cookTime"), jsonld.minutes),
    "total_time": (jsonld.read_text("totalTime"), jsonld.minutes),
    "servings": (jsonld.read_first_any("recipeYield"), jsonld.servings),
    "image_url": (jsonld.read_first_node("image"), jsonld.image_url),
    "ingredients": (jsonld.read_list("recipeIngredient"), jsonld.ingredient_lines),
    "cuisine": (jsonld.read_first_text("recipeCuisine"), jsonld.cuisine),
}
_CATEGORY = jsonld.read_first_text("recipeCategory")


def pick_recipes(pages: DataFrame) -> DataFrame:
    """Add `recipe` (variant), null where the page has none.

    The explode of an array of at most one item is deliberate: filters on what is read from the recipe
    cannot move below it, so the page is searched and parsed once.
    """
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, F.explode_outer(jsonld.recipe_nodes(F.col("html"))).alias("recipe"))


def project_recipes(picked: DataFrame, category_sources: list, fields: list[str] | None = None) -> DataFrame:
    """Read the named fields (all by default) of `recipe`; other columns pass through.

    A cuisine missing from a page of one of `category_sources` is taken from its category.
    """
    kept = [c for c in picked.columns if c != "recipe"]
    recipe, wanted = F.col("recipe"), fields or list(FIELDS)
    by_category = "cuisine" in wanted and bool(category_sources)
    read = {f"_{name}": FIELDS[name][0](recipe) for name in wanted}
    if by_category:
        read["_category"] = F.when(F.col("source").isin(category_sources), _CATEGORY(recipe))
    finished = {name: FIELDS[name][1](F.col(f"_{name}")) for name in wanted}
    if by_category:
        finished["cuisine"] = F.coalesce(finished["cuisine"], jsonld.category_cuisine(F.col("_category")))
    raw = picked.select(*kept, *[column.alias(name) for name, column in read.items()])
    return raw.select(*kept, *[column.alias(name) for name, column in finished.items()])


def _fault(condition: Column, message: str) -> Column:
    return F.when(condition, F.lit(message))


def row_fault(parsed: DataFrame) -> Column:
    """Why a parsed recipe cannot be stored, or null. These are the limits the tables declare."""
    limits = schemas.LENGTHS["recipes"]
    faults = [_fault(F.coalesce(parsed["url"], F.lit("")) == "", NO_URL)]
    faults += [_fault(F.length(parsed[name]) > size, f"{name} longer than {size}") for name, size in limits.items()]
    size = schemas.LENGTHS["ingredients"]["raw_name"]
    faults.append(
        _fault(F.exists(parsed["ingredients"], lambda line: F.length(line) > size), f"raw_name longer than {size}")
    )
    faults += [
        _fault(parsed[name] > _INT_MAX, f"{name} out of range")
        for name in ("prep_time", "cook_time", "total_time", "servings")
    ]
    return F.coalesce(*faults)


def parse_pages(pages: DataFrame, category_sources: list) -> DataFrame:
    """Every page with its fields and `outcome`: success, skipped (no recipe or title) or failed (with message)."""
    parsed = project_recipes(pick_recipes(pages), category_sources)
    fault = row_fault(parsed)
    has_title = parsed["title"].isNotNull()
    return parsed.withColumns(
        {
            "outcome": F.when(~has_title, "skipped").when(fault.isNotNull(), "failed").otherwise("success"),
            "error_message": F.when(has_title, fault),
        }
    )


def explode_lines(recipes: DataFrame, key: str = "url") -> DataFrame:
    """(key, pos, raw) for every ingredient line. Recipes without lines give no row."""
    return recipes.select(key, F.posexplode("ingredients").alias("pos", "raw"))

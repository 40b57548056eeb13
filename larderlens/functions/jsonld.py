"""Recipe JSON-LD: find it in a page and read its loosely typed fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larderlens import lexicon
from larderlens.functions.text import blank_to_null, strip, title_case

_LD_TYPE = "application/ld"

# One pass over a page. Comments and raw-text elements are consumed whole, whichever opens first, so a
# block inside a comment is not seen and a comment mark inside a script does not hide what follows.
# Group 1 is the body of a JSON-LD script and empty for everything else. Possessive loops keep the pass
# linear and the stack flat on long bodies.
_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
# Some frameworks write the plus sign as a character reference.
_TYPE_VALUE = r"application/ld(?:\+|&#43;|&#[xX]2[bB];|&plus;)json"
_LD_ATTRIBUTE = rf"""(?i:type)\s*=\s*(?:"{_TYPE_VALUE}"|'{_TYPE_VALUE}'|{_TYPE_VALUE}(?=[\s>]))"""
_LD_TAG = (
    rf"(?=[\s/])(?:[\s/](?!{_LD_ATTRIBUTE})|{_VALUE}|[^\s/>=]++|=)*+[\s/]{_LD_ATTRIBUTE}"
    rf"(?:[\s/]|{_VALUE}|[^\s/>=]++|=)*+>"
)


def _until(closing: str) -> str:
    return rf"(?:[^<]++|<(?!/(?i:{closing})))*+"


_PAGE_PARTS = (
    r"<(?:!--(?:[^-]++|-(?!->))*+"
    rf"|(?i:script)(?:{_LD_TAG}({_until('script')})|\b[^>]*+(?:>|\z){_until('script')})"
    rf"|(?i:style)\b[^>]*+(?:>|\z){_until('style')})"
)

# A JSON text counts as "no value" when its type is not string and it reads like one of these; so does "".
_EMPTY_LOOKING = r"^(?:|null|false|\[\]|\{\}|-?0(?:\.0*)?(?:E[+-]?\d+)?)$"


def jsonld_blocks(html: Column) -> Column:
    """Bodies of all JSON-LD scripts of a page, in order.

    The `contains` test keeps the regular expression away from pages that cannot hold a block.
    """
    bodies = F.filter(F.regexp_extract_all(html, F.lit(_PAGE_PARTS), F.lit(1)), lambda body: body != "")
    return F.when(F.contains(html, F.lit(_LD_TYPE)), bodies)


def _get(node: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(node, path, kind)


def _is_recipe(node: Column) -> Column:
    return _get(node, '$["@type"]', "string") == "Recipe"


def _candidates(block: Column) -> Column:
    """The nodes of one block that may be the recipe: list items, else the object, else its graph."""
    return F.coalesce(
        _get(block, "$", "array<variant>"),
        F.when(_is_recipe(block), F.array(block)),
        _get(block, '$["@graph"]', "array<variant>"),
        F.array().cast("array<variant>"),
    )


def _single(wrapped: Column) -> Column:
    """The only item of a list, null when there is none or more than one."""
    return F.when(_get(wrapped, "$[1]").isNull(), _get(wrapped, "$[0]"))


# A number that JSON does not know, with all that stands before it since the last one; strings are consumed whole.
_NO_NUMBER = (
    r"(?s)\G((?:[^\"NI-]++|\"(?:[^\"\\]++|\\.)*+\"|-(?!Infinity)|N(?!aN)|I(?!nfinity))*+)-?(?:NaN|Infinity)"
)


def _known_numbers(body: Column) -> Column:
    """NaN and Infinity outside strings read as null."""
    has_any = F.contains(body, F.lit("NaN")) | F.contains(body, F.lit("Infinity"))
    return F.when(has_any, F.regexp_replace(body, _NO_NUMBER, "$1null")).otherwise(body)


def recipe_nodes(html: Column) -> Column:
    """Zero or one recipe node of a page: the first one over all blocks. Bad blocks are passed over.

    The parser ignores what follows the first value of a text. Blocks are therefore read as one-item
    lists, where a remainder breaks the list or adds an item.
    """
    wrapped = F.transform(
        jsonld_blocks(html), lambda body: F.try_parse_json(F.concat(F.lit("["), _known_numbers(body), F.lit("]")))
    )
    blocks = F.transform(wrapped, _single)
    parsed = F.filter(blocks, lambda block: block.isNotNull())
    recipes = F.filter(F.flatten(F.transform(parsed, _candidates)), _is_recipe)
    return F.slice(recipes, 1, 1)


def _is_string(node: Column) -> Column:
    return F.schema_of_variant(node) == "STRING"


def _text(node: Column) -> Column:
    """The value of a JSON string; null for every other type."""
    return F.when(_is_string(node), _get(node, "$", "string"))


def _any_text(node: Column) -> Column:
    """A value as text, null for the values that count as none: null, false, 0, "", [] and {}."""
    text = _get(node, "$", "string")
    return F.when(~text.rlike(_EMPTY_LOOKING) | ((text != "") & _is_string(node)), text)


def _first(node: Column) -> Column:
    """Item 0 of a list, anything else as it is."""
    return F.coalesce(_get(node, "$[0]"), node)


def _first_leaf(node: Column) -> Column:
    """Item 0 of a list, of that item 0 again, and so on at any depth. The parser reads the first value of a text only."""
    inner = F.try_parse_json(F.regexp_replace(F.to_json(node), r"^\[+", ""))
    return F.when(_get(node, "$[0]").isNull(), node).otherwise(inner)


# Readers take the recipe node and fetch what a field is made from; finishers turn that into the value.
# They run as two projections, so a node is fetched once however often the rule looks at it.


def read_text(field: str):
    return lambda recipe: _text(_get(recipe, f"$.{field}"))


def read_any(field: str):
    return lambda recipe: _any_text(_get(recipe, f"$.{field}"))


def read_first_text(field: str):
    return lambda recipe: _text(_first(_get(recipe, f"$.{field}")))


def read_first_any(field: str):
    return lambda recipe: _any_text(_first(_get(recipe, f"$.{field}")))


def read_first_node(field: str):
    """The node itself, or the first item of a list, however deep it lies."""
    return lambda recipe: _first_leaf(_get(recipe, f"$.{field}"))


def read_list(field: str):
    return lambda recipe: _get(recipe, f"$.{field}", "array<variant>")


def title(name: Column) -> Column:
    return blank_to_null(strip(name))


def image_url(node: Column) -> Column:
    """A string, or the `url` of an object."""
    return F.coalesce(blank_to_null(_text(node)), _get(node, "$.url", "string"))


def cuisine(label: Column) -> Column:
    return blank_to_null(title_case(strip(label)))


def category_cuisine(label: Column) -> Column:
    """A category without its generic words, as a cuisine."""
    return cuisine(F.regexp_replace(label, rf"(?iU)\b(?:{lexicon.CATEGORY_NOISE})\b", ""))


def _amount(duration: Column, letter: str) -> Column:
    digits = blank_to_null(F.regexp_extract(duration, rf"(\d+){letter}", 1))
    return F.when(F.contains(duration, F.lit(letter)), digits.try_cast("bigint")).otherwise(F.lit(0))


def minutes(duration: Column) -> Column:
    """ISO-8601 duration text to minutes. Needs a leading P and an H or M part with digits."""
    timed = duration.startswith("P") & (F.contains(duration, F.lit("H")) | F.contains(duration, F.lit("M")))
    return F.when(timed, F.try_add(F.try_multiply(_amount(duration, "H"), F.lit(60)), _amount(duration, "M")))


def servings(text: Column) -> Column:
    """The first run of digits."""
    return blank_to_null(F.regexp_extract(text, r"\d+", 0)).try_cast("bigint")


def ingredient_lines(items: Column) -> Column:
    """The non-empty items as stripped strings; no list gives no lines. A blank string stays, as ""."""
    lines = F.filter(F.transform(items, _any_text), lambda text: text.isNotNull())
    return F.coalesce(F.transform(lines, strip), F.array().cast("array<string>"))

"""Dictionary matching with exceptions: which categories a text falls in."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from larderlens.functions.text import normalise_ingredient
from larderlens.lexicon import CATEGORIES, Category, bit, minimal

def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _holds_any(column: str, words: tuple[str, ...]) -> str:
    return f"exists(array({', '.join(map(_sql, minimal(words)))}), word -> contains({column}, word))"


def category_mask(column: str, categories: tuple[Category, ...] = CATEGORIES) -> Column:
    """One bit per category of a column of lower-case texts, as BIGINT. Exceptions are tried only after a hit.

    Each word list is one constant. Built as text, since some hundred separate literals take the driver longer
    than a small job runs.
    """
    terms = []
    for category in categories:
        hit = _holds_any(column, category.keywords)
        if category.exceptions:
            hit = f"{hit} AND NOT {_holds_any(column, category.exceptions)}"
        terms.append(f"CASE WHEN {hit} THEN {bit(category.name, categories)}L ELSE 0L END")
    return F.expr(" | ".join(terms))


def scan_mask(column: str, categories: tuple[Category, ...] = CATEGORIES) -> Column:
    """`category_mask` for long texts: one pass over the text whatever the size of the dictionary.

    An automaton over all words runs in an Arrow-batched function. It returns the bits of the words seen,
    keywords low and exceptions high; the rule itself stays a column expression.
    """
    width = len(categories)
    bits: dict[str, int] = {}
    for i, category in enumerate(categories):
        for shift, words in ((0, category.keywords), (width, category.exceptions)):
            for word in minimal(words):
                bits[word] = bits.get(word, 0) | 1 << (i + shift)

    @pandas_udf("bigint")
    def words_seen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for word, value in bits.items():
            automaton.add_word(word, value)
        automaton.make_automaton()

        def seen(value):
            found = 0
            for _, word_bits in automaton.iter(value or ""):
                found |= word_bits
            return found

        for batch in batches:
            yield batch.map(seen).astype("int64")

    seen = words_seen(F.col(column))
    return seen.bitwiseAND(F.bitwise_not(F.shiftright(seen, width))).bitwiseAND(F.lit((1 << width) - 1))


def categories_of(mask: Column, categories: tuple[Category, ...]) -> Column:
    """Names of the categories set in a mask, in dictionary order."""
    names = [F.when(mask.bitwiseAND(F.lit(bit(c.name))) != 0, F.lit(c.name)) for c in categories]
    return F.array_compact(F.array(*names))


def has(mask: Column, name: str) -> Column:
    return mask.bitwiseAND(F.lit(bit(name))) != 0


def flag_names(names: DataFrame) -> DataFrame:
    """Add `normalised` and `mask` to rows with a column `raw`, each matched where it stands."""
    named = names.withColumn("normalised", normalise_ingredient(F.col("raw")))
    return named.withColumn("mask", category_mask("normalised"))


def flag_lines(lines: DataFrame) -> DataFrame:
    """Add `normalised` and `mask` to every line, where it stands: no line is moved, and the vocabulary may grow freely."""
    return flag_names(lines)


def ingredient_dimension(lines: DataFrame) -> DataFrame:
    """One row per distinct raw line, normalised and matched once."""
    return flag_names(lines.select("raw").where(F.col("raw").isNotNull()).distinct())

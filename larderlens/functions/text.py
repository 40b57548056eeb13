"""Text rules as column expressions. All patterns use Unicode classes, `(?U)`."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from larderlens import lexicon

_BLANK = r"[\s\x1c-\x1f]"

# The characters that count as blank. `trim` alone removes U+0020 only.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_LEADING = rf"(?U)^(?:\d[\d/.{_BLANK[1:-1]}]*)?(?:a{_BLANK}+)?(?:an{_BLANK}+)?(?:some{_BLANK}+)?"
_FILLERS = r"(?U)\b(?:" + "|".join(map(re.escape, lexicon.UNIT_WORDS + lexicon.ADJECTIVE_WORDS)) + r")\b"


def strip(text: Column) -> Column:
    """Remove blanks of every kind from both ends."""
    return F.btrim(text, F.lit(_BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def fold(text: Column) -> Column:
    """Lower case without outer blanks: the form names are matched in."""
    return strip(F.lower(text))


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"))
    cased = F.transform(
        runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(run.substr(F.lit(2), F.length(run))))
    )
    return F.array_join(cased, "")


def clean_text(text: Column) -> Column:
    """Text without markup tags and outer blanks; null when nothing is left.

    The second branch puts back what follows a tag that never ends, so it is searched once and not from every `<`.
    """
    return blank_to_null(strip(F.regexp_replace(text, r"<[^>]++>|(<[^>]*+\z)", "$1")))


def normalise_ingredient(raw: Column) -> Column:
    """Reduce an ingredient line to its name: drop price, amount, article, units and adjectives.

    Amount and articles are one anchored pattern of optional parts, units and adjectives one
    alternation of whole words, so a line costs four passes. A line of which nothing is left
    stays as it was, folded.
    """
    line = fold(raw)
    name = F.regexp_replace(line, r"\(\$[\d.]+\)", "")
    name = F.regexp_replace(name, _LEADING, "")
    name = F.regexp_replace(name, _FILLERS, "")
    name = F.trim(F.regexp_replace(name, rf"(?U){_BLANK}+", " "))
    return F.coalesce(blank_to_null(name), line)

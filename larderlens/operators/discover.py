"""Recipe URLs from fetched sitemap indexes and sitemaps."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderlens.functions.text import strip


@dataclass(frozen=True)
class DiscoveryRule:
    """Which sitemaps of a source to read and which of their URLs to keep.

    Only the first `max_sitemaps` of a source are read; None reads all.
    """

    max_sitemaps: int | None = 2
    sitemap_contains: str | None = None
    url_contains: str | None = None
    url_excludes: str | None = None


# The marks of recipe sitemaps and pages.
RECIPE_SITEMAPS = DiscoveryRule(sitemap_contains="-recipe.xml", url_contains="/recipes/", url_excludes="/premium/")
POST_SITEMAPS = DiscoveryRule(url_excludes="wp-content")

# Comments are consumed first, so a commented-out entry is not seen. A pattern, unlike an XML parser,
# does not fail the job on one malformed document.
_LOC = r"(?s)<!--.*?(?:-->|\z)|<loc(?:\s[^>]*+)?+>((?:[^<]++|<(?!/?loc\b))*+)</loc\b"


# What a text is made of: CDATA sections, character references, and runs of anything else.
_TEXT_PARTS = r"(?s)<!\[CDATA\[.*?\]\]>|&(?:#[0-9]{1,7}|#x[0-9a-fA-F]{1,6}|lt|gt|quot|apos|amp);|[^&<]++|[&<]"
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def _part_text(part: Column) -> Column:
    """The text of one part. CDATA stands for itself; a reference to no character is left as it is."""
    is_hex = F.startswith(part, F.lit("&#x"))
    digits = F.regexp_extract(part, r"&#x?([0-9a-fA-F]+);", 1)
    code = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
    is_char = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    text = F.when(F.startswith(part, F.lit("<![CDATA[")), F.regexp_extract(part, r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1))
    for entity, plain in _ENTITIES.items():
        text = text.when(part == entity, F.lit(plain))
    return text.when(F.startswith(part, F.lit("&#")) & is_char, char).otherwise(part)


def _unescape(text: Column) -> Column:
    """References are decoded once, from left to right."""
    decoded = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TEXT_PARTS), F.lit(0)), _part_text), "")
    return F.when(F.contains(text, F.lit("&")) | F.contains(text, F.lit("<")), decoded).otherwise(text)


def _chosen(sitemaps: DataFrame, rule: DiscoveryRule) -> DataFrame:
    """The first sitemaps of each source.

    The rank limit is applied in each task before the shuffle, so a source with very many sitemaps costs no more than
    the others, and only bodies that may be chosen are moved.
    """
    if rule.sitemap_contains:
        sitemaps = sitemaps.where(F.contains("sitemap_url", F.lit(rule.sitemap_contains)))
    if rule.max_sitemaps is None:
        return sitemaps
    order = Window.partitionBy("source").orderBy("sitemap_pos")
    ranked = sitemaps.select("source", "sitemap_pos", "xml", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= rule.max_sitemaps)


def _locs(xml: str) -> Column:
    return F.posexplode(F.regexp_extract_all(xml, F.lit(_LOC), F.lit(1))).alias("pos", "loc")


def index_children(indexes: DataFrame, rule: DiscoveryRule) -> DataFrame:
    """(source, sitemap_pos, sitemap_url): the sitemaps to read of each source, as its index (source, xml) lists them.

    Their order is that of the index. A sitemap that is listed twice is two of `max_sitemaps`, as it is fetched twice. An index
    that was not fetched has none.
    """
    listed = indexes.select("source", _locs("xml"))
    listed = listed.select("source", F.col("pos").alias("sitemap_pos"), strip(_unescape(F.col("loc"))).alias("sitemap_url"))
    listed = listed.where(F.col("sitemap_url") != "")
    if rule.sitemap_contains:
        listed = listed.where(F.contains("sitemap_url", F.lit(rule.sitemap_contains)))
    if rule.max_sitemaps is None:
        return listed
    order = Window.partitionBy("source").orderBy("sitemap_pos")
    return listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.max_sitemaps).drop("rank")


def discover_from_index(indexes: DataFrame, bodies: DataFrame, rule: DiscoveryRule) -> DataFrame:
    """(source, url, sitemap_pos, pos) from sitemap indexes (source, xml) and fetched sitemaps (sitemap_url, xml).

    The index decides which sitemaps are read and in what order; bodies that it does not list are passed over before they
    are parsed, and a listed sitemap without a body yields nothing. Of bodies that repeat, one is read.
    """
    children = index_children(indexes, rule)
    wanted = bodies.join(children.select("sitemap_url").distinct(), "sitemap_url", "left_semi")
    one = wanted.groupBy("sitemap_url").agg(F.max("xml").alias("xml"))
    return discover_urls(children.join(one, "sitemap_url"), replace(rule, max_sitemaps=None, sitemap_contains=None))


def discover_urls(sitemaps: DataFrame, rule: DiscoveryRule) -> DataFrame:
    """(source, url, sitemap_pos, pos): every kept URL once, at the place it was first seen."""
    found = _chosen(sitemaps, rule).select(
        "source", "sitemap_pos", _locs("xml")
    )
    urls = found.select("source", "sitemap_pos", "pos", strip(_unescape(F.col("loc"))).alias("url"))
    urls = urls.where(F.col("url") != "")
    if rule.url_contains:
        urls = urls.where(F.contains("url", F.lit(rule.url_contains)))
    if rule.url_excludes:
        urls = urls.where(~F.contains("url", F.lit(rule.url_excludes)))
    first = urls.groupBy("source", "url").agg(F.min(F.struct("sitemap_pos", "pos")).alias("first"))
    return first.select("source", "url", "first.sitemap_pos", "first.pos")

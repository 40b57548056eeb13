"""The load job: pages in, catalogue tables out."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlens import schemas, session
from larderlens.operators import arrivals, discover, extract, matching, rollup
from larderlens.operators.discover import POST_SITEMAPS, RECIPE_SITEMAPS, DiscoveryRule
from larderlens.sources.seeds import add_sources
from larderlens.sources.tables import DEFAULT_RUN, Catalogue

_LOG = logging.getLogger(__name__)
_ORDER = ["arrival", "row_id"]


@dataclass(frozen=True)
class Source:
    """A site to load: where its pages come from and how they are read."""

    name: str
    base_url: str
    rule: DiscoveryRule
    cuisine_in_category: bool = False
    enabled: bool = True


# The two known sites.
SOURCES = (
    Source("BBC Good Food", "https://www.bbcgoodfood.com", RECIPE_SITEMAPS),
    Source("Budget Bytes", "https://www.budgetbytes.com", POST_SITEMAPS, cuisine_in_category=True),
)


def enabled(sources: tuple[Source, ...] = SOURCES) -> list[Source]:
    return [s for s in sources if s.enabled]


def discover_all(sitemaps: DataFrame, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    """URLs of all enabled sources; `sitemaps.source` holds the base_url."""
    found = [discover.discover_urls(sitemaps.where(F.col("source") == s.base_url), s.rule) for s in enabled(sources)]
    result = found[0] if found else discover.discover_urls(sitemaps.limit(0), DiscoveryRule())
    for other in found[1:]:
        result = result.unionByName(other)
    return result


def register_sources(tables: Catalogue, sources: list[Source], batch: int, run: str = DEFAULT_RUN) -> None:
    """Append the sources that are not in the table yet."""
    spark = tables.spark
    wanted = spark.createDataFrame([(s.name, s.base_url) for s in sources], "name string, base_url string")
    new = add_sources(tables.read("sources", batch, run), wanted).select(
        F.xxhash64("base_url").alias("id"),
        "name",
        "base_url",
        F.lit(True).alias("enabled"),
        F.current_timestamp().alias("created_at"),
    )
    tables.write("sources", new, batch, run)


def choose_pages(pages: DataFrame, urls: DataFrame | None) -> DataFrame:
    """The pages (url, source) that discovery found; all where there is no table of found URLs (source, url)."""
    if urls is None:
        return pages
    return pages.join(urls.select("source", "url").distinct(), ["source", "url"], "left_semi").select(*pages.columns)


def winning_rows(parsed: DataFrame, loaded: DataFrame, order: list[str]) -> DataFrame:
    """The parsed pages to load: of every URL not loaded before the first good arrival. `order` ends with a unique column,
    so the join is spread evenly however often one URL arrives."""
    good = F.col("outcome") == "success"
    winners = arrivals.new_urls(parsed.select("url", *order, "outcome"), loaded, order, good)
    return parsed.where(good).join(winners.select(order[-1]), order[-1], "left_semi")


def log_url() -> Column:
    """The URL as the log holds it: not null, and no longer than the log allows."""
    return F.left(F.coalesce("url", F.lit("")), F.lit(schemas.LENGTHS["run_log"]["url"]))


def log_rows(parsed: DataFrame, loaded: DataFrame, order: list[str]) -> DataFrame:
    """Every arrival with its status, as the log holds it: no URL is null or longer than the log allows."""
    seen = parsed.select(*[c for c in ("url", "source") if c in parsed.columns], *order, "outcome", "error_message")
    good = F.col("outcome") == "success"
    log = arrivals.arrival_status(seen, loaded, order, good, F.col("outcome"), F.col("error_message"))
    return log.drop("outcome").withColumn("url", log_url())


def load_batch(
    tables: Catalogue,
    pages: DataFrame,
    batch: int,
    sources: tuple[Source, ...] = SOURCES,
    run: str = DEFAULT_RUN,
    urls: DataFrame | None = None,
) -> None:
    """Load one batch of pages (url, source = base_url, html, arrival) and log every arrival.

    With `urls` (source, url), as discovery returns them, other pages are passed over. Batches are numbered within
    a run; writers that number their own batches give themselves different runs.

    Pages are parsed once, into a staged table that also fixes the row order; accepted recipes, names and
    masks are staged likewise, and every table is a narrow read of one of these. A batch depends on earlier
    batches only, so running it again gives the same tables. With no source enabled nothing is done, and neither with
    a batch that is part of a segment in every table.
    """
    session.configure(tables.spark)
    session.configure(pages.sparkSession)
    active = enabled(sources)
    if not active:
        _LOG.warning("no source is enabled")
        return
    if len(tables.folded(batch, run)) == len(schemas.TABLES):
        _LOG.info("batch %s of %s was put into segments", batch, run)
        return
    register_sources(tables, active, batch, run)

    chosen = choose_pages(pages.where(F.col("source").isin([s.base_url for s in active])), urls)
    category_sources = [s.base_url for s in active if s.cuisine_in_category]
    numbered = extract.parse_pages(chosen, category_sources).withColumn("row_id", F.monotonically_increasing_id())
    parsed = tables.stage("parsed", numbered, batch, run)

    loaded = tables.read("recipes", batch, run)
    write_batch(tables, winning_rows(parsed, loaded, _ORDER), log_rows(parsed, loaded, _ORDER), batch, run)


def write_batch(tables: Catalogue, fresh: DataFrame, log: DataFrame, batch: int, run: str) -> None:
    """Write all tables of a batch from the parsed pages to load (`fresh`) and the `log` of all arrivals.

    The log comes last: a batch with a log is complete.
    """
    stage = lambda name, rows: tables.stage(name, rows, batch, run)
    write = lambda name, rows: tables.write(name, rows, batch, run)
    unused = [c for c in ("row_id", "outcome", "error_message", "status") if c in fresh.columns]
    accepted = stage("accepted", fresh.withColumn("id", F.xxhash64("url")).drop(*unused))

    now = F.current_timestamp()
    write("recipes", accepted.withColumns({"source_id": F.xxhash64("source"), "scraped_at": now}))
    tables.tell_known(accepted.select("url"), batch, run)

    lines = accepted.select(F.col("id").alias("recipe_id"), F.explode("ingredients").alias("raw"))
    pairs = rollup.bridge(lines.select("recipe_id", F.xxhash64("raw").alias("ingredient_id")), "recipe_id", "ingredient_id")
    unknown = F.lit(None).cast("string")
    write("recipe_ingredients", pairs.withColumns({c: unknown for c in ("quantity", "unit", "preparation")}))

    known = tables.read("ingredients", batch, run).select(F.col("raw_name").alias("raw"))
    new_lines = lines.select("raw").distinct().join(known, "raw", "left_anti")
    names = stage("names", matching.flag_names(new_lines).withColumn("id", F.xxhash64("raw")))
    renamed = {"raw": "raw_name", "normalised": "normalised_name"}
    write("ingredients", names.withColumnsRenamed(renamed).withColumn("created_at", now))
    ingredient_links = rollup.allergen_links(names.withColumnRenamed("id", "ingredient_id"), tables.allergens(), "ingredient_id")
    write("ingredient_allergens", ingredient_links.withColumn("confidence", F.lit("high")))

    recipe_ids = accepted.select(F.col("id").alias("recipe_id"))
    masks = stage("masks", rollup.mask_recipes(recipe_ids, rollup.recipe_masks(matching.flag_lines(lines))))
    write("recipe_allergens", rollup.allergen_links(masks, tables.allergens()))
    write("recipe_dietary_tags", rollup.dietary_tag_links(masks, tables.dietary_tags()))

    write("run_log", log.withColumns({"source_id": F.xxhash64("source"), "scraped_at": now}))

"""Which page arrivals to load: known URLs are passed over, the first good arrival of a URL wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlens.functions.staging import settle


def summarise_urls(arrivals: DataFrame, loaded: DataFrame, order: list[str], good: Column) -> DataFrame:
    """(url, first_good, arrivals, known): one row per URL. Folded on the map side, so a hot URL is no hot task."""
    firsts = arrivals.groupBy("url").agg(
        F.min(F.when(good, F.struct(*order))).alias("first_good"), F.count(F.lit(1)).alias("arrivals")
    )
    known = loaded.select("url").distinct().withColumn("known", F.lit(True))
    return firsts.join(known, "url", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def new_urls(arrivals: DataFrame, loaded: DataFrame, order: list[str], good: Column) -> DataFrame:
    """(url, *order): the arrival to load of every URL not loaded before. URLs without a good one are left for later, and an
    arrival without URL is never loaded."""
    firsts = arrivals.where(good & F.col("url").isNotNull()).groupBy("url").agg(F.min(F.struct(*order)).alias("first_good"))
    fresh = firsts.join(loaded.select("url"), "url", "left_anti")
    return fresh.select("url", "first_good.*")


def arrival_status(
    arrivals: DataFrame,
    loaded: DataFrame,
    order: list[str],
    good: Column,
    bad_status: Column,
    message: Column,
) -> DataFrame:
    """Add `status` and `error_message` to every arrival.

    Anything that arrives once the URL is loaded is skipped, unread. The first good arrival is the success;
    what came before it has `bad_status`, with `message` when that is a failure. An arrival without URL is a failure.
    """
    named = arrivals.where(F.col("url").isNotNull())
    # One short row per URL, computed once. The rows of a hot URL meet it in a join of which skewed parts are split.
    summary = settle(summarise_urls(named, loaded, order, good), "url-summary").drop("arrivals")
    rows = named.join(summary.hint("merge"), "url")
    unnamed = arrivals.where(F.col("url").isNull()).withColumns(
        {"status": F.lit("failed"), "error_message": F.lit("url missing")}
    )
    here, first = F.struct(*order), F.col("first_good")
    done = F.col("known") | F.coalesce(here > first, F.lit(False))
    status = F.when(done, "skipped").when(here == first, "success").otherwise(bad_status)
    told = rows.withColumn("status", status).withColumn("error_message", F.when(F.col("status") == "failed", message))
    return told.drop("first_good", "known").unionByName(unnamed)


def run_summary(log: DataFrame, by: str = "source_id") -> DataFrame:
    """(by, ok, failed); a skipped arrival counts as ok."""
    failed = F.col("status") == "failed"
    return log.groupBy(by).agg(F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"))

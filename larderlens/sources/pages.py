"""Readers for fetched pages and sitemaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larderlens import schemas


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fetched pages `(url, source, html, arrival)`. Columns a file lacks read as null."""
    return spark.read.schema(schemas.PAGES).format(fmt).load(path)


def stream_pages(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """The same as a stream of new files."""
    return (
        spark.readStream.schema(schemas.PAGES)
        .format(fmt)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def read_sitemaps(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fetched sitemaps `(source, sitemap_pos, sitemap_url, xml)`; xml is null where fetching failed."""
    return spark.read.schema(schemas.SITEMAPS).format(fmt).load(path)

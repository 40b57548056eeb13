"""Session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL settings that results depend on (UTC timestamps, last duplicate
# JSON key wins) or that plans depend on (AQE re-planning and skew splitting).
REQUIRED = {
    # Methods above this size are never compiled by the JVM; interpreted expressions are then faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session the caller already owns."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "larderlens") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LARDERLENS_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark

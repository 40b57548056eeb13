"""Folders through the file system that Spark reads them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _opened(spark, path)
    return fs.exists(place)


def below(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing where there is none."""
    fs, place = _opened(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _opened(spark, path)
    fs.delete(place, True)

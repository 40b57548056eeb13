"""Tables that are written once to a folder all executors share, and read back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Folders of sessions that name none, by application.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as named in `spark.checkpoint.dir`.

    Where a session on one machine names none, as in tests, it gets a temporary folder. On a cluster that would be a folder
    of each machine, so there it has to be named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        application = spark.sparkContext.applicationId
        if application not in _OWN:
            _OWN[application] = tempfile.mkdtemp(prefix="larderlens-")
        folder = _OWN[application]
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, with no lineage, safe from lost executors."""
    spark = rows.sparkSession
    path = new_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)

"""Display values: page range and time label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_count(total: Column, size: Column) -> Column:
    return F.ceil(total / size).cast("bigint")


def page_from(total: Column, page: Column, size: Column) -> Column:
    return F.when(total == 0, F.lit(0)).otherwise((page - 1) * size + 1).cast("bigint")


def page_to(total: Column, page: Column, size: Column) -> Column:
    return F.least(page * size, total).cast("bigint")


def time_label(total_time: Column, prep_time: Column, cook_time: Column) -> Column:
    """The first of total, prep and cook time that is known and not zero, with its suffix."""

    def part(minutes: Column, suffix: str) -> Column:
        return F.concat(F.nullif(minutes, F.lit(0)).cast("string"), F.lit(suffix))

    return F.coalesce(part(total_time, " min"), part(prep_time, " min prep"), part(cook_time, " min cook"))

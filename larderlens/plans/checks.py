"""All rules of the catalogue tables as one report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlens import schemas
from larderlens.operators import quality
from larderlens.sources.tables import Catalogue

_REPORT = ["kind", "rule", "key", "rows"]


def _report(kind: str, faults: DataFrame, rule, key, rows) -> DataFrame:
    columns = [F.lit(kind), rule, key.cast("string"), rows.cast("bigint")]
    return faults.select(*[column.alias(name) for column, name in zip(columns, _REPORT, strict=True)])


def check_catalogue(tables: Catalogue) -> DataFrame:
    """(kind, rule, key, rows) for every broken rule: repeated keys, lost links, missing or overlong values and
    values outside their domain. Empty when the catalogue is sound."""
    frames = {name: tables.read(name) for name in schemas.TABLES}
    frames |= {"allergens": tables.allergens(), "dietary_tags": tables.dietary_tags()}
    reports = []
    for name, keys in schemas.KEYS:
        rule = f"{name}.{'+'.join(keys)}"
        faults = quality.duplicate_keys(frames[name], rule, list(keys))
        reports.append(_report("repeated", faults, F.col("rule"), F.col("key"), F.col("copies")))
    for child, key, parent in schemas.LINKS:
        faults = quality.orphans(frames[child], key, frames[parent], "id", f"{child}.{key}")
        reports.append(_report("no parent", faults, F.col("rule"), F.col("key"), F.col("rows")))
    return quality.union_all([*reports, check_values(frames)])


def check_values(frames: dict[str, DataFrame]) -> DataFrame:
    """(kind, rule, key, rows) of missing and overlong values and of values outside their domain, in the given tables."""
    reports = []
    dimensions = {name: schemas.DIMENSION for name in ("allergens", "dietary_tags")}
    for name, schema in (schemas.TABLES | dimensions).items():
        if name not in frames:
            continue
        id_column = schema.fields[0].name
        required = [f.name for f in schema.fields if not f.nullable]
        faults = quality.text_faults(frames[name], id_column, required, schemas.LENGTHS.get(name, {}))
        rule = F.concat(F.lit(f"{name}."), F.col("rule"))
        reports.append(_report("value", faults, rule, F.col(id_column), F.lit(1)))
    for (name, column), allowed in schemas.DOMAINS.items():
        id_column = schemas.TABLES[name].fields[0].name
        faults = quality.outside_domain(frames[name], id_column, column, allowed)
        rule = F.concat(F.lit(f"{name}.{column}="), F.col("value"))
        reports.append(_report("domain", faults, rule, F.col(id_column), F.lit(1)))
    return quality.union_all(reports)

"""Typed columns promoted out of the residual JSON of a change table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.contracts import ENTITIES, SPARK_TYPES, promoted_columns
from revtide.sources import folders


def promoted_from_file(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Promoted columns per table out of a JSON file on any file system, checked.

    `{"users": {"plan_note": "varchar"}}`. A file that is missing promotes nothing; a table
    that does not exist, or a column that is not allowed, is refused.
    """
    if not folders.exists(spark, path):
        return {}
    config = json.loads(folders.read_text(spark, path))
    if not isinstance(config, dict) or not set(config) <= set(ENTITIES):
        raise ValueError(f"{path} names tables that do not exist")
    return {table: dict(promoted_columns(config, table)) for table in config}


def widen_schema(changes: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Add promoted columns that older rows do not have yet, as nulls."""
    missing = {
        name: F.lit(None).cast(SPARK_TYPES[typ])
        for name, typ in columns if name not in changes.columns
    }
    return changes.withColumns(missing) if missing else changes


def backfill_promoted(changes: DataFrame, name: str, typ: str) -> DataFrame:
    """Fill a promoted column from the residual JSON where it is null."""
    text = F.get_json_object("_extra", f"$.{name}")
    wide = widen_schema(changes, [(name, typ)])
    return wide.withColumn(name, F.coalesce(name, text.try_cast(SPARK_TYPES[typ])))

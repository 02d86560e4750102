"""Batch scan and keyed-load operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.contracts import BATCH_SOURCE, ENTITIES, LOOKBACK_DAYS, SPARK_TYPES


#: The day of the watermark in sources that are laid out by it.
LAID_OUT_DAY = "_watermark_day"


def normalize(df: DataFrame, table: str) -> DataFrame:
    """Contract columns only, and the layout's day if there is one; zoned times become naive UTC, decimals whole numbers."""
    columns = []
    for name, typ in ENTITIES[table].columns:
        col = F.col(name)
        if isinstance(df.schema[name].dataType, T.TimestampType):
            local = col.cast("timestamp_ntz")
            col = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
        columns.append(col.cast(SPARK_TYPES[typ]).alias(name))
    return df.select(*columns, *[c for c in df.columns if c == LAID_OUT_DAY])


def incremental_scan(
    df: DataFrame, table: str, watermark=None, lookback_days: int = LOOKBACK_DAYS,
    full_refresh: bool = False,
) -> DataFrame:
    """Rows at or after the stored watermark less the lookback; a pushed-down filter.

    Of a source that is laid out by its watermark only the files of those days are read. A
    day more is taken there, as the layout may have been made in another zone.
    """
    entity = ENTITIES[table]
    rows = df.select(*entity.column_names)
    if entity.mode != "upsert" or watermark is None or full_refresh:
        return rows
    start = F.lit(watermark).cast("timestamp_ntz") - F.make_dt_interval(F.lit(lookback_days))
    if LAID_OUT_DAY in df.columns:
        rows = df.filter(F.col(LAID_OUT_DAY) >= F.date_sub(start.cast("date"), 1)).select(*entity.column_names)
    return rows.filter(F.col(entity.watermark) >= start)


def stamp(df: DataFrame, batch_id: str, loaded_at, source_system: str = BATCH_SOURCE) -> DataFrame:
    """Add load time, batch id and source; the caller fixes them once per run."""
    return df.withColumns(
        {
            "_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
            "_batch_id": F.lit(batch_id),
            "_source_system": F.lit(source_system),
        }
    )


def upsert_by_key(target: DataFrame, incoming: DataFrame, pk: str) -> DataFrame:
    """Replace target rows whose key comes in, keep the rest, add what is new."""
    kept = target.join(incoming.select(pk), pk, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def ingest_state(raw: DataFrame, table: str, mode: str, updated_at) -> DataFrame:
    """Watermark and row count over the whole table after a load; one row."""
    return raw.agg(
        F.lit(table).alias("table_name"),
        F.max(ENTITIES[table].watermark).alias("watermark"),
        F.count("*").alias("rows_loaded"),
        F.lit(mode).alias("load_mode"),
        F.lit(updated_at).cast("timestamp_ntz").alias("updated_at"),
    )


def drop_batch(changes: DataFrame, batch_id: str) -> DataFrame:
    return changes.filter(~F.col("_batch_id").eqNullSafe(F.lit(batch_id)))


def repair_negative_mrr(subs: DataFrame, prices: dict[str, int]) -> DataFrame:
    """Set negative amounts to the catalog price of the plan; other rows stay.

    A negative amount on a plan outside the catalog fails the query. The
    catalog has one entry per plan, so it travels as a constant map.
    """
    catalog = F.create_map(*[F.lit(x) for item in prices.items() for x in item])
    plan = F.lower(F.col("plan").cast("string"))
    price = F.try_element_at(catalog, plan).cast("bigint")
    unknown = F.raise_error(F.concat(F.lit("no catalog price for plan "), F.coalesce(plan, F.lit("null"))))
    repaired = F.when(F.col("mrr_cents") < 0, F.coalesce(price, unknown.cast("bigint")))
    return subs.withColumn("mrr_cents", repaired.otherwise(F.col("mrr_cents")))

"""Current rows: the latest change per key, merged with the batch snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.contracts import ENTITIES


def first_per_key(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """Keep one row per key.

    A filter on row_number() = 1 makes Spark prune each map task to one row
    per key before the shuffle, so a key that holds a third of the table
    arrives as one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_change(changes: DataFrame, pk: str) -> DataFrame:
    """Last change per key by offset, then log position; the token breaks ties."""
    order = [
        F.col("_kafka_offset").desc_nulls_last(),
        F.col("_source_lsn").desc_nulls_last(),
        F.col("_dedup_token").desc_nulls_last(),
    ]
    return first_per_key(changes, [pk], order)


def current_entity(batch: DataFrame, changes: DataFrame, table: str) -> DataFrame:
    """One live row per key out of the batch snapshot and the change table.

    The last change competes with the batch row on version time and wins ties;
    a winning delete removes the key. Each side is reduced to one row per key
    and shuffled once; the outer join reuses that partitioning and sort order.
    Columns that a caller does not read are pruned from both scans.
    """
    entity = ENTITIES[table]
    kept = entity.column_names + ["_loaded_at", "_batch_id", "_source_system"]

    snapshot = first_per_key(
        batch.select(kept), [entity.pk], [F.col("_loaded_at").desc_nulls_last()]
    ).selectExpr(
        f"{entity.pk} as _key", "true as _in_batch", *[f"{name} as b_{name}" for name in kept]
    )
    change = latest_change(changes, entity.pk).selectExpr(
        f"{entity.pk} as _key", "true as _in_changes", "coalesce(_deleted, false) as _gone",
        "coalesce(_source_ts, _loaded_at) as _changed_at",
        *[f"{name} as c_{name}" for name in kept],
    )
    # A missing version time sorts last, so only a dated batch row can beat a change.
    from_batch = """(_in_changes is null or (_in_batch is not null and b__loaded_at is not null
        and (_changed_at is null or b__loaded_at > _changed_at)))"""
    merged = snapshot.join(change, "_key", "full").filter(f"{from_batch} or not _gone")
    return merged.selectExpr(*[f"if({from_batch}, b_{name}, c_{name}) as {name}" for name in kept])

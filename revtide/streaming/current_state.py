"""Current rows kept by a running stream: the last change per key as streaming state.

The batch form reads a change table and ranks it (`operators.current.latest_change`). Here a
stateful aggregate holds the last change of each key; an epoch emits the keys that it
changed, and these are merged into a keyed table, in the key partitions they fall into. The
checkpoint holds the state, so a restart goes on from it; an epoch that runs twice merges
the same rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.contracts import ENTITIES, change_schema
from revtide.sources.lake import Lake
from revtide.streaming.envelope import parse_envelopes, with_table


def latest_changes(records: DataFrame, table: str, promoted: dict | None = None) -> DataFrame:
    """The last change per key of a stream (or frame) of records; broken records are left out.

    Last is by offset, then log position, then token, as in the batch form.
    """
    names = change_schema(table, promoted).names
    parsed = parse_envelopes(with_table(records).filter(F.col("_table") == table), table, promoted)
    # Below a projection the filter would parse all over again, and a stream cannot be persisted; above a generator it stays.
    columns = ", ".join(f"`{n}`" for n in parsed.columns if n in names or n == "error")
    valid = parsed.selectExpr(f"stack(1, {columns}) as ({columns})").filter("error is null")
    stamped = valid.withColumns({
        "_loaded_at": F.current_timestamp().cast("timestamp_ntz"), "_batch_id": F.lit("state")})
    order = F.struct(
        F.coalesce("_kafka_offset", F.lit(-1)), F.coalesce("_source_lsn", F.lit(-1)), F.coalesce("_dedup_token", F.lit("")))
    return stamped.groupBy(ENTITIES[table].pk).agg(
        F.max_by(F.struct(*names), order).alias("last")).select(*[f"last.{n}" for n in names])


class CurrentState:
    """A keyed table of last changes that a stream maintains."""

    def __init__(self, lake: Lake, table: str, promoted: dict | None = None) -> None:
        self.lake, self.table, self.promoted = lake, table, promoted
        self.name = f"{table}_latest"

    def changes(self) -> DataFrame:
        """One change row per key: what `current_entity` takes as its change side."""
        return self.lake.read(self.name, change_schema(self.table, self.promoted))

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        schema, pk = change_schema(self.table, self.promoted), ENTITIES[self.table].pk

        def merge(changed: DataFrame, epoch: int) -> None:
            self.lake.commit({self.name: self.lake.upsert(self.name, changed.select(*schema.names), pk, schema)})

        return (
            latest_changes(stream, self.table, self.promoted)
            .writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )

"""Idempotent landing of change records into append-only change tables.

Rows lie by offset, and below that by batch: `bucket=<offset div bucket size>/landing=<id>/
epoch=<n>`. The bucket size is a parameter: choose it so that a bucket holds some hundred
megabytes of records, however many offsets these are; a landing keeps the first it was given. The id belongs to one checkpoint. A retried epoch replaces its own folders and
is compared with all others, so a crash at any point neither loses nor repeats a change; a
replay under a new checkpoint has a new id and adds nothing. A batch opens only the
buckets that its offsets lie in, so its cost does not grow with history.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.contracts import (
    CONSUMER_GROUP,
    DEAD_LETTER_COLUMNS,
    ENTITIES,
    OFFSET_COLUMNS,
    change_schema,
    struct_of,
)
from revtide.operators.current import first_per_key
from revtide.session import configure, side_by_side
from revtide.sources import folders
from revtide.streaming.envelope import (
    as_dead_letters,
    parse_envelopes,
    reject_unknown,
    with_table,
)

DEAD_LETTERS = "_dead_letters"
OFFSETS = "_offsets"
BUCKET = 10_000  # offsets, unless another size is given
BATCH_FIELDS = [T.StructField("landing", T.StringType()), T.StructField("epoch", T.LongType())]


def spanned(found: list, size: int = BUCKET) -> set[int]:
    """The buckets that the offsets of these topic partitions lie in."""
    return {b for r in found for b in range(r["first"] // size, r["last"] // size + 1)}


class Landing:
    """Change tables, dead letters and offsets under one folder."""

    def __init__(
        self, spark: SparkSession, root: str, promoted: dict | None = None,
        consumer_group: str = CONSUMER_GROUP,
        publish: Callable[[DataFrame], None] | None = None, bucket: int = BUCKET,
    ) -> None:
        self.spark = configure(spark)
        self.root = root
        self._bucket: int | None = None
        self._wanted_bucket = bucket
        self.promoted = promoted
        self.group = consumer_group
        self.publish = publish

    @property
    def bucket(self) -> int:
        """Offsets in a bucket: what the first writer chose, as its rows lie by it."""
        if self._bucket is None:
            path = f"{self.root}/_bucket_size"
            if not folders.exists(self.spark, path):
                folders.create_text(self.spark, path, str(self._wanted_bucket))
            self._bucket = int(folders.read_text(self.spark, path))
        return self._bucket

    # --- reads ------------------------------------------------------------

    def _present(self, path: str, buckets: set[int]) -> list[str]:
        """The folders of some buckets that exist. No other bucket is listed."""
        found = [f"bucket={b}" for b in sorted(buckets)]
        return [n for n in found if folders.exists(self.spark, f"{path}/{n}")]

    def _read(self, name: str, schema: T.StructType, buckets: set[int] | None = None) -> DataFrame:
        """Landed rows with their batch, of all buckets or some; empty before the first batch."""
        path = f"{self.root}/{name}"
        full = T.StructType(schema.fields + BATCH_FIELDS)
        found = self._present(path, buckets) if buckets is not None else folders.exists(self.spark, path)
        if not found:
            return self.spark.createDataFrame([], full)
        paths = [path] if buckets is None else [f"{path}/{n}" for n in found]
        return self.spark.read.schema(full).option("basePath", path).parquet(*paths)

    def changes(self, table: str) -> DataFrame:
        """A change table; columns promoted later read as null in older files."""
        schema = change_schema(table, self.promoted)
        return self._read(f"{table}_cdc", schema).select(*schema.names)

    def dead_letters(self) -> DataFrame:
        schema = struct_of(DEAD_LETTER_COLUMNS)
        return self._read(DEAD_LETTERS, schema).select(*schema.names)

    def offsets(self) -> DataFrame:
        """The ledger: the row saved last per group, topic and partition."""
        rows = self._read(OFFSETS, struct_of(OFFSET_COLUMNS))
        keys = ["consumer_group", "topic", "partition_id"]
        return rows.groupBy(*keys).agg(
            F.max_by("committed_offset", "updated_at").alias("committed_offset"),
            F.max("updated_at").alias("updated_at"),
        )

    # --- writes -----------------------------------------------------------

    def _write(
        self, df: DataFrame, name: str, offset: str, buckets: set[int], landing_id: str, epoch: int
    ) -> int:
        """Replace this batch's own folders; returns the rows written."""
        for bucket in self._own(name, buckets, landing_id, epoch):
            folders.delete(self.spark, bucket)
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("n")).withColumns({
            "bucket": F.expr(f"{offset} div {self.bucket}"), "landing": F.lit(landing_id), "epoch": F.lit(epoch)})
        rows.write.mode("append").partitionBy("bucket", "landing", "epoch").parquet(f"{self.root}/{name}")
        return seen.get["n"]

    def _own(self, name: str, buckets: set[int], landing_id: str, epoch: int) -> list[str]:
        """The folders that an earlier attempt of this batch has left."""
        path = f"{self.root}/{name}"
        own = [f"{path}/{b}/landing={landing_id}/epoch={epoch}" for b in self._present(path, buckets)]
        return [folder for folder in own if folders.exists(self.spark, folder)]

    def _others(
        self, name: str, schema: T.StructType, buckets: set[int], landing_id: str, epoch: int
    ) -> DataFrame:
        own = (F.col("landing") == landing_id) & (F.col("epoch") == epoch)
        return self._read(name, schema, buckets).filter(~own)

    def land_changes(
        self, parsed: DataFrame, table: str, buckets: set[int], batch_id: str, loaded_at,
        landing_id: str, epoch: int,
    ) -> int:
        """Append the changes whose (key, token) is not there yet.

        Inside the batch the first delivery in offset order wins. Both token
        forms carry the offset, so only rows in the buckets of the batch can
        match, and no others are opened.
        """
        schema, pk = change_schema(table, self.promoted), ENTITIES[table].pk
        fresh = first_per_key(
            parsed.filter("error is null"), [pk, "_dedup_token"],
            [F.col("_kafka_topic"), F.col("_kafka_partition"), F.col("_kafka_offset")],
        )
        stamped = fresh.withColumns(
            {"_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"), "_batch_id": F.lit(batch_id)}
        ).select(*schema.names)
        landed = self._others(f"{table}_cdc", schema, buckets, landing_id, epoch)
        new = stamped.join(landed.select(pk, "_dedup_token"), [pk, "_dedup_token"], "left_anti")
        return self._write(
            new.select(*schema.names), f"{table}_cdc", "_kafka_offset", buckets, landing_id, epoch)

    def land_dead_letters(
        self, letters: DataFrame, buckets: set[int], landing_id: str, epoch: int
    ) -> int:
        schema = struct_of(DEAD_LETTER_COLUMNS)
        once = first_per_key(letters, ["dead_letter_id"], [F.col("offset_id")])
        landed = self._others(DEAD_LETTERS, schema, buckets, landing_id, epoch)
        new = once.join(landed.select("dead_letter_id"), "dead_letter_id", "left_anti")
        return self._write(
            new.select(*schema.names), DEAD_LETTERS, "offset_id", buckets, landing_id, epoch)

    def save_offsets(self, found: list, saved_at, landing_id: str, epoch: int) -> None:
        """Next offset to read per topic partition, one row of `found` each.

        Each epoch writes the whole ledger of its landing, a row per topic partition that
        it has seen, and then drops those of other epochs. Within a landing an offset never
        goes back, whatever clock wrote it and in whatever order files come.
        """
        schema, path = struct_of(OFFSET_COLUMNS), f"{self.root}/{OFFSETS}/landing={landing_id}"
        ledger = {}
        if folders.exists(self.spark, path):
            rows = self._read(OFFSETS, schema).filter(F.col("landing") == landing_id)
            for row in sorted(rows.select(*schema.names).collect(), key=lambda r: r["committed_offset"]):
                ledger[row["topic"], row["partition_id"]] = tuple(row)
        for row in found:
            before = ledger.get((row["topic"], row["partition"]))
            ledger[row["topic"], row["partition"]] = (
                self.group, row["topic"], row["partition"], max(row["last"] + 1, before[3] if before else 0), saved_at)
        fresh = self.spark.createDataFrame(list(ledger.values()), schema).coalesce(1)
        fresh.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        for name in folders.names(self.spark, path):
            if name != f"epoch={epoch}":
                folders.delete(self.spark, f"{path}/{name}")

    def apply_records(
        self, records: DataFrame, batch_id: str | None = None, commit_offsets: bool = True,
        landing_id: str | None = None, epoch: int = 0,
    ) -> dict[str, int]:
        """Parse and land one batch of records; returns its statistics.

        Changes and dead letters are written before the offsets. Executors do
        the work; the driver sees one span per topic partition and counts.
        """
        batch_id = batch_id or uuid.uuid4().hex
        landing_id = landing_id or batch_id
        loaded_at = datetime.now(UTC).replace(tzinfo=None)
        keep = StorageLevel.MEMORY_AND_DISK
        tagged = with_table(records).persist(keep)
        held = [tagged]
        try:
            spans = tagged.groupBy("topic", "partition", "_table").agg(
                F.min("offset").alias("first"), F.max("offset").alias("last"),
                F.count("*").alias("n"),
            )
            found = spans.collect()
            stats = {"inserted": 0, "skipped": 0, "dead_letters": 0}
            if not found:
                return stats
            unknown = sum(row["n"] for row in found if row["_table"] is None)
            stats |= {"parsed_changes": 0, "parsed_dead_letters": unknown}

            def land_table(table: str) -> tuple[DataFrame, int, int, int]:
                mine = [row for row in found if row["_table"] == table]
                parsed = parse_envelopes(
                    tagged.filter(F.col("_table") == table), table, self.promoted
                ).persist(keep)
                held.append(parsed)
                good, inserted = parsed.filter("error is null").count(), 0
                buckets = spanned(mine, self.bucket)
                if good or self._own(f"{table}_cdc", buckets, landing_id, epoch):
                    inserted = self.land_changes(
                        parsed, table, buckets, batch_id, loaded_at, landing_id, epoch
                    )
                return parsed, sum(row["n"] for row in mine), good, inserted

            present = [t for t in ENTITIES if any(row["_table"] == t for row in found)]
            rejected = [reject_unknown(tagged)]
            for parsed, seen, good, inserted in side_by_side(self.spark, land_table, present):
                rejected.append(parsed.select(*rejected[0].columns))
                stats["parsed_changes"] += good
                stats["parsed_dead_letters"] += seen - good
                stats["inserted"] += inserted
                stats["skipped"] += good - inserted
            letters = as_dead_letters(reduce(DataFrame.unionByName, rejected), loaded_at)
            if stats["parsed_dead_letters"]:
                stats["dead_letters"] = self.land_dead_letters(
                    letters, spanned(found, self.bucket), landing_id, epoch)
            if commit_offsets:
                self.save_offsets(found, loaded_at, landing_id, epoch)
            if self.publish and stats["parsed_dead_letters"]:
                self.publish(letters)
            return stats
        finally:
            for df in held:
                df.unpersist()

    # --- streaming --------------------------------------------------------

    def _landing_id(self, checkpoint: str) -> str:
        """The id of a checkpoint, created with it and gone with it."""
        path = f"{checkpoint}/landing_id"
        if not folders.exists(self.spark, path):
            folders.create_text(self.spark, path, uuid.uuid4().hex)
        return folders.read_text(self.spark, path)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Start landing a stream; the checkpoint is written after each batch has landed."""
        landing_id = self._landing_id(checkpoint)

        def land(batch: DataFrame, epoch: int) -> None:
            self.apply_records(batch, f"spark-{epoch}", True, landing_id, epoch)

        return (
            stream.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )

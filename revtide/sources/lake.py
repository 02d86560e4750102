"""Named Parquet tables that change all together or not at all.

A table is a list of immutable folders (segments). A numbered manifest names
the live segments of every table; a new manifest is the only thing that makes
written data visible, so readers see a whole load or none of it, and a job
that dies half-way leaves the previous state in place.

Tables that change by key or by day are partitioned on write, by Spark's own
partitionBy; a change then reads and writes only the partitions it falls into,
as dynamic partition overwrite does, and becomes visible with all others.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.operators.quality import duplicate_keys
from revtide.session import work_folder
from revtide.sources import folders

MANIFESTS = "_manifests"
SCHEMAS = "_schemas"  # in a manifest: the schema of each table, as JSON
PART = "part"  # the folder level of a partition
CODEC = "zstd"  # of the files; those in another one are read as well


def part_of(segment: str) -> str | None:
    """The partition that a segment holds; None if it holds rows of any."""
    name = segment.rsplit("/", 1)[1]
    return name.removeprefix(f"{PART}=") if name.startswith(f"{PART}=") else None


class Lake:
    """`key_parts`: into how many partitions the keys of a new keyed table are dealt.

    Choose it so that a partition is some hundred megabytes. A keyed table keeps the
    number that it was first written with: it is part of its partitions' names.
    """

    def __init__(self, spark: SparkSession, root: str, key_parts: int = 8) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.key_parts = key_parts

    # --- manifest ---------------------------------------------------------

    def _latest(self) -> tuple[int, dict[str, list[str]]]:
        found = [n for n in folders.names(self.spark, f"{self.root}/{MANIFESTS}")
                 if n.endswith(".json")]
        if not found:
            return 0, {}
        text = folders.read_text(self.spark, f"{self.root}/{MANIFESTS}/{found[-1]}")
        return int(found[-1].split(".")[0]), json.loads(text)

    def version(self) -> int:
        return self._latest()[0]

    def segments(self, table: str) -> list[str]:
        return self._latest()[1].get(table, [])

    def schema(self, table: str) -> T.StructType | None:
        """The schema that a table was committed with, if it was named then."""
        text = self._latest()[1].get(SCHEMAS, {}).get(table)
        return T.StructType.fromJson(text) if text else None

    def commit(
        self, staged: dict[str, list[str]], based_on: int | None = None,
        schemas: dict[str, T.StructType] | None = None,
    ) -> int:
        """Make staged tables visible together, with the schemas to read them by.

        Fails when another writer committed since `based_on`; nothing is then visible.
        """
        number, tables = self._latest()
        if based_on is not None and based_on != number:
            raise RuntimeError(f"lake moved from version {based_on} to {number} during this load")
        named = {table: schema.jsonValue() for table, schema in (schemas or {}).items()}
        state = {**tables, **staged, SCHEMAS: {**tables.get(SCHEMAS, {}), **named}}
        path = f"{self.root}/{MANIFESTS}/{number + 1:010d}.json"
        if not folders.create_text(self.spark, path, json.dumps(state, sort_keys=True)):
            raise RuntimeError(f"another writer took version {number + 1}")
        return number + 1

    # --- tables -----------------------------------------------------------

    def read(self, table: str, schema: T.StructType, segments: list[str] | None = None) -> DataFrame:
        """A table under its contract schema; columns added later read as null in old segments."""
        live = self.segments(table) if segments is None else segments
        if not live:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{s}" for s in live])

    def write(self, table: str, df: DataFrame) -> str:
        """Write one new segment; invisible until committed."""
        segment = f"{table}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{segment}", compression=CODEC)
        return segment

    def write_parts(self, table: str, df: DataFrame, part: Column, sort: list[str]) -> list[str]:
        """Write one new segment per value of `part`, its rows in order."""
        folder, columns = f"{table}/{uuid.uuid4().hex}", df.columns
        dealt = df.withColumn("_part", part.cast("string")).repartition("_part").sortWithinPartitions("_part", *sort)
        dealt.select(*columns, F.col("_part").alias(PART)).write.partitionBy(PART).parquet(
            f"{self.root}/{folder}", compression=CODEC)
        return [f"{folder}/{n}" for n in folders.names(self.spark, f"{self.root}/{folder}") if n.startswith(f"{PART}=")]

    def replace(self, table: str, df: DataFrame) -> list[str]:
        """Stage a full reload; an empty frame empties the table."""
        return [self.write(table, df)]

    def overwrite_parts(
        self, table: str, df: DataFrame, part: Column, touched: set[str], sort: list[str]
    ) -> list[str]:
        """Stage the rows of some partitions; what is live in others stays."""
        kept = [s for s in self.segments(table) if part_of(s) not in touched]
        return kept + self.write_parts(table, df, part, sort)

    def key_part(self, table: str, key: str) -> Column:
        """The partition of a key: `<number>of<number of partitions>`."""
        known = next((p for s in self.segments(table) if (p := part_of(s))), None)
        n = int(known.split("of")[1]) if known else self.key_parts
        return F.concat(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("string"), F.lit(f"of{n}"))

    def replace_keyed(self, table: str, df: DataFrame, pk: str, sort: list[str] | None = None) -> list[str]:
        """Stage a full reload of a table that later changes by key."""
        return self.write_parts(table, df, self.key_part(table, pk), sort or [pk])

    def upsert(
        self, table: str, df: DataFrame, pk: str, schema: T.StructType, sort: list[str] | None = None
    ) -> list[str]:
        """Stage a keyed merge; an empty frame changes nothing.

        Only partitions that an incoming key falls into are read and written again; which
        ones these are follows from the incoming keys alone.
        """
        part, live = self.key_part(table, pk), self.segments(table)
        folder = work_folder(self.spark, "incoming")
        df.write.parquet(folder)
        incoming = self.spark.read.schema(schema).parquet(folder)
        if duplicate_keys(incoming.select(pk), [pk]).limit(1).count():
            raise ValueError(f"incoming rows of {table} repeat a {pk}")
        # At most one row per partition reaches the driver.
        touched = {row["part"] for row in incoming.select(part.alias("part")).distinct().collect()}
        mixed = [s for s in live if part_of(s) is None]
        held = [s for s in live if part_of(s) in touched] + (mixed if touched else [])
        kept = self.read(table, schema, held).join(incoming.select(pk), pk, "left_anti").select(*schema.names)
        if not touched:
            return live
        merged = self.write_parts(table, kept.unionByName(incoming), part, sort or [pk])
        return [s for s in live if s not in held] + merged

"""Sources of change records, all with the Kafka record columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.contracts import DEAD_LETTER_TOPIC, ENTITIES, RECORD_SCHEMA

FIELDS = [field.name for field in RECORD_SCHEMA]


@dataclass(frozen=True)
class Pace:
    """How much one micro-batch takes: at most `most` offsets; with `least`, it waits for that
    many, but no longer than `delay`."""

    most: int | None = 10_000_000
    least: int | None = None
    delay: str = "5m"

    def options(self) -> dict[str, str]:
        found = {} if self.most is None else {"maxOffsetsPerTrigger": str(self.most)}
        if self.least is not None:
            if self.most is not None and self.least > self.most:
                raise ValueError("a batch cannot wait for more offsets than it may take")
            found |= {"minOffsetsPerTrigger": str(self.least), "maxTriggerDelay": self.delay}
        return found


def topic_options(servers: str, tasks: int, pace: Pace = Pace()) -> dict[str, str]:
    """The options of a stream over the six change topics."""
    return {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(e.topic for e in ENTITIES.values()),
        "startingOffsets": "earliest", "failOnDataLoss": "false", "minPartitions": str(tasks), **pace.options(),
    }


def read_changes(
    spark: SparkSession, servers: str, min_partitions: int | None = None, pace: Pace = Pace()
) -> DataFrame:
    """Stream of the six change topics; needs the Kafka connector on the classpath.

    Long offset ranges are split until there are `min_partitions` read tasks
    (the session's parallelism by default), so one busy topic partition does
    not become one long task. A backlog is landed in batches of the pace.
    """
    tasks = min_partitions or spark.sparkContext.defaultParallelism
    return spark.readStream.format("kafka").options(**topic_options(servers, tasks, pace)).load().select(*FIELDS)


def read_change_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Stream of Parquet files that hold change records; a batch takes some files or bytes at most.

    A file is read by one task per row group at most. With `min_partitions` the records are
    dealt to that many tasks, so that a few large files do not become a few long ones.
    """
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    records = reader.parquet(path)
    return records.repartition(min_partitions, "topic", "partition", "offset") if min_partitions else records


def publish_to_topic(servers: str):
    """A dead-letter publisher for `apply_records`: writes key and payload to the topic."""
    def publish(letters: DataFrame) -> None:
        letters.select(
            F.col("dead_letter_id").alias("key"), F.col("payload").alias("value")
        ).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
            "topic", DEAD_LETTER_TOPIC
        ).save()

    return publish


def publish_to_files(path: str):
    """The same publisher over files, for runs without a broker."""
    def publish(letters: DataFrame) -> None:
        letters.select(
            F.col("dead_letter_id").alias("key"), F.col("payload").alias("value")
        ).write.mode("append").parquet(path)

    return publish

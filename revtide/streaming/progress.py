"""What running streams report of themselves, as a table."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from revtide.session import work_folder
from revtide.sources import folders

PROGRESS = ("query_id string, run_id string, epoch long, source string, start_offset string, end_offset string, "
            "latest_offset string, input_rows long, at string")
NAMES = [column.split()[0] for column in PROGRESS.split(", ")]


class ProgressTable(StreamingQueryListener):
    """A row per epoch and source of every stream of the session, in small JSON files.

    Rows are written in files of `every` rows and when a stream ends; `flush` writes what is
    held. Register it with `spark.streams.addListener`.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, every: int = 100) -> None:
        self.spark = spark
        self.path = path or work_folder(spark, "progress")
        self.every = every
        self.held: list[dict] = []
        self.files = 0
        self.ended: set[str] = set()  # runs

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.held += [
            dict(zip(NAMES, (str(p.id), str(p.runId), p.batchId, s.description, s.startOffset, s.endOffset, s.latestOffset, s.numInputRows, p.timestamp)))
            for s in p.sources
        ]
        if len(self.held) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.flush()
        self.ended.add(str(event.runId))

    def wait(self, run_id, seconds: float = 30) -> None:
        """Until the end of a run is known here; Spark tells it some time after the run has ended."""
        until = time.monotonic() + seconds
        while str(run_id) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end of run {run_id} after {seconds} s")
            time.sleep(0.05)

    def flush(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.files += 1
            name = f"{rows[0]['run_id']}-{rows[0]['epoch']}-{self.files}.json"
            folders.create_text(self.spark, f"{self.path}/{name}", "\n".join(map(json.dumps, rows)))

    def table(self) -> DataFrame:
        """What has been written so far; empty before the first file."""
        if not folders.names(self.spark, self.path):
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).json(f"{self.path}/*.json")


def broker_ends(progress: DataFrame) -> DataFrame:
    """The newest known end of each topic partition, from the latest offsets of broker sources."""
    ends = F.from_json("latest_offset", "map<string,map<string,long>>")
    partitions = progress.select(F.explode(ends).alias("topic", "ends")).select("topic", F.explode("ends").alias("partition_id", "end_offset"))
    return partitions.groupBy("topic", F.col("partition_id").cast("long").alias("partition_id")).agg(F.max("end_offset").alias("end_offset"))


def rows_read(progress: DataFrame) -> DataFrame:
    """Epochs and input rows per query and run; one row each."""
    return progress.groupBy("query_id", "run_id").agg(F.count_distinct("epoch").alias("epochs"), F.sum("input_rows").alias("input_rows"))

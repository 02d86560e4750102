"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on; safe to set on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Generated methods above this size are never compiled by the JVM.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python call site of every expression slows plan building down.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark, with a checkpoint folder of its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("revtide")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the folder that all executors share.

    That is `spark.checkpoint.dir`; where it is unset, the warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/work"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: what is used twice runs once."""
    folder = work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when it ends.

    Otherwise they stay until the driver collects its garbage, and a run of many large jobs
    holds those of all. A query that is run again makes them again.
    """
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def side_by_side(spark: SparkSession, work: Callable, items: Iterable) -> list:
    """Run independent Spark jobs at the same time; results in the order of the items.

    Meant for one job per table: small tables then do not wait for large ones.
    """
    items = list(items)
    if len(items) < 2:
        return [work(item) for item in items]
    with ThreadPoolExecutor(len(items)) as pool:
        run = inheritable_thread_target(spark)(work)
        return list(pool.map(run, items))

"""What the operators share: session settings, written tables, word rules."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.session import configure, work_folder

#: Rows that go to a Python worker at once. Documents may be long, so few.
ARROW_ROWS = "256"
#: The words of a text are runs of anything but these characters.
SPACES = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for this kind of work. They stay set: the frames are lazy and need them later."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again, which cuts the lineage.

    A lost executor then costs a read of the table, not a second run of what made it.
    """
    spark = df.sparkSession
    folder = work_folder(spark, label)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def unused_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def smallest_hashes(df: DataFrame, n: int, id_column: str, *ties, seed: int | None = None) -> DataFrame:
    """At most n rows, those whose ids hash lowest: a bounded sample that is the same in reruns.

    Most rows are left out by their hash alone, about 4 n stay, so that no partition sends
    its own n rows to the task that picks the last ones.
    """
    value = F.xxhash64(id_column) if seed is None else F.xxhash64(F.lit(seed), id_column)
    rows = df.count()
    few = df.filter(value < -(1 << 63) + (1 << 64) * 4 * n // rows) if rows > 4 * n else df
    return few.orderBy(value, id_column, *ties).limit(n)


def native_words(text: Column) -> Column:
    """The words of a text as an array; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null gives none."""
    return [value or b"" for value in pc.cast(column, pa.binary()).to_pylist()]


def table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

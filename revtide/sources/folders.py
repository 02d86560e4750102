"""Small file operations on whatever file system holds a path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with what it holds."""
    target, fs = _path(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder is missing."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a small file under a name nobody else has taken.

    The text is complete before the name appears. False means another writer
    took the name first.
    """
    target, fs = _path(spark, path)
    if fs.exists(target):
        return False
    draft, _ = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return fs.rename(draft, target)

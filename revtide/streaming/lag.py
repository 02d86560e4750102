"""Lag and replay reports over landed tables and offsets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def landing_lag(changes: DataFrame, table: str) -> DataFrame:
    """Rows, newest source time, newest load time and their distance; one row."""
    newest = changes.agg(
        F.lit(table).alias("table_name"), F.count("*").alias("n_rows"),
        F.max("_source_ts").alias("max_source_ts"), F.max("_loaded_at").alias("max_loaded_at"),
    )
    distance = F.timestamp_diff("SECOND", F.col("max_source_ts"), F.col("max_loaded_at"))
    return newest.withColumn("lag_seconds", distance)


def broker_lag(committed: DataFrame, ends: DataFrame) -> DataFrame:
    """End offset less committed offset per topic partition; a missing end counts as 0."""
    keys = ["topic", "partition_id"]
    joined = committed.join(ends.select(*keys, "end_offset"), keys, "left")
    end = F.coalesce("end_offset", F.lit(0))
    return joined.select(
        *keys, "committed_offset", end.alias("end_offset"), (end - F.col("committed_offset")).alias("lag")
    )


def lag_report(
    landed: dict[str, DataFrame], committed: DataFrame, ends: DataFrame
) -> tuple[DataFrame, DataFrame]:
    tables = [landing_lag(df, name) for name, df in landed.items()]
    return reduce(DataFrame.unionByName, tables), broker_lag(committed, ends)


def landing_signature(changes: DataFrame, pk: str) -> DataFrame:
    """Row count and a digest of the multiset of (key, token) pairs, in any order; one row.

    The digest is two sums of 60 bits of each pair's md5, so a pair that comes twice does not
    cancel out, and other rows of the same number give other sums.
    """
    pair = F.md5(F.concat_ws("|", F.coalesce(F.col(pk).cast("string"), F.lit("")), F.coalesce("_dedup_token", F.lit(""))))
    sums = [F.coalesce(F.sum(F.conv(F.substring(pair, at, 15), 16, 10).cast("decimal(28,0)")), F.lit(0)).cast("string") for at in (1, 16)]
    return changes.agg(F.count("*").alias("n_rows"), F.concat_ws(":", *sums).alias("digest"))


def assert_replay_safe(before: DataFrame, after: DataFrame, pk: str) -> DataFrame:
    """(key, token) pairs whose number of rows differs between two landings."""
    def counted(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.col(pk).cast("string").alias("pk_value"), "_dedup_token",
                         F.lit(side).alias("side"))

    both = counted(before, 1).unionByName(counted(after, -1))
    return both.groupBy("pk_value", "_dedup_token").agg(F.sum("side").alias("surplus")).filter(
        "surplus <> 0"
    )

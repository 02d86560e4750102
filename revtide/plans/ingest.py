"""One batch run: scan the sources, stamp the rows and load all tables together."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.contracts import ENTITIES, STATE_COLUMNS, raw_schema, struct_of
from revtide.operators.upsert import LAID_OUT_DAY, incremental_scan, ingest_state, normalize, stamp
from revtide.session import side_by_side
from revtide.sources.lake import Lake

STATE = "_ingest_state"


def read_contract(spark, table: str, path: str) -> DataFrame:
    """The contract's columns of a Parquet source."""
    return spark.read.parquet(path).select(*ENTITIES[table].column_names)


def lay_out(df: DataFrame, table: str, path: str, files: int) -> None:
    """Write a source so that the lookback scan opens little of it.

    Files are ranges of the watermark, sorted by it, with its day as a date: Parquet footers
    rule files out by dates, not by times without a zone. `incremental_scan` uses the day.
    """
    mark = ENTITIES[table].watermark
    laid = df.withColumn(LAID_OUT_DAY, F.col(mark).cast("date")).repartitionByRange(files, mark)
    laid.sortWithinPartitions(mark).write.parquet(path)


def split_points(sample: DataFrame, key: str, parts: int) -> list:
    """Keys that cut a sample into parts of about equal size; at most parts - 1 values."""
    spread = sample.select(key).filter(F.col(key).isNotNull()).repartitionByRange(parts, key)
    starts = spread.groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("start")).orderBy("part").collect()
    return [row["start"] for row in starts][1:]


def split_predicates(key: str, points: list) -> list[str]:
    """Conditions that each row meets exactly one of; null keys meet the first."""
    def literal(value) -> str:
        if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
            return str(value)
        return "'" + str(value).replace("'", "''") + "'"

    points = sorted(set(points))
    if not points:
        return ["1 = 1"]
    cuts = [literal(p) for p in points]
    inside = [f"{key} >= {low} and {key} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} or {key} is null", *inside, f"{key} >= {cuts[-1]}"]


def read_contract_jdbc(spark, table: str, options: dict, points: list | None = None, whole: bool = False) -> DataFrame:
    """The same from a database; filters and columns are pushed to the server.

    A table is read in parallel: by `points`, keys that cut it (`split_points` of a sample),
    or by `partitionColumn`, `lowerBound`, `upperBound` and `numPartitions` in the options.
    One task for all of it has to be asked for with `whole`.
    """
    entity = ENTITIES[table]
    source = {"dbtable": f"app.{table}", **options}
    if points:
        rest = {k: v for k, v in source.items() if k not in ("url", "dbtable")}
        rows = spark.read.jdbc(source["url"], source["dbtable"], predicates=split_predicates(entity.pk, points), properties=rest)
    elif whole or "partitionColumn" in options:
        rows = spark.read.format("jdbc").options(**source).load()
    else:
        raise ValueError(f"{table} would be read by one task: give points or partition options")
    return rows.select(*entity.column_names)


def ensure_tables(lake: Lake) -> None:
    """Register every raw table that has no data yet, so that reads see it empty."""
    known = lake.segments(STATE)
    missing = {f"raw.{t}": [] for t in ENTITIES if not lake.segments(f"raw.{t}")}
    if missing or not known:
        lake.commit({**missing, STATE: known})


def read_watermarks(lake: Lake) -> dict[str, datetime | None]:
    """Stored watermark per table; one row per contract table."""
    rows = lake.read(STATE, struct_of(STATE_COLUMNS)).select("table_name", "watermark").collect()
    return {row["table_name"]: row["watermark"] for row in rows}


def raw_table(lake: Lake, table: str) -> DataFrame:
    return lake.read(f"raw.{table}", raw_schema(table))


def ingest(
    lake: Lake, source: Callable[[str], DataFrame], full_refresh: bool = False,
    now: datetime | None = None,
) -> str:
    """Load all six tables in one commit; returns the batch id.

    `source` gives the application frame of a table. Full-mode tables are
    replaced, the others merged from the stored watermark less the lookback.
    """
    started = lake.version()
    marks = {} if full_refresh else read_watermarks(lake)
    now = now or datetime.now(UTC).replace(tzinfo=None)
    batch_id = now.strftime("%Y%m%dT%H%M%SZ") + "-" + uuid.uuid4().hex[:8]
    staged: dict[str, list[str]] = {}

    def load(table: str) -> DataFrame:
        entity, name, schema = ENTITIES[table], f"raw.{table}", raw_schema(table)
        rows = incremental_scan(
            normalize(source(table), table), table, marks.get(table), full_refresh=full_refresh
        )
        stamped = stamp(rows, batch_id, now).select(*schema.names)
        replaced = full_refresh or entity.mode == "full"
        if entity.mode == "full":
            staged[name] = lake.replace(name, stamped)
        elif full_refresh:
            staged[name] = lake.replace_keyed(name, stamped, entity.pk, [entity.watermark])
        else:
            staged[name] = lake.upsert(name, stamped, entity.pk, schema, [entity.watermark])
        loaded = lake.read(name, schema, staged[name])
        return ingest_state(loaded, table, "full" if replaced else "upsert", now)

    states = side_by_side(lake.spark, load, ENTITIES)
    state = reduce(DataFrame.unionByName, states).coalesce(1)
    staged[STATE] = lake.replace(STATE, state)
    lake.commit(staged, based_on=started)
    return batch_id

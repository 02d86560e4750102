"""Entity contracts: column names, types, keys and load modes.

The names and types below are fixed values: they are the interface of the
source application and of the tables that reports read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# The closed list of contract types and their Spark types.
SPARK_TYPES = {
    "varchar": T.StringType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}

LOOKBACK_DAYS = 2
LATE_DAYS = 2
BATCH_SOURCE = "postgres_batch"
STREAM_SOURCE = "debezium"
TOPIC_PREFIX = "saas.app."
DEAD_LETTER_TOPIC = "saas.dead_letter"
CONSUMER_GROUP = "saas-cdc-consumer"

# Catalog price per plan, in cents.
PLAN_PRICE_CENTS = {"trial": 0, "starter": 4900, "growth": 19900, "enterprise": 99900}

# Display order of plans and revenue movements.
PLAN_ORDER = ["enterprise", "growth", "starter", "trial"]
MOVEMENT_ORDER = ["new", "expansion", "reactivation", "contraction", "churn"]


@dataclass(frozen=True)
class Entity:
    name: str
    pk: str
    mode: str
    watermark: str
    columns: tuple[tuple[str, str], ...]

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def topic(self) -> str:
        return TOPIC_PREFIX + self.name


# The six source tables. The first column is the primary key.
ENTITIES: dict[str, Entity] = {
    "organizations": Entity(
        "organizations", "org_id", "full", "updated_at",
        (
            ("org_id", "varchar"),
            ("name", "varchar"),
            ("domain", "varchar"),
            ("industry", "varchar"),
            ("employee_band", "varchar"),
            ("country_code", "varchar"),
            ("status", "varchar"),
            ("created_at", "timestamp"),
            ("updated_at", "timestamp"),
        ),
    ),
    "users": Entity(
        "users", "user_id", "full", "updated_at",
        (
            ("user_id", "varchar"),
            ("org_id", "varchar"),
            ("email", "varchar"),
            ("full_name", "varchar"),
            ("role", "varchar"),
            ("status", "varchar"),
            ("created_at", "timestamp"),
            ("updated_at", "timestamp"),
        ),
    ),
    "subscriptions": Entity(
        "subscriptions", "subscription_id", "full", "updated_at",
        (
            ("subscription_id", "varchar"),
            ("org_id", "varchar"),
            ("plan", "varchar"),
            ("status", "varchar"),
            ("mrr_cents", "bigint"),
            ("seats", "bigint"),
            ("started_at", "timestamp"),
            ("canceled_at", "timestamp"),
            ("updated_at", "timestamp"),
        ),
    ),
    "logins": Entity(
        "logins", "login_id", "upsert", "recorded_at",
        (
            ("login_id", "varchar"),
            ("client_event_id", "varchar"),
            ("user_id", "varchar"),
            ("org_id", "varchar"),
            ("idp", "varchar"),
            ("success", "boolean"),
            ("ip_country", "varchar"),
            ("logged_in_at", "timestamp"),
            ("recorded_at", "timestamp"),
        ),
    ),
    "subscription_events": Entity(
        "subscription_events", "event_id", "upsert", "recorded_at",
        (
            ("event_id", "varchar"),
            ("subscription_id", "varchar"),
            ("org_id", "varchar"),
            ("event_type", "varchar"),
            ("from_plan", "varchar"),
            ("to_plan", "varchar"),
            ("mrr_cents_before", "bigint"),
            ("mrr_cents_after", "bigint"),
            ("occurred_at", "timestamp"),
            ("recorded_at", "timestamp"),
        ),
    ),
    "invoices": Entity(
        "invoices", "invoice_id", "upsert", "recorded_at",
        (
            ("invoice_id", "varchar"),
            ("org_id", "varchar"),
            ("subscription_id", "varchar"),
            ("amount_cents", "bigint"),
            ("currency", "varchar"),
            ("status", "varchar"),
            ("period_start", "date"),
            ("period_end", "date"),
            ("issued_at", "timestamp"),
            ("paid_at", "timestamp"),
            ("recorded_at", "timestamp"),
        ),
    ),
}

# Columns that loads and the stream add to every row.
LOAD_COLUMNS = (("_loaded_at", "timestamp"), ("_batch_id", "varchar"), ("_source_system", "varchar"))
CHANGE_COLUMNS = (
    ("_op", "varchar"),
    ("_source_lsn", "bigint"),
    ("_kafka_topic", "varchar"),
    ("_kafka_partition", "bigint"),
    ("_kafka_offset", "bigint"),
    ("_source_ts", "timestamp"),
    ("_deleted", "boolean"),
    ("_dedup_token", "varchar"),
    ("_extra", "varchar"),
) + LOAD_COLUMNS

DEAD_LETTER_COLUMNS = (
    ("dead_letter_id", "varchar"),
    ("topic", "varchar"),
    ("partition_id", "bigint"),
    ("offset_id", "bigint"),
    ("error", "varchar"),
    ("payload", "varchar"),
    ("_loaded_at", "timestamp"),
    ("_source_system", "varchar"),
)
OFFSET_COLUMNS = (
    ("consumer_group", "varchar"),
    ("topic", "varchar"),
    ("partition_id", "bigint"),
    ("committed_offset", "bigint"),
    ("updated_at", "timestamp"),
)
STATE_COLUMNS = (
    ("table_name", "varchar"),
    ("watermark", "timestamp"),
    ("rows_loaded", "bigint"),
    ("load_mode", "varchar"),
    ("updated_at", "timestamp"),
)
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)


def struct_of(columns) -> T.StructType:
    return T.StructType([T.StructField(name, SPARK_TYPES[typ]) for name, typ in columns])


def raw_schema(table: str) -> T.StructType:
    return struct_of(ENTITIES[table].columns + LOAD_COLUMNS)


def change_schema(table: str, promoted: dict | None = None) -> T.StructType:
    extra = tuple(promoted_columns(promoted, table))
    return struct_of(ENTITIES[table].columns + extra + CHANGE_COLUMNS)


def promoted_columns(config: dict | None, table: str) -> list[tuple[str, str]]:
    """Extra typed columns configured for a change table, checked before use."""
    columns = (config or {}).get(table, {})
    if not isinstance(columns, dict):
        raise ValueError(f"promoted columns of {table} are not a mapping")
    for name, typ in columns.items():
        if not re.fullmatch(r"[a-z_][a-z0-9_]*", str(name)) or typ not in SPARK_TYPES:
            raise ValueError(f"promoted column {name}:{typ} is not allowed")
    return list(columns.items())

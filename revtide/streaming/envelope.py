"""Change envelopes to change rows and dead letters, as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revtide.contracts import ENTITIES, STREAM_SOURCE, TOPIC_PREFIX, promoted_columns
from revtide.functions import envelope as E

ENVELOPE = "struct<op:variant,before:variant,after:variant,source:variant>"
SQL_TYPES = {"varchar": "string", "timestamp": "timestamp_ntz"}


def with_table(records: DataFrame) -> DataFrame:
    """Decode the records and name the table of each topic (null: not a change topic)."""
    return records.selectExpr(
        "topic", "cast(partition as bigint) as partition", "offset",
        "cast(key as string) as key", "cast(value as string) as value",
        "coalesce(is_valid_utf8(cast(key as string)), true) "
        "and coalesce(is_valid_utf8(cast(value as string)), true) as _readable",
        f"{E.table_from_topic('topic', TOPIC_PREFIX, ENTITIES)} as _table",
    )


def _first_reason(checks: list[tuple[str, str]]) -> str:
    """The reason of the first failing check; null when none fails."""
    return "case " + " ".join(f"when {test} then {reason}" for test, reason in checks) + " end"


def parse_envelopes(records: DataFrame, table: str, promoted: dict | None = None) -> DataFrame:
    """Parse the records of one table (columns of `with_table`).

    Every record gives one row: the typed change columns, and `error` with the
    first reason that makes it a dead letter. The heavy parts (JSON parse,
    field map, conversions) each live in their own step so Spark computes
    them once per row. Persist the result before filtering it, or the filter
    is pushed down and repeats them.
    """
    pk, kinds = ENTITIES[table].pk, dict(ENTITIES[table].columns)
    kinds |= dict(promoted_columns(promoted, table))
    known = list(kinds)
    pk_type = SQL_TYPES.get(kinds[pk], kinds[pk])
    place = ["topic", "partition", "offset", "key", "value", "_readable"]

    opened = records.selectExpr(*place, f"{E.parse_one('value', ENVELOPE)} as _body").selectExpr(
        *place, "_body is null as _no_body", "_body.source as _source",
        "case when value is null then 'd' else try_cast(_body.op as string) end as _op",
        "_body.before as _before", "_body.after as _after",
    )
    imaged = opened.selectExpr(
        *place, "_no_body", "_source", "_op", "if(_op = 'd', _before, _after) as _image"
    )
    read = imaged.selectExpr(
        "*", f"{E.fields_of('_source')} is null as _no_source",
        f"{E.fields_of('_image')} as _fields", f"{E.text_at('_source', 'lsn')} as _t_lsn",
        f"{E.text_at('_source', 'ts_ms')} as _t_ts_ms",
        *[f"{E.text_at('_image', name)} as _t_{name}" for name in known],
    )
    # The record key matters only where the image has no primary key.
    keyed = read.selectExpr("*", f"if(_t_{pk} is null, {E.parse_one('key', 'variant')}, null) as _key_json")
    typed = keyed.selectExpr(
        "*", f"if(_t_{pk} is null, {E.pk_from_key('key', '_key_json', pk)}, null) as _key_pk",
        f"{E.bigint_of('_source', 'lsn', '_t_lsn')} as _source_lsn",
        f"{E.ts_of('_source', 'ts_ms', '_t_ts_ms')} as _source_ts",
        *[f"{E.CONVERSIONS[typ]('_image', name, f'_t_{name}')} as {name}"
          for name, typ in kinds.items()],
    )

    def broken(text: str, converted: str) -> str:
        return f"{text} is not null and {converted} is null"

    pk_value = f"coalesce({pk}, try_cast(_key_pk as {pk_type}))"
    not_json = (f"if({E.parse_one('value', 'variant')} is null, 'no single json value in the payload', "
                "'json payload holds no object')")
    checks = [
        ("not _readable", "'bytes do not decode as utf-8'"),
        ("value is null and _key_pk is null", f"'tombstone without {pk} in its key'"),
        ("value is not null and _no_body", not_json),
        (f"_op is null or _op not in ({E.listed(E.OPS)})", "'op is none of c, u, d, r'"),
        ("value is not null and _no_source", "'no source block'"),
        ("value is not null and _fields is null", "'no row image for this op'"),
        (broken("_t_lsn", "_source_lsn"), "'lsn does not read as a whole number'"),
        (broken("_t_ts_ms", "_source_ts"), "'ts_ms does not read as a time'"),
        # Every JSON value has a text, so a text column cannot fail.
        *[(broken(f"_t_{name}", name), f"'value of {name} does not read as {typ}'")
          for name, typ in kinds.items() if typ != "varchar"],
        (f"{pk_value} is null", f"'no value for key {pk}'"),
    ]
    where = ("topic", "partition", "offset")
    return typed.selectExpr(
        *[f"{pk_value} as {name}" if name == pk else name for name in known],
        "_op", "_source_lsn", "topic as _kafka_topic", "partition as _kafka_partition",
        "offset as _kafka_offset", "_source_ts", "_op = 'd' as _deleted",
        f"{E.dedup_token('_source_lsn', *where)} as _dedup_token",
        f"{E.extra_json('_fields', known)} as _extra",
        f"{E.quoted(STREAM_SOURCE)} as _source_system",
        f"{_first_reason(checks)} as error", f"{E.payload('key', 'value')} as payload",
    )


def reject_unknown(records: DataFrame) -> DataFrame:
    """Records of topics outside the contract, in the columns dead letters need."""
    return records.filter("_table is null").selectExpr(
        "topic as _kafka_topic", "partition as _kafka_partition", "offset as _kafka_offset",
        "concat('topic ', topic, ' has no table') as error",
        f"{E.payload('key', 'value')} as payload",
    )


def as_dead_letters(rejected: DataFrame, loaded_at) -> DataFrame:
    where = ("_kafka_topic", "_kafka_partition", "_kafka_offset")
    return rejected.filter("error is not null").selectExpr(
        f"{E.dead_letter_id(*where)} as dead_letter_id", "_kafka_topic as topic",
        "_kafka_partition as partition_id", "_kafka_offset as offset_id", "error", "payload",
        f"timestamp_ntz'{loaded_at}' as _loaded_at", f"{E.quoted(STREAM_SOURCE)} as _source_system",
    )

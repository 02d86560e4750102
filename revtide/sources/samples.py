"""The six entities and their change tables, derived from the driver's tables.

The driver's tables hold no subscription data, so orders stand in for
subscription events and invoices, customers for organizations and events for
logins and change records. Every expression is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.contracts import BATCH_SOURCE, ENTITIES, STREAM_SOURCE, TOPIC_PREFIX
from revtide.operators.current import first_per_key

# Load times of the full-mode snapshots, and the cut-off dates of the history runs.
SNAPSHOT_AT = "timestamp_ntz'2024-01-30 12:00:00'"
SUBSCRIPTIONS_AT = "1999-01-01 00:00:00"
HISTORY_CUTS = ["1997-01-01", "1999-01-01", "2002-01-01"]

MRR = "if(o_orderstatus = 'F', 0L, cast(round(o_totalprice * 100) as bigint))"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _loaded(df: DataFrame, at: str) -> DataFrame:
    return df.selectExpr(
        "*", f"{at} as _loaded_at", "'batch-1' as _batch_id",
        f"'{BATCH_SOURCE}' as _source_system",
    )


def _changed(df: DataFrame, table: str, offset: str, at: str, op: str) -> DataFrame:
    """The table's columns and the change-table columns; the log position follows the offset."""
    return df.selectExpr(
        *ENTITIES[table].column_names, f"{op} as _op", f"{offset} * 10 as _source_lsn",
        f"{offset} as _kafka_offset", f"{at} as _source_ts", f"{op} = 'd' as _deleted",
        f"concat('lsn:', {offset} * 10, ':offset:', {offset}) as _dedup_token",
        "cast(null as string) as _extra", f"{at} + interval 1 day as _loaded_at",
        "'stream-1' as _batch_id", f"'{STREAM_SOURCE}' as _source_system",
    )


def _plan(cents: str) -> str:
    return f"""case when {cents} = 0 then 'trial' when {cents} < 15000000 then 'starter'
        when {cents} < 35000000 then 'growth' else 'enterprise' end"""



def subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as subscription events, with the amount before each event.

    The previous amount is a lag per organization in event order. A hot
    organization is cut into days: the lag runs inside a day, and what a day
    inherits comes from a window over one row per organization and day.
    """
    base = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as event_id", "o_custkey as org_id", "o_orderdate as occurred_at",
        "to_date(o_orderdate) as _day", f"{MRR} as mrr_cents_after",
    )
    per_day = base.groupBy("org_id", "_day").agg(
        F.expr("max_by(mrr_cents_after, struct(occurred_at, event_id)) as _last"),
        F.max("mrr_cents_after").alias("_top"),
    )
    by_org = "over (partition by org_id order by _day"
    inherited = per_day.selectExpr(
        "org_id", "_day", f"coalesce(lag(_last) {by_org}), 0) as _inherited",
        f"coalesce(max(_top) {by_org} rows between unbounded preceding and 1 preceding), 0) "
        "as _earlier_top",
    )
    in_day = "over (partition by org_id, _day order by occurred_at, event_id"
    events = base.selectExpr(
        "*", f"lag(mrr_cents_after) {in_day}) as _before",
        f"coalesce(max(mrr_cents_after) {in_day} rows between unbounded preceding "
        "and 1 preceding), 0) as _day_top",
    ).join(inherited, ["org_id", "_day"])
    shaped = events.selectExpr(
        "*", "coalesce(_before, _inherited) as mrr_cents_before"
    ).selectExpr(
        "event_id", "org_id as subscription_id", "org_id",
        """case when greatest(_day_top, _earlier_top) <= 0 then 'created'
            when mrr_cents_after = 0 and mrr_cents_before > 0 then 'canceled'
            when mrr_cents_before = 0 and mrr_cents_after > 0 then 'reactivated'
            when mrr_cents_after > mrr_cents_before then 'upgraded'
            else 'downgraded' end as event_type""",
        f"if(mrr_cents_before > 0, {_plan('mrr_cents_before')}, null) as from_plan",
        f"{_plan('mrr_cents_after')} as to_plan", "mrr_cents_before", "mrr_cents_after",
        "occurred_at",
        "occurred_at + make_dt_interval(cast(event_id % 5 as int)) as recorded_at",
    )
    return _loaded(shaped, "recorded_at")


def subscription_events_cdc(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Every event once more as a snapshot read, three days after it happened."""
    events = subscription_events(spark, sf_dir) if events is None else events
    return _changed(events, "subscription_events", "event_id", "(occurred_at + interval 3 days)", "'r'")



def _subscription_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subscription as each order leaves it."""
    return table(spark, sf_dir, "orders").selectExpr("*", f"{MRR} as mrr_cents").selectExpr(
        "o_custkey as subscription_id", "o_custkey as org_id",
        f"if(o_orderkey % 33 = 0, upper({_plan('mrr_cents')}), "
        f"concat(' ', {_plan('mrr_cents')})) as plan",
        """case when mrr_cents = 0 then if(o_custkey % 11 = 0, 'trialing', 'canceled')
            when o_custkey % 13 = 0 then 'past_due' else 'Active' end as status""",
        "mrr_cents", "o_custkey % 40 + 1 as seats", "timestamp_ntz'1994-01-01' as started_at",
        """if(mrr_cents = 0 and o_custkey % 11 <> 0 and o_custkey % 20 <> 0, o_orderdate, null)
            as canceled_at""",
        "o_orderdate as updated_at", "o_orderkey",
    )


def subscriptions_at(spark: SparkSession, sf_dir: str, cut: str) -> DataFrame:
    """Latest subscription row per organization before a cut-off time."""
    rows = _subscription_rows(spark, sf_dir).filter(f"updated_at < timestamp_ntz'{cut}'")
    latest = first_per_key(
        rows, ["subscription_id"], [F.desc("updated_at"), F.desc("o_orderkey")]
    )
    return _loaded(latest.drop("o_orderkey"), f"timestamp_ntz'{cut}'")


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscriptions_at(spark, sf_dir, SUBSCRIPTIONS_AT)


def subscriptions_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an update of its subscription; offsets follow order time."""
    offset = "(datediff(updated_at, date'1990-01-01') * 10000000000 + o_orderkey)"
    rows = _subscription_rows(spark, sf_dir)
    return _changed(rows, "subscriptions", offset, "updated_at", "'u'")



def _invoice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as invoice_id", "o_custkey as org_id", "o_custkey as subscription_id",
        "cast(round(o_totalprice * 100) as bigint) as amount_cents",
        """case when o_orderkey % 50 = 0 then 'gbp' when o_orderkey % 10 = 0 then 'GBP'
            else 'USD' end as currency""",
        "case o_orderstatus when 'F' then 'Paid' when 'O' then 'Open' else 'Void' end as status",
        "trunc(o_orderdate, 'month') as period_start", "last_day(o_orderdate) as period_end",
        "o_orderdate as issued_at",
        """if(o_orderstatus = 'F' and o_orderkey % 33 <> 0, o_orderdate + interval 5 days, null)
            as paid_at""",
        "o_orderdate + make_dt_interval(cast(o_orderkey % 5 as int)) as recorded_at",
        "o_orderpriority",
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(_invoice_rows(spark, sf_dir).drop("o_orderpriority"), "recorded_at")


def invoices_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice again three days after issue; low-priority ones are deleted."""
    return _changed(
        _invoice_rows(spark, sf_dir), "invoices", "invoice_id",
        "(issued_at + interval 3 days)", "if(o_orderpriority = '5-LOW', 'd', 'u')",
    )


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as org_id", "c_name as name", "concat('c', c_custkey, '.example') as domain",
        "lower(c_mktsegment) as industry",
        "if(c_nationkey < 12, '11-50', '51-200') as employee_band",
        "lpad(string(c_nationkey), 2, '0') as country_code",
        "if(c_acctbal < 0, 'CHURNED', 'Active') as status",
        "timestamp_ntz'2023-01-01' + make_dt_interval(int(c_custkey % 365)) as created_at",
        "timestamp_ntz'2023-01-01' + make_dt_interval(int(c_custkey % 365 + c_custkey % 30)) "
        "as updated_at",
    )
    return _loaded(rows, SNAPSHOT_AT)


def organizations_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change of the organization with the user's number."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "user_id as org_id", "concat('Org ', event_id) as name",
        "concat('u', user_id, '.example') as domain", "event_type as industry",
        "'1-10' as employee_band", "'US' as country_code", "'ACTIVE' as status",
        "timestamp_ntz'2023-01-01' as created_at", "ts as updated_at", "event_id",
    )
    return _changed(rows, "organizations", "event_id", "updated_at", "if(industry = 'error', 'd', 'u')")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users seen in events; every 37th is unknown to the application."""
    seen = table(spark, sf_dir, "events").select("user_id").distinct()
    rows = seen.filter("user_id % 37 <> 0").selectExpr(
        "user_id", "user_id as org_id",
        "if(user_id % 25 <> 0, concat('u', user_id, '@mail.example'), null) as email",
        "concat('User ', user_id) as full_name",
        "case user_id % 3 when 0 then 'Owner' when 1 then 'Admin' else 'Member' end as role",
        "if(user_id % 7 = 0, 'Deactivated', 'Active') as status",
        "timestamp_ntz'2023-06-01' as created_at", "timestamp_ntz'2023-12-01' as updated_at",
    )
    return _loaded(rows, SNAPSHOT_AT)


def users_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a known user as an update of that user."""
    rows = table(spark, sf_dir, "events").filter("user_id % 37 <> 0").selectExpr(
        "user_id", "user_id as org_id",
        "if(user_id % 25 <> 0, concat('e', event_id, '@mail.example'), null) as email",
        "concat('User ', user_id) as full_name", "'MEMBER' as role",
        "if(event_type = 'error', 'deactivated', 'active') as status",
        "timestamp_ntz'2023-06-01' as created_at", "ts as updated_at", "event_id",
    )
    return _changed(rows, "users", "event_id", "updated_at", "'u'")



def _login_rows(spark: SparkSession, sf_dir: str, country: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as login_id",
        "if(event_id % 50 = 1, event_id - 1, event_id) as client_event_id", "user_id",
        "user_id as org_id",
        """case event_id % 5 when 0 then 'Okta' when 1 then 'azure_ad'
            when 2 then 'google_workspace' when 3 then 'onelogin' end as idp""",
        "if(event_type <> 'view', event_type <> 'error', null) as success",
        f"'{country}' as ip_country", "ts as logged_in_at",
        "ts + make_dt_interval(int(event_id % 4)) as recorded_at",
    )


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(_login_rows(spark, sf_dir, "US"), "recorded_at")


def logins_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every login again as a change at login time, seen from another country."""
    rows = _login_rows(spark, sf_dir, "DE")
    return _changed(rows, "logins", "login_id", "logged_in_at", "'c'").withColumn(
        "_loaded_at", F.col("recorded_at")
    )


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change records, every event one record.

    Even users go to the organizations topic, odd ones to the users topic.
    Clicks create, purchases update and carry a field outside the contract,
    errors delete, signups are tombstones and views are broken payloads.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        "*", "user_id % 2 = 0 as _org", "cast(user_id as string) as _key",
        "unix_millis(to_utc_timestamp(cast(ts as string), 'UTC')) as _ms",
    )
    image = """named_struct('org_id', _key, 'user_id', if(_org, null, _key),
      'name', if(_org, concat('Name ', event_id), null),
      'full_name', if(_org, null, concat('Name ', event_id)), 'status', event_type,
      'updated_at', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
      'plan_note', if(event_type = 'purchase', concat('note ', event_id), null))"""
    op = "case event_type when 'click' then 'c' when 'purchase' then 'u' else 'd' end"
    body = f"""to_json(named_struct('op', {op},
      'before', if(event_type = 'error', {image}, null),
      'after', if(event_type = 'error', null, {image}),
      'source', named_struct('lsn', event_id * 10, 'ts_ms', _ms)))"""
    return events.selectExpr(
        "concat('saas.app.', if(_org, 'organizations', 'users')) as topic",
        "cast(user_id % 3 as int) as partition", "event_id as offset",
        "cast(if(_org, concat('{\"org_id\":\"', _key, '\"}'), _key) as binary) as key",
        f"""cast(case event_type when 'signup' then null when 'view' then concat('broken ', event_id)
          else {body} end as binary) as value""",
    )


def _json_value(name: str, typ: str) -> str:
    """A column as a JSON value, in several of the forms that a feed may use; null where it is null."""
    text = f"""concat('"', cast({name} as string), '"')"""
    seconds = f"unix_seconds(to_utc_timestamp(cast({name} as string), 'UTC'))"
    return {
        "varchar": text,
        "bigint": f"if(_kafka_offset % 2 = 0, cast({name} as string), {text})",
        "boolean": f"case when {name} is null then null when _kafka_offset % 3 = 0 then cast({name} as string) when _kafka_offset % 3 = 1 then if({name}, '\"T\"', '\"no\"') else if({name}, '1', '0') end",
        "timestamp": f"""case _kafka_offset % 3 when 0 then concat('"', date_format({name}, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '"')
          when 1 then if({seconds} = 0, '0', concat(cast({seconds} as string), '000')) else cast({seconds} as string) end""",
        "date": f"if(_kafka_offset % 2 = 0, cast(unix_date({name}) as string), {text})",
    }[typ]


def entity_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The change table of an entity as the change records that it came from.

    Numbers, booleans, times and dates come in the forms that records may have them in:
    as JSON numbers or texts, in milliseconds, seconds or ISO form, as days since 1970.
    """
    fields = ", ".join(f"""concat('"{c}":', {_json_value(c, typ)})""" for c, typ in ENTITIES[name].columns)
    image = f"concat('{{', concat_ws(',', {fields}), '}}')"
    body = f"""concat('{{"op":"', _op, '","', if(_op = 'd', 'before', 'after'), '":', {image},
      ',"source":{{"lsn":', _source_lsn, ',"ts_ms":', unix_millis(to_utc_timestamp(cast(_source_ts as string), 'UTC')), '}}}}')"""
    return CHANGES[name](spark, sf_dir).selectExpr(
        f"'{TOPIC_PREFIX}{name}' as topic", "cast(_kafka_offset % 3 as int) as partition", "_kafka_offset as offset",
        f"cast(cast({ENTITIES[name].pk} as string) as binary) as key", f"cast({body} as binary) as value",
    )


#: Broken records, one for each reason, as (value, key) in SQL; the event number makes each its own.
BROKEN = [
    ("encode(concat('broken ', event_id), 'utf-8')", "null"),
    ("unhex('FFFE')", "null"),
    ("cast(concat('[', event_id, ']') as binary)", "null"),
    ("""cast(concat('{"op":"x', event_id, '"}') as binary)""", "null"),
    ("""cast('{"op":"c","source":"{}"}' as binary)""", "null"),
    ("""cast('{"op":"c","source":{},"before":{"login_id":"a"}}' as binary)""", "null"),
    ("""cast('{"op":"c","source":{"lsn":"x"},"after":{"login_id":"a"}}' as binary)""", "null"),
    ("""cast('{"op":"c","source":{"ts_ms":"soon"},"after":{"login_id":"a"}}' as binary)""", "null"),
    ("""cast('{"op":"c","source":{},"after":{"login_id":"a","logged_in_at":true}}' as binary)""", "null"),
    ("""cast('{"op":"c","source":{},"after":{"org_id":"a"}}' as binary)""", "null"),
    ("cast(null as binary)", "cast('17' as binary)"),
    ("cast(rpad('x', 20000, 'y') as binary)", "null"),
]


def broken_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record that must become a dead letter, the reasons in turn; every 13th has no table."""
    n, kinds = len(BROKEN), range(len(BROKEN))
    value, key = ("case event_id % 13 " + " ".join(f"when {i} then {BROKEN[i][side]}" for i in kinds) + " end" for side in (0, 1))
    return table(spark, sf_dir, "events").selectExpr(
        f"if(event_id % 13 = {n}, 'saas.app.not_a_table', 'saas.app.logins') as topic", "cast(user_id % 3 as int) as partition",
        "event_id as offset", f"cast({key} as binary) as key", f"if(event_id % 13 = {n}, cast('{{}}' as binary), {value}) as value",
    )


BATCH = {
    "organizations": organizations,
    "users": users,
    "subscriptions": subscriptions,
    "logins": logins,
    "subscription_events": subscription_events,
    "invoices": invoices,
}
CHANGES = {
    "organizations": organizations_cdc,
    "users": users_cdc,
    "subscriptions": subscriptions_cdc,
    "logins": logins_cdc,
    "subscription_events": subscription_events_cdc,
    "invoices": invoices_cdc,
}

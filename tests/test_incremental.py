"""Maintenance that touches only what changed: keyed loads, login fact, daily activity, history."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from revtide.contracts import change_schema, raw_schema
from revtide.operators import history, marts, staging, upsert
from revtide.operators.current import current_entity
from revtide.plans.publish import ACTIVITY, CLOSED, OPEN, Publisher
from revtide.sources.lake import Lake, part_of


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# --- keyed loads ----------------------------------------------------------

def test_one_key_into_a_million_rows_rewrites_one_partition(spark, folder):
    lake = Lake(spark, folder, key_parts=64)
    million = spark.range(1_000_000).selectExpr("id as k", "id * 2 as v")
    lake.commit({"t": lake.replace_keyed("t", million, "k")})
    before = lake.segments("t")
    assert len(before) == 64 and len({part_of(s) for s in before}) == 64
    one = spark.createDataFrame([(77, -1)], million.schema)
    lake.commit({"t": lake.upsert("t", one, "k", million.schema)})
    new = [s for s in lake.segments("t") if s not in before]
    assert len(new) == 1 and len(set(before) - set(lake.segments("t"))) == 1
    assert lake.read("t", million.schema, new).count() < 20_000
    after = lake.read("t", million.schema)
    assert after.count() == 1_000_000 and after.filter("v = -1").first()["k"] == 77
    # The number of partitions stays with the table, whoever writes.
    lake.commit({"t": Lake(spark, folder, key_parts=3).upsert("t", one.withColumn("k", F.lit(2_000_000)), "k", million.schema)})
    assert len({part_of(s) for s in lake.segments("t")}) == 64 and lake.read("t", million.schema).count() == 1_000_001


def test_random_loads_equal_the_plain_merge(spark, folder):
    r, lake, held = random.Random(5), Lake(spark, folder, key_parts=4), {}
    schema = "k string, v long"
    for step in range(6):
        found = {r.choice([f"key{r.randrange(60)}", f"é{r.randrange(9)}"]): step for _ in range(r.randrange(25))}
        df = spark.createDataFrame(list(found.items()), schema)
        staged = lake.replace("t", df) if step == 0 else lake.upsert("t", df, "k", df.schema)  # begins without parts
        held = held | found if step else dict(found)
        lake.commit({"t": staged})
        assert rows(lake.read("t", df.schema)) == sorted(held.items(), key=repr)


# --- login fact -----------------------------------------------------------

DAY = dt.datetime(2024, 1, 1)


def login_frames(spark, seed, loads):
    """Random batch rows and changes of few logins in few retry groups, each with the load that brought it."""
    r, batch, changes = random.Random(seed), [], []
    for load in range(loads):
        at = DAY + dt.timedelta(days=load)
        for _ in range(r.randrange(1, 14)):
            key = f"l{r.randrange(25)}"
            row = (key, r.choice([None, f"e{r.randrange(8)}"]), f"u{r.randrange(4)}", f"o{r.randrange(3)}", "Okta", r.choice([True, False, None]), "US",
                   r.choice([None, DAY + dt.timedelta(days=r.randrange(5), hours=r.randrange(20))]), DAY + dt.timedelta(days=r.randrange(6)))
            stamp = (at, f"b{load}", "s")
            if r.random() < 0.5:
                batch.append(row + stamp)
            else:
                n = len(changes)
                changes.append((*row, r.choice("cud"), n, "t", 0, n, r.choice([None, at]), None, f"tok{n}", None, *stamp))
    changes = [(*c[:15], c[9] == "d", *c[16:]) for c in changes]
    kinds = raw_schema("logins"), change_schema("logins")
    return [spark.createDataFrame(data, schema).coalesce(1) for data, schema in zip((batch, changes), kinds)]


@pytest.mark.parametrize("seed", range(4))
def test_changed_logins_equal_the_full_path(spark, seed):
    """Increments with updates, deletes and retries: the new rows are those that full staging gives."""
    batch, changes = login_frames(spark, seed, 6)
    batch.cache(), changes.cache()
    for load in range(5):
        mark = DAY + dt.timedelta(days=load)
        seen = [df.filter(F.col("_loaded_at") <= mark + dt.timedelta(days=1)) for df in (batch, changes)]
        want = staging.stg_logins(current_entity(*seen, "logins")).filter(F.col("_loaded_at") > F.lit(mark))
        assert rows(marts.changed_logins(*seen, mark)) == rows(want)


def test_runs_of_the_publisher_equal_the_plain_merge(spark, folder):
    """Fact and activity after several incremental runs; days that no run touches keep their files."""
    batch, changes = login_frames(spark, 11, 5)
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    lake, plain, kept = Lake(spark, folder, key_parts=4), None, []
    for load in range(5):
        seen = [df.filter(F.col("_loaded_at") <= DAY + dt.timedelta(days=load)) for df in (batch, changes)]
        publisher, parts = Publisher(lake, lambda t: seen[0], lambda t: seen[1]), {}
        full = staging.stg_logins(current_entity(*seen, "logins"))
        before, days_before = lake.segments(ACTIVITY), rows(plain, "logged_in_at") if plain else []
        fact, days = publisher.login_fact({"stg_logins": full, "stg_users": users}, parts, False, DAY)
        publisher.activity(fact, days, parts, DAY)
        lake.commit(parts, schemas=publisher.schemas)
        late = marts.fct_logins(full, users, target=plain)
        plain = late if plain is None else upsert.upsert_by_key(plain, late, "login_id")
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        published = publisher.published("fct_logins")
        assert rows(published.drop("_built_at")) == rows(plain.select(*published.drop("_built_at").columns))
        assert rows(publisher.published(ACTIVITY).drop("_built_at")) == rows(marts.login_activity_daily(plain))
        if days is not None:
            untouched = [s for s in before if part_of(s) not in days]
            assert set(untouched) <= set(lake.segments(ACTIVITY))
            kept.append(len(untouched))
    assert any(kept) and days_before


def test_the_scans_of_changed_logins_are_pruned(spark, folder):
    batch, changes = login_frames(spark, 1, 4)
    batch.write.parquet(f"{folder}/b"), changes.write.parquet(f"{folder}/c")
    stored = [spark.read.schema(df.schema).parquet(f"{folder}/{n}") for df, n in ((batch, "b"), (changes, "c"))]
    text = marts.changed_logins(*stored, DAY)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", text)
    by_time = [s for s in scans if "GreaterThan(_loaded_at" in s[1]]
    wide = [s for s in scans if s[0].count(",") > 6]
    assert by_time and len(wide) == 2 and all(s[0].count(",") <= 2 for s in by_time)


# --- history --------------------------------------------------------------

SUBS = ", ".join(f"{c} {'long' if c in ('mrr_cents', 'seats') else 'timestamp_ntz' if c.endswith('_at') else 'string'}" for c in history.SUBSCRIPTION_COLUMNS)


def subscription(key, plan, cents=1):
    return key, "o", plan, "active", cents, 1, None, None, None


def test_later_publications_leave_closed_versions_as_they_are(spark, folder):
    r, lake, plain, closed = random.Random(3), Lake(spark, folder, key_parts=16), None, []
    for n in range(5):
        current = spark.createDataFrame([subscription(f"s{i}", r.choice("aab")) for i in range(40) if r.random() < 0.9], SUBS)
        now = f"2024-02-0{n + 1} 00:00:00"
        plain = history.scd2_check(plain, current, "subscription_id", history.SUBSCRIPTION_CHECK, now)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        publisher, parts = Publisher(lake, None, None), {}
        publisher.subscription_history(current, parts, now)
        lake.commit(parts, schemas=publisher.schemas)
        published = publisher.published("subscriptions_history")
        assert rows(published) == rows(plain.select(*published.columns))
        assert lake.segments(CLOSED)[:len(closed)] == closed
        closed = lake.segments(CLOSED)
    assert len(closed) > 1


def test_a_run_reads_no_closed_version_and_writes_only_touched_keys(spark, folder):
    lake = Lake(spark, folder, key_parts=16)
    first = [subscription(f"s{i}", "a") for i in range(200)]
    second = [subscription("s7", "b"), *[x for x in first if x[0] != "s7"]]
    for n, data in enumerate((first, second)):
        before, publisher, parts = lake.segments(OPEN), Publisher(lake, None, None), {}
        publisher.subscription_history(spark.createDataFrame(data, SUBS), parts, f"2024-02-0{n + 1} 00:00:00")
        lake.commit(parts, schemas=publisher.schemas)
    assert len(set(lake.segments(OPEN)) - set(before)) == 1 == len(lake.segments(CLOSED))
    delta = history.scd2_delta(publisher.published(OPEN), spark.createDataFrame(second, SUBS), "subscription_id", history.SUBSCRIPTION_CHECK, "2024-02-03")
    assert CLOSED not in delta._jdf.queryExecution().executedPlan().toString() and delta.count() == 0

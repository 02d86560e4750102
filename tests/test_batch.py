"""Loads, versioned tables, incremental facts, history and the publish gate."""

import datetime as dt
import time
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revtide.contracts import ENTITIES, PLAN_PRICE_CENTS, change_schema, raw_schema
from revtide.operators import history, marts, movements, quality, reports, staging, upsert
from revtide.operators.current import current_entity, latest_change
from revtide.plans.ingest import (
    ensure_tables, ingest, lay_out, raw_table, read_contract_jdbc, read_watermarks, split_points, split_predicates,
)
from revtide.plans.publish import Publisher
from revtide.plans.queries import QUERIES
from revtide.session import DROP_SHUFFLES, work_folder
from revtide.sources import folders, samples
from revtide.sources.lake import Lake
from revtide.streaming.promotion import promoted_from_file

SF_DIR = "/root/testdata/sf0.001"
SUBS = "subscription_id long, plan string, status string, mrr_cents long, seats long, canceled_at timestamp_ntz"


def test_work_folder_lies_in_a_shared_place(spark):
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *_: settings.get(key.split(".")[1])))

    assert work_folder(session(checkpoint="hdfs:///shared/", sql="/w"), "x").startswith("hdfs:///shared/x-")
    assert work_folder(session(sql="s3a://warehouse"), "x").startswith("s3a://warehouse/work/x-")


def pairs(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


def test_upsert_of_nothing_and_of_repeated_keys(spark, folder):
    lake = Lake(spark, folder)
    kv = lambda *rows: spark.createDataFrame(rows, "k long, v string")
    schema = kv((1, "a")).schema
    for rows in ([(1, "a"), (2, "b")], [(3, "c")]):
        lake.commit({"t": lake.upsert("t", kv(*rows), "k", schema)})
    staged = lake.upsert("t", kv((3, "C"), (4, "d")), "k", schema)
    assert pairs(lake.read("t", schema)) == [(1, "a"), (2, "b"), (3, "c")]
    lake.commit({"t": staged})
    assert pairs(lake.read("t", schema)) == [(1, "a"), (2, "b"), (3, "C"), (4, "d")]
    before = lake.segments("t")
    lake.commit({"t": lake.upsert("t", kv((1, "x")).limit(0), "k", schema)})
    assert lake.segments("t") == before
    with pytest.raises(ValueError):
        lake.upsert("t", kv((9, "p"), (9, "q")), "k", schema)
    lake.commit({"t": lake.replace("t", kv((1, "x")).limit(0))})
    assert pairs(lake.read("t", schema)) == []


def test_new_columns_read_as_null_in_old_segments(spark, folder):
    lake = Lake(spark, folder)
    old = spark.createDataFrame([(1, "a")], "k long, v string")
    lake.commit({"t": lake.replace("t", old)})
    new = spark.createDataFrame([(2, "b", "n")], "k long, v string, w string")
    lake.commit({"t": lake.upsert("t", new, "k", new.schema)})
    assert sorted(map(tuple, lake.read("t", new.schema).collect())) == [(1, "a", None), (2, "b", "n")]


def test_commit_is_all_or_nothing(spark, folder):
    lake = Lake(spark, folder)
    df = spark.range(3)
    started = lake.version()
    staged = {"a": lake.replace("a", df), "b": lake.replace("b", df)}
    assert lake.segments("a") == []
    Lake(spark, folder).commit({"c": []})
    with pytest.raises(RuntimeError):
        lake.commit(staged, based_on=started)
    assert lake.segments("a") == [] and lake.segments("b") == []


def test_ingest_runs(spark, folder):
    lake, day = Lake(spark, folder), dt.datetime(2024, 3, 1)
    ensure_tables(lake)
    assert raw_table(lake, "invoices").count() == 0 and read_watermarks(lake) == {}
    source = lambda t: samples.BATCH[t](spark, SF_DIR)
    ingest(lake, source, now=day)
    counts = {t: raw_table(lake, t).count() for t in ENTITIES}
    assert counts == {t: source(t).count() for t in ENTITIES}
    mark = read_watermarks(lake)["invoices"]
    assert mark == source("invoices").agg(F.max("recorded_at")).first()[0]
    # The second run re-stamps what the two-day lookback reads again, and all full tables.
    ingest(lake, source, now=day + dt.timedelta(days=1))
    rows = raw_table(lake, "invoices")
    again = rows.filter(F.col("_loaded_at") == day + dt.timedelta(days=1))
    assert rows.count() == counts["invoices"]
    assert again.count() == rows.filter(F.col("recorded_at") >= mark - dt.timedelta(days=2)).count()
    assert raw_table(lake, "users").select("_loaded_at").distinct().count() == 1
    # A full refresh replaces everything, also with less.
    ingest(lake, lambda t: source(t).limit(5), full_refresh=True)
    assert {raw_table(lake, t).count() for t in ENTITIES} == {5}


def test_failed_ingest_changes_nothing(spark, folder):
    lake = Lake(spark, folder)

    def broken(table):
        rows = samples.BATCH[table](spark, SF_DIR)
        return rows.unionByName(rows) if table == "invoices" else rows

    with pytest.raises(ValueError):
        ingest(lake, broken)
    assert lake.version() == 0 and raw_table(lake, "organizations").count() == 0


def test_normalize_shifts_zoned_times(spark):
    zoned = samples.users(spark, SF_DIR).limit(1).withColumn(
        "created_at", F.lit("2024-01-01 00:00:00+02:00").cast("timestamp")
    ).withColumn("org_id", F.lit("7.9").cast("decimal(5,1)"))
    row = upsert.normalize(zoned, "users").first()
    assert row["created_at"] == dt.datetime(2023, 12, 31, 22) and row["org_id"] == "7.9"
    assert upsert.normalize(
        samples.invoices(spark, SF_DIR).withColumn("amount_cents", F.lit("4.9").cast("decimal(5,1)")),
        "invoices",
    ).first()["amount_cents"] == 4


def change_row(key, offset, name, ts, lsn=0, deleted=False):
    return (key, name, offset, lsn, ts, deleted, f"t{offset}-{lsn}", dt.datetime(2024, 1, 9), "s", "d")


CHANGES = ("org_id string, name string, _kafka_offset long, _source_lsn long, _source_ts timestamp_ntz, "
           "_deleted boolean, _dedup_token string, _loaded_at timestamp_ntz, _batch_id string, "
           "_source_system string")


def test_current_row_rules(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    rest = ["domain", "industry", "employee_band", "country_code", "status", "created_at", "updated_at"]
    batch = spark.createDataFrame(
        [(k, f"batch-{k}", day(5)) for k in ("tie", "older", "newer", "gone", "back", "only")],
        "org_id string, name string, _loaded_at timestamp_ntz",
    ).withColumns({"_batch_id": F.lit("b"), "_source_system": F.lit("p")})
    changes = spark.createDataFrame(
        [
            change_row("tie", 1, "change", day(5)), change_row("older", 1, "change", day(4)),
            change_row("newer", 9, "late offset", day(6)), change_row("newer", 8, "later time", day(8)),
            change_row("gone", 1, "x", day(6), deleted=True),
            change_row("back", 1, "x", day(4), deleted=True),
            change_row("new", 2, "lsn low", day(1), lsn=1), change_row("new", 2, "lsn high", day(1), lsn=2),
            change_row("untimed", None, "no offset", day(1)), change_row("untimed", 0, "offset", None),
        ], CHANGES,
    )
    nulls = {name: F.lit(None).cast(raw_schema("organizations")[name].dataType) for name in rest}
    got = current_entity(batch.withColumns(nulls), changes.withColumns(nulls), "organizations")
    assert {r["org_id"]: r["name"] for r in got.collect()} == {
        "tie": "change", "older": "batch-older", "newer": "late offset", "back": "batch-back",
        "only": "batch-only", "new": "lsn high", "untimed": "offset",
    }
    assert latest_change(changes, "org_id").count() == 7


def test_fact_differs_between_increments_and_full_refresh(spark):
    """A retry in a later batch leaves the earlier login in the incremental fact."""
    schema = ("login_id long, client_event_id long, user_id long, org_id long, idp string, success boolean, "
              "ip_country string, logged_in_at timestamp_ntz, recorded_at timestamp_ntz, "
              "is_late_arriving boolean, _loaded_at timestamp_ntz")
    row = lambda i, user, load: (i, 1, user, 1, None, True, None, dt.datetime(2024, 1, 1),
                                 dt.datetime(2024, 1, 1), False, dt.datetime(2024, 1, load))
    users = spark.createDataFrame([(5,)], "user_id long")
    first = marts.fct_logins(spark.createDataFrame([row(1, 5, 1)], schema), users)
    staged = spark.createDataFrame([row(2, 6, 2)], schema)
    second = marts.fct_logins(staged, users, target=first)
    merged = upsert.upsert_by_key(first, second, "login_id")
    assert sorted((r["login_id"], r["is_known_user"]) for r in merged.collect()) == [(1, True), (2, False)]
    assert marts.fct_logins(staged, users).count() == 1
    assert marts.fct_logins(staged, users, target=merged).count() == 0
    assert marts.fct_logins(staged, users, target=first.limit(0)).count() == 1


def test_history_versions(spark):
    at = lambda n: dt.datetime(2024, 1, n)
    runs = [
        [(1, "a", "active", 5, 1, None), (2, "a", "active", 5, 1, None), (3, "a", "active", 5, 1, None)],
        [(1, "a", "active", 5, 1, None), (2, "a", "canceled", 5, 1, at(1)), (4, "a", "active", 5, 1, None)],
        [(1, "a", "active", 5, 1, None), (2, "a", "canceled", 5, 1, None), (4, "b", "active", 5, 1, None)],
    ]
    rows = None
    for n, run in enumerate(runs, start=1):
        current = spark.createDataFrame(run, SUBS)
        rows = history.scd2_check(rows, current, "subscription_id", history.SUBSCRIPTION_CHECK, f"2024-02-0{n}")
    got = sorted((r["subscription_id"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day,
                  r["is_current"]) for r in rows.collect())
    assert got == [
        (1, 1, None, True), (2, 1, 2, False), (2, 2, 3, False), (2, 3, None, True),
        (3, 1, None, True), (4, 2, 3, False), (4, 3, None, True),
    ]
    assert rows.select("scd_id").distinct().count() == rows.count()


def test_movement_rules_and_empty_input(spark):
    schema = ("event_id long, subscription_id long, org_id long, event_type string, from_plan string, "
              "to_plan string, mrr_cents_before long, mrr_cents_after long, occurred_at timestamp_ntz, "
              "recorded_at timestamp_ntz, is_late_arriving boolean")
    cases = [
        (0, 5, "created", "new"), (None, 5, None, "new"), (0, 5, "reactivated", "reactivation"),
        (5, 9, "upgraded", "expansion"), (9, 5, "reactivated", "contraction"), (5, 0, "canceled", "churn"),
        (5, None, "canceled", "churn"), (5, 5, "upgraded", "other"), (0, 0, "created", "other"),
        (5, -1, "downgraded", "other"),
    ]
    at = dt.datetime(2024, 1, 31, 23, 59)
    rows = [(i, 1, 1, kind, None, None, before, after, at, at, False)
            for i, (before, after, kind, _) in enumerate(cases)]
    events = spark.createDataFrame(rows, schema)
    got = {r["event_id"]: r["movement_type"] for r in movements.subscription_movements(events).collect()}
    assert got == {i: case[3] for i, case in enumerate(cases)}
    none = movements.subscription_movements(events.limit(0))
    assert movements.mrr_monthly(none).count() == 0
    assert movements.org_month_mrr(none).count() == 0
    assert movements.month_spine(movements.month_bounds(none)).count() == 0


def test_quiet_months_carry_state(spark):
    schema = ("event_id long, org_id long, mrr_cents_after long, mrr_delta_cents long, "
              "occurred_at timestamp_ntz, occurred_month date, movement_type string")
    at = lambda m: (dt.datetime(2024, m, 3), dt.date(2024, m, 1))
    rows = [(1, 1, 100, 100, *at(1), "new"), (2, 2, 50, 50, *at(1), "new"),
            (3, 1, 0, -100, *at(4), "churn"), (4, None, 7, 7, *at(4), "new"),
            (5, None, 0, -7, *at(6), "churn")]
    moves = spark.createDataFrame(rows, schema)
    got = movements.mrr_monthly(moves)
    rows = sorted(got.collect())
    assert [r["ending_mrr_cents"] for r in rows] == [150, 150, 150, 57, 57, 50]
    assert [r["active_orgs_end"] for r in rows] == [2, 2, 2, 2, 2, 1]
    assert [r["churned_orgs"] for r in rows] == [0, 0, 0, 1, 0, 0]
    assert [r["new_orgs"] for r in rows] == [2, 0, 0, 0, 0, 0]
    assert [r["logo_churn_rate"] for r in rows] == [None, 0.0, 0.0, 0.5, 0.0, 0.0]
    states = movements.org_month_mrr(moves)
    parts = movements.mrr_bridge(
        movements.ending_state(states), movements.month_flows(moves), movements.starting_churn(moves, states)
    )
    assert sorted(parts.collect()) == rows
    assert movements.bridge_violations(got).count() == movements.churn_bounds_violations(got).count() == 0


def test_negative_amounts_are_repaired_or_refused(spark):
    rows = [(1, "STARTER", "active", -500, 1, None), (2, "growth", "active", 3, 1, None)]
    fixed = upsert.repair_negative_mrr(spark.createDataFrame(rows, SUBS), PLAN_PRICE_CENTS)
    assert {r["subscription_id"]: r["mrr_cents"] for r in fixed.collect()} == {1: 4900, 2: 3}
    unknown = spark.createDataFrame([(1, "gold", "active", -1, 1, None)], SUBS)
    with pytest.raises(PySparkException):
        upsert.repair_negative_mrr(unknown, PLAN_PRICE_CENTS).collect()


def test_rules_ignore_nulls_and_count_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "x"), (None, None), (None, "a"), (7, "a")], "k long, v string")
    rules = [
        quality.Rule("t", "unique", "k"), quality.Rule("t", "not_null", "k", "warn"),
        quality.Rule("t", "accepted_values", "v", values=("a",)),
        quality.Rule("t", "relationships", "k", parent=("p", "id")),
    ]
    parent = spark.createDataFrame([(7,)], "id long")
    got = {r["rule"]: r["failures"] for r in quality.run_checks({"t": df, "p": parent}, rules).collect()}
    assert got == {"unique.t.k": 1, "not_null.t.k": 2, "accepted_values.t.v": 1, "relationships.t.k": 2}
    assert len(quality.UPSTREAM_RULES) == 68 and len(quality.MART_RULES) == 27


def test_rules_without_a_common_table_are_counted_apart(spark):
    groups = quality.independent(quality.UPSTREAM_RULES)
    tables = [{r.table for r in g} | {r.parent[0] for r in g if r.parent} for g in groups]
    assert sorted(r.name for g in groups for r in g) == sorted(r.name for r in quality.UPSTREAM_RULES)
    assert {"int_org_month_mrr"} in tables and {"int_subscription_movements"} in tables and len(groups) == 3
    rules = [quality.Rule("c", "unique", "k"), quality.Rule("d", "not_null", "k"), quality.Rule("c", "relationships", "k", parent=("p", "k")),
             quality.Rule("p", "unique", "k"), quality.Rule("d", "unique", "k")]
    frames = {t: spark.createDataFrame(keys, "k long") for t, keys in {"c": [(1,), (1,), (2,)], "p": [(1,)], "d": [(None,), (5,), (5,)]}.items()}
    apart = [r for g in quality.independent(rules) for r in quality.run_checks(frames, g).collect()]
    assert sorted(apart) == sorted(quality.run_checks(frames, rules).collect()) and len(quality.independent(rules)) == 2


def test_staging_holds_one_shuffle_at_a_time(spark, folder):
    running, together = [], []

    class Watched(Lake):
        def replace(self, table, df):
            running.append(table)
            together.append(len(running))
            try:
                return super().replace(table, df)
            finally:
                running.remove(table)

    def keyed(schema, pk):
        df = spark.createDataFrame([("a",), ("b",), (None,)], f"{pk} string")
        return df.select(*[F.col(f.name) if f.name == pk else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(DROP_SHUFFLES)
    lake, staged = Watched(spark, folder), {}
    publisher = Publisher(lake, lambda t: keyed(raw_schema(t), ENTITIES[t].pk), lambda t: keyed(change_schema(t), ENTITIES[t].pk))
    frames = publisher.upstream(staged)
    for _ in range(100):  # files go in the background
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.get(DROP_SHUFFLES) == setting
    assert set(together) == {1} and len(together) == 8
    assert sorted(str(r["user_id"]) for r in frames["stg_users"].collect()) == ["None", "None", "a", "b"]  # null keys are not one key
    assert all(n.endswith(".zstd.parquet") for n in folders.names(spark, f"{folder}/{staged['stg_users'][0]}") if n.endswith(".parquet"))


def test_gate(spark, folder):
    raw = lambda t: samples.BATCH[t](spark, SF_DIR)

    def changes(table):
        rows = samples.CHANGES[table](spark, SF_DIR)
        return rows.withColumn("_deleted", F.lit(False)) if table == "organizations" else rows

    def broken(table):
        rows = changes(table)
        return rows.withColumn("mrr_cents", F.lit(-500)) if table == "subscriptions" else rows

    lake = Lake(spark, folder)
    clean, bad = Publisher(lake, raw, changes), Publisher(lake, raw, broken)

    def signature():
        return quality.publish_signature(
            clean.published("fct_mrr_monthly"), clean.published("dim_organizations")
        )

    stale = clean.publish("2024-02-01", clock="2024-02-10 00:00:00")
    assert (stale.published, stale.stage) == (False, "freshness")
    assert clean.published("fct_mrr_monthly") is None
    assert clean.publish("2024-02-01 00:00:00", check_freshness=False).published
    before = signature()
    blocked = bad.publish("2024-02-02 00:00:00", check_freshness=False)
    assert (blocked.published, blocked.stage) == (False, "upstream")
    assert "non_negative.stg_subscriptions.mrr_cents" in {r["rule"] for r in blocked.failed.collect()}
    audit = quality.gate_audit(before, signature()).collect()
    assert all(r["unchanged"] and not r["moved"] for r in audit)
    healed = clean.publish("2024-02-03 00:00:00", check_freshness=False)
    assert healed.published
    assert all(r["moved"] for r in quality.gate_audit(before, signature()).collect())
    assert lake.version() == 2
    frames = reports.report_frames({n: clean.published(n) for n in (
        "fct_mrr_monthly", "dim_organizations", "fct_login_activity_daily", "fct_plan_changes")})
    assert {n: df.count() > 0 for n, df in frames.items()} == dict.fromkeys(frames, True)
    assert dict(frames["mrr"].dtypes)["ending_mrr_cents"] == "double"
    # Nothing new was loaded, so the fact keeps its rows and history its versions.
    assert clean.published("fct_logins").count() == clean.published("stg_logins").count()
    assert clean.published("subscriptions_history").filter("not is_current").count() == 0


def test_split_predicates_are_disjoint_and_complete(spark):
    """No database here: the conditions are run over a frame, the read itself is left to a deployment."""
    keys = [None, "", "a", "a'b", "ab", "b", "é", "zz", *[f"k{i:03d}" for i in range(300)]]
    rows = spark.createDataFrame([(k,) for k in keys], "k string")
    points = split_points(rows, "k", 6)
    assert 3 <= len(points) <= 5
    for cuts in (points, ["a'b"], [], ["a", "a", "b"]):
        met = [rows.filter(p).count() for p in split_predicates("k", cuts)]
        every = " + ".join(f"cast(coalesce({p}, false) as int)" for p in split_predicates("k", cuts))
        assert sum(met) == len(keys) and {r[0] for r in rows.selectExpr(every).collect()} == {1}
        assert rows.filter(split_predicates("k", cuts)[0]).filter("k is null").count() == 1
    sizes = [rows.filter(p).count() for p in split_predicates("k", points)]
    assert max(sizes) < len(keys) / 2
    numbers = spark.range(1000).selectExpr("if(id % 9 = 0, null, id) as n")
    assert sum(numbers.filter(p).count() for p in split_predicates("n", split_points(numbers, "n", 4))) == 1000
    assert split_points(rows.limit(0), "k", 4) == []


def test_a_database_table_is_not_read_by_one_task_unasked(spark):
    with pytest.raises(ValueError, match="one task"):
        read_contract_jdbc(spark, "logins", {"url": "jdbc:postgresql://db/app"})


def test_the_lookback_opens_few_rows_of_a_laid_out_source(spark, folder):
    """Files in watermark order: footers cut the scan to the newest files; without, it reads all."""
    rows = spark.range(200_000).selectExpr("string(id) as invoice_id", "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, int(hash(id) % 500000)) as recorded_at")
    mark = rows.agg(F.max("recorded_at")).first()[0]
    lay_out(rows, "invoices", f"{folder}/laid", 40)
    rows.repartition(40).write.parquet(f"{folder}/mixed")

    def incremental_rows(source, mark):
        rest = {c: F.lit(None).cast("string") for c in ENTITIES["invoices"].column_names if c not in source.columns}
        return upsert.incremental_scan(source.withColumns(rest), "invoices", mark).select("invoice_id")

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for name in ("laid", "mixed"):
            source = spark.read.parquet(f"{folder}/{name}")
            found = incremental_rows(source, mark)
            execution = found._jdf.queryExecution()
            n = len(execution.executedPlan().executeCollect())
            leaf = execution.executedPlan().collectLeaves().head()
            read[name] = (n, leaf.metrics().apply("numOutputRows").value())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["laid"][0] == read["mixed"][0] > 0
    assert read["mixed"][1] == 200_000 and read["laid"][1] <= 4 * 200_000 // 40


def test_reports_come_in_order(spark):
    frames = {n: QUERIES[f"report_{n}"](spark, "/root/testdata/sf0.001").collect() for n in ("mrr", "logins", "changes")}
    for name, column in (("mrr", "month_start"), ("logins", "activity_date"), ("changes", "occurred_at")):
        found = [r[column] for r in frames[name]]
        assert len(found) > 5 and found == sorted(found)


def test_tiles_of_few_months(spark):
    moves = movements.subscription_movements(staging.stg_subscription_events(samples.subscription_events(spark, SF_DIR)))
    bridge = movements.mrr_monthly(moves)
    assert reports.kpi_tiles(bridge).count() == 6
    assert reports.kpi_tiles(bridge.limit(1)).count() == reports.kpi_tiles(bridge.limit(0)).count() == 0
    flat = spark.createDataFrame([(dt.date(2024, m, 1), *[0] * 7, 4, 4, 0, 0, None) for m in (1, 2)], bridge.schema)
    got = [tuple(r)[2:] for r in reports.kpi_tiles(flat).orderBy("position").collect()]
    assert got == [("$0", "Jan 2024: $0", "flat"), ("$0", "+0.0%", "flat"), ("4", "+0", "flat"), ("–", "–, 0 lost", "flat"), ("$0", "0 new", "flat"), ("$0", "", "flat")]


def test_promoted_columns_from_a_file(spark, folder):
    path = f"{folder}/promoted.json"
    assert promoted_from_file(spark, path) == {}
    folders.create_text(spark, path, '{"users": {"plan_note": "varchar"}, "logins": {}}')
    assert promoted_from_file(spark, path) == {"users": {"plan_note": "varchar"}, "logins": {}}
    for n, bad in enumerate(('{"users": {"Bad-Name": "varchar"}}', '{"users": {"a": "double"}}', '{"users": []}', '{"nothing": {}}', "[]")):
        folders.create_text(spark, f"{folder}/{n}", bad)
        with pytest.raises(ValueError):
            promoted_from_file(spark, f"{folder}/{n}")

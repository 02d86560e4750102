"""The plans scale: pruned scans, no Python, no range joins, hot keys cut before the shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from revtide.operators import marts, movements, quality, upsert
from revtide.plans.queries import QUERIES, live, moved
from revtide.sources import samples

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH_ONLY = [n for n in QUERIES if not n.startswith(("cdc_", "gate_", "landing_signature", "stale_"))
              and n not in ("ingest", "run_checks", "run_mart_checks", "dead_letters", "current_from_stream")]


@pytest.mark.parametrize("name", BATCH_ONLY)
def test_no_python_and_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_hot_keys_are_cut_before_the_shuffle(spark):
    text = plan(live(spark, SF_DIR, "organizations"))
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 2
    assert text.count("Exchange hashpartitioning") == 2


def test_current_rows_read_only_needed_columns(spark):
    text = plan(live(spark, SF_DIR, "organizations").select("org_id", "status"))
    customer = re.search(r"ReadSchema: struct<(c_custkey[^>]*)>", text).group(1)
    assert "c_name" not in customer and "c_mktsegment" not in customer


def test_incremental_scan_pushes_its_filter(spark, folder):
    samples.invoices(spark, SF_DIR).write.parquet(folder)
    scan = upsert.incremental_scan(spark.read.parquet(folder), "invoices", "2001-01-01")
    assert "GreaterThanOrEqual(recorded_at,2000-12-30T00:00" in plan(scan)


def test_monthly_bridge_never_builds_the_month_table(spark, folder):
    moved(spark, SF_DIR).write.parquet(folder)
    text = plan(movements.mrr_monthly(spark.read.parquet(folder)))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 3


def test_hot_user_is_split_at_run_time(spark, folder):
    """Half of the logins belong to one user; the join task of that user is split."""
    rows = spark.range(200_000).selectExpr(
        "id as login_id", "if(id % 2 = 0, 7, id) as user_id", "uuid() as idp"
    )
    rows.repartition(16).write.parquet(folder)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        flagged = marts.flag_known(spark.read.parquet(folder), spark.range(100).toDF("user_id"))
        assert flagged.filter("is_known_user").count() == 100_000 + 50
        flagged.collect()
        assert "skew=true" in plan(flagged)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_key_results(spark):
    """A third of the rows on one key: same results as without the skew handling."""
    rows = spark.range(3000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("org_id"),
        (F.col("id") % 7 * 10).alias("mrr_cents_after"), F.lit(1).alias("mrr_delta_cents"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 90).cast("int")))
        .alias("occurred_at"),
    ).withColumn("occurred_month", F.trunc("occurred_at", "month")).withColumn("movement_type", F.lit("new"))
    got = movements.asof_month_state(rows)
    rows.createOrReplaceTempView("skewed_moves")
    want = spark.sql("""
        select month_start, org_id, mrr_cents_after from (
          select m.month_start, v.org_id, v.mrr_cents_after, row_number() over (
              partition by m.month_start, v.org_id order by v.occurred_at desc, v.event_id desc) as n
          from (select distinct occurred_month as month_start from skewed_moves) m
          join skewed_moves v on v.occurred_at < add_months(m.month_start, 1))
        where n = 1""")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    orphans = quality.relationships(rows, "org_id", spark.range(1, 60), "id")
    assert [tuple(r) for r in orphans.collect()] == [(0, rows.filter("org_id = 0").count())]


def test_all_rules_of_a_table_are_one_scan(spark, folder):
    """Every rule of the staged tables; each stored table is read once, keys are counted map-side first."""
    frames = {}
    names = dict.fromkeys([r.table for r in quality.UPSTREAM_RULES if r.kind != "no_duplicate_keys"])
    columns = {n: {r.column for r in quality.UPSTREAM_RULES if r.table == n and r.column} for n in names}
    columns["stg_subscriptions"] |= {"canceled_at"}
    columns["stg_invoices"] |= {"paid_at"}
    for name in names:
        spark.range(50).selectExpr(*[f"{'id' if c.endswith(('cents', '_after')) else 'string(id)'} as {c}" for c in sorted(columns[name])], "id as unread").write.parquet(f"{folder}/{name}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
    text = plan(quality.run_checks(frames, quality.UPSTREAM_RULES))
    assert text.count("FileScan") == len(names) and "partial_count(" in text and "unread" not in text


def test_failing_rows_are_written_for_failing_rules_only(spark, folder):
    df = spark.createDataFrame([(1, "a"), (1, "x"), (None, "a")], "k long, v string")
    rules = [quality.Rule("t", "unique", "k"), quality.Rule("t", "not_null", "v"), quality.Rule("t", "accepted_values", "v", values=("a",)),
             quality.Rule("t", "relationships", "k", parent=("p", "id"))]
    frames = {"t": df, "p": spark.createDataFrame([(1,)], "id long")}
    checks = quality.run_checks(frames, rules)
    assert {r["rule"]: r["failures"] for r in checks.collect()} == {
        "unique.t.k": 1, "not_null.t.v": 0, "accepted_values.t.v": 1, "relationships.t.k": 0}
    kept = quality.write_failing(frames, rules, checks, folder)
    assert kept.keys() == {"unique.t.k", "accepted_values.t.v"}
    assert [tuple(r) for r in spark.read.parquet(kept["accepted_values.t.v"]).collect()] == [(1, "x")]


def test_every_mart_rule_is_broken_somewhere(spark):
    found = QUERIES["mart_rules_found"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == 27 and all(r["failures"] > 0 for r in found)

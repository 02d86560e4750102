"""Landing scenarios: replay, drift, crash, poison, order and splits of the input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from revtide.operators.current import current_entity, latest_change
from revtide.operators.staging import stg_organizations
from revtide.contracts import RECORD_SCHEMA, raw_schema
from revtide.operators.quality import duplicate_keys
from revtide.sources.changes import Pace, publish_to_files, read_change_files, topic_options
from revtide.sources.lake import Lake
from revtide.contracts import change_schema
from revtide.sources import folders
from revtide.streaming.envelope import parse_envelopes, with_table
from revtide.streaming.landing import Landing, spanned
from revtide.streaming.current_state import CurrentState, latest_changes
from revtide.streaming.lag import assert_replay_safe, broker_lag, lag_report, landing_signature
from revtide.streaming.progress import PROGRESS, ProgressTable, broker_ends, rows_read
from revtide.streaming.promotion import backfill_promoted
from tests.records import change, frame, org, raw


def landed(landing, table="organizations"):
    rows = landing.changes(table).drop("_loaded_at", "_batch_id").collect()
    return sorted(rows, key=lambda r: (r["_kafka_partition"], r["_kafka_offset"]))


def committed(landing):
    return {(r["topic"], r["partition_id"]): r["committed_offset"] for r in landing.offsets().collect()}


def test_replay_adds_nothing(spark, folder):
    landing = Landing(spark, folder)
    records = frame(spark, [change("c", org(), 10, 0), change("u", org(name="Acme Works"), 11, 1)])
    assert landing.apply_records(records, "seed")["inserted"] == 2
    before = landing_signature(landing.changes("organizations"), "org_id").first()
    first = landing.changes("organizations").cache()
    first.count()
    assert landing.apply_records(records, "replay") == {
        "inserted": 0, "skipped": 2, "dead_letters": 0, "parsed_changes": 2, "parsed_dead_letters": 0,
    }
    assert landing_signature(landing.changes("organizations"), "org_id").first() == before
    assert assert_replay_safe(first, landing.changes("organizations"), "org_id").count() == 0
    first.unpersist()


def test_unknown_field_is_kept_and_promoted(spark, folder):
    plain = Landing(spark, folder)
    plain.apply_records(frame(spark, [change("c", org(billing_email="ap@northwind.example"), 20, 0)]), "a")
    row = landed(plain)[0]
    assert row["_extra"] == '{"billing_email":"ap@northwind.example"}'
    assert "billing_email" not in plain.changes("organizations").columns
    promoted = Landing(spark, folder, {"organizations": {"billing_email": "varchar"}})
    second = change("u", org(billing_email="finance@northwind.example"), 21, 1)
    promoted.apply_records(frame(spark, [second]), "b")
    filled = backfill_promoted(promoted.changes("organizations"), "billing_email", "varchar")
    got = sorted((r["_source_lsn"], r["billing_email"]) for r in filled.collect())
    assert got == [(20, "ap@northwind.example"), (21, "finance@northwind.example")]


@pytest.mark.parametrize("name, typ", [("Bad-Name", "varchar"), ("fine", "double"), ("x; drop", "date")])
def test_promotion_is_checked(spark, folder, name, typ):
    with pytest.raises(ValueError):
        Landing(spark, folder, {"organizations": {name: typ}}).changes("organizations")


def test_crash_between_landing_and_commit(spark, folder):
    landing = Landing(spark, folder)
    records = frame(spark, [change("c", org(), 30, 0), change("u", org(name="New"), 31, 1)])
    landing.apply_records(records, "crashed", commit_offsets=False)
    assert committed(landing) == {}
    again = landing.apply_records(records, "restart")
    assert (again["inserted"], again["skipped"]) == (0, 2)
    assert committed(landing) == {("saas.app.organizations", 0): 2}


def test_retried_epoch_replaces_its_own_folder(spark, folder):
    """A write that died half-way left only part of the epoch's rows."""
    landing = Landing(spark, folder)
    records = [change("c", org(), 30, 0), change("u", org(name="New"), 31, 1)]
    landing.apply_records(frame(spark, records[:1]), "spark-0", True, "check-1", 0)
    landing.apply_records(frame(spark, records), "spark-0", True, "check-1", 0)
    assert [r["_source_lsn"] for r in landed(landing)] == [30, 31]
    # A new checkpoint starts at epoch 0 again and must not touch the first landing.
    landing.apply_records(frame(spark, records), "spark-0", True, "check-2", 0)
    assert [r["_source_lsn"] for r in landed(landing)] == [30, 31]


def test_poison_is_isolated(spark, folder):
    landing = Landing(spark, folder, publish=publish_to_files(f"{folder}/topic"))
    records = [change("c", org(), 40, 0), raw(1, "not-json"), change("u", org(name="Late"), 41, 2)]
    stats = landing.apply_records(frame(spark, records), "poison")
    assert (stats["inserted"], stats["parsed_dead_letters"], stats["dead_letters"]) == (2, 1, 1)
    letter = landing.dead_letters().first()
    assert letter["dead_letter_id"] == "saas.app.organizations:0:1"
    assert "json" in letter["error"] and letter["payload"] == "not-json"
    assert [r["name"] for r in landed(landing)] == ["Acme Tools", "Late"]
    assert landing.apply_records(frame(spark, records), "again")["dead_letters"] == 0
    assert landing.dead_letters().count() == 1
    sent = spark.read.parquet(f"{folder}/topic").collect()
    assert [(r["key"], r["value"]) for r in sent] == [("saas.app.organizations:0:1", "not-json")] * 2


def test_tombstone_and_tokens(spark, folder):
    landing = Landing(spark, folder)
    records = [
        raw(7, None, '{"org_id":"org-9"}'), change("c", org(), 50, 1), change("c", org(), 50, 2),
    ]
    landing.apply_records(frame(spark, records), "b")
    first, second, tombstone = landed(landing)
    assert first["_dedup_token"] == "lsn:50:offset:1" and second["_dedup_token"] == "lsn:50:offset:2"
    assert tombstone["_dedup_token"] == "kafka:saas.app.organizations:0:7"
    assert (tombstone["org_id"], tombstone["_op"], tombstone["_deleted"]) == ("org-9", "d", True)
    assert tombstone["name"] is None and tombstone["_source_lsn"] is None


REASONS = [
    ("not-json", None, "no single json value in the payload"),
    ('{"a":1} junk', None, "no single json value in the payload"),
    ('{"a":1}],[{"b":2}', None, "no single json value in the payload"),
    ("{'op':'c'}", None, "no single json value in the payload"),
    ("[1]", None, "json payload holds no object"),
    ('"text"', None, "json payload holds no object"),
    ('{"op":"x"}', None, "op is none of c, u, d, r"),
    ('{"op":["c"]}', None, "op is none of c, u, d, r"),
    ('{"op":"c","source":"{}"}', None, "no source block"),
    ('{"op":"c","source":{},"after":[1]}', None, "no row image for this op"),
    ('{"op":"d","source":{},"after":{"org_id":"a"}}', None, "no row image for this op"),
    ('{"op":"c","source":{"lsn":"x"},"after":{"org_id":"a"}}', None, "lsn does not read as a whole number"),
    ('{"op":"c","source":{"ts_ms":"x"},"after":{"org_id":"a"}}', None, "ts_ms does not read as a time"),
    ('{"op":"c","source":{},"after":{"org_id":"a","created_at":true}}', None,
     "value of created_at does not read as timestamp"),
    ('{"op":"c","source":{},"after":{"name":"a"}}', None, "no value for key org_id"),
    (None, "17", "tombstone without org_id in its key"),
    (None, '{"other":1}', "tombstone without org_id in its key"),
    (None, "", "tombstone without org_id in its key"),
    (b"\xff\xfe", None, "bytes do not decode as utf-8"),
]


def test_every_reason_for_a_dead_letter(spark, folder):
    landing = Landing(spark, folder)
    rows = [raw(i, value, key) for i, (value, key, _) in enumerate(REASONS)]
    rows.append(raw(0, "{}", topic="saas.app.not_a_table"))
    stats = landing.apply_records(frame(spark, rows), "b")
    assert stats["dead_letters"] == len(rows) and stats["inserted"] == 0
    letters = landing.dead_letters().collect()
    got = {r["offset_id"]: r["error"] for r in letters if r["topic"] == "saas.app.organizations"}
    assert got == {i: error for i, (_, _, error) in enumerate(REASONS)}
    (other,) = [r for r in letters if r["topic"] != "saas.app.organizations"]
    assert other["error"].startswith("topic saas.app.not_a_table")


def test_long_payload_comes_back_whole(spark, folder):
    landing = Landing(spark, folder)
    landing.apply_records(frame(spark, [raw(0, "x" * 20000), change("c", org(name="y" * 9000), 1, 1)]), "b")
    assert landing.dead_letters().first()["payload"] == "x" * 20000
    assert len(landed(landing)[0]["name"]) == 9000


def test_values_convert_by_their_json_type(spark, folder):
    landing = Landing(spark, folder)
    invoice = {"invoice_id": "i1", "amount_cents": 4.9, "period_start": 19000,
               "period_end": "2024-01-05T10:00:00", "issued_at": 1_700_000_000,
               "paid_at": 1_700_000_000_123, "recorded_at": "2024-01-01T10:00:00.5+05:30"}
    login = {"login_id": 5, "success": "T", "logged_in_at": "2024-01-01T10:00Z", "idp": True}
    other = {"login_id": "6", "success": "yes", "recorded_at": "2024-01-01"}
    landing.apply_records(
        frame(spark, [
            change("c", invoice, 1, 0, table="invoices"),
            change("c", {**invoice, "amount_cents": "4.9"}, 2, 1, table="invoices"),
            change("c", login, 3, 2, table="logins"), change("c", other, 4, 3, table="logins"),
        ]), "b",
    )
    (row,) = landed(landing, "invoices")
    assert row["amount_cents"] == 4
    assert (row["period_start"], row["period_end"]) == (dt.date(2022, 1, 8), dt.date(2024, 1, 5))
    assert row["issued_at"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert row["paid_at"] == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert row["recorded_at"] == dt.datetime(2024, 1, 1, 4, 30, 0, 500000)
    assert landing.dead_letters().first()["error"] == "value of amount_cents does not read as bigint"
    first, second = landed(landing, "logins")
    assert (first["login_id"], first["success"], first["idp"]) == ("5", True, "True")
    assert first["logged_in_at"] == dt.datetime(2024, 1, 1, 10)
    assert (second["success"], second["recorded_at"]) == (False, dt.datetime(2024, 1, 1))


def test_session_zone_does_not_move_times(spark, folder):
    landing = Landing(spark, folder)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        image = org(created_at="2024-01-01T00:00:00Z", updated_at=1_700_000_000)
        landing.apply_records(frame(spark, [change("c", image, 1, 0)]), "b")
        row = landed(landing)[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["created_at"] == dt.datetime(2024, 1, 1)
    assert row["updated_at"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert row["_source_ts"] == dt.datetime(2022, 4, 15, 5, 20)


def test_order_and_split_of_the_input_do_not_matter(spark, folder):
    records = [change("u", org(f"o{i % 5}", f"N{i}"), i, i) for i in range(30)]
    records += records[::3] + [raw(40 + i, "junk") for i in range(3)]
    whole, parts = Landing(spark, f"{folder}/whole"), Landing(spark, f"{folder}/parts")
    whole.apply_records(frame(spark, records), "w")
    random.Random(1).shuffle(records)
    for i in range(0, len(records), 15):
        parts.apply_records(frame(spark, records[i:i + 15]), f"p{i}")
    assert landed(whole) == landed(parts) and len(landed(whole)) == 30
    assert parts.dead_letters().count() == whole.dead_letters().count() == 3


def test_offset_ledger_follows_the_last_batch(spark, folder):
    landing = Landing(spark, folder)
    landing.apply_records(frame(spark, [change("c", org(), 1, 9)]), "a")
    landing.apply_records(frame(spark, [change("c", org(), 1, 3)]), "b")
    assert committed(landing) == {("saas.app.organizations", 0): 4}
    assert landing.apply_records(frame(spark, []), "c") == {"inserted": 0, "skipped": 0, "dead_letters": 0}


def test_stream_restart_and_new_checkpoint(spark, folder):
    landing, source = Landing(spark, f"{folder}/cdc"), f"{folder}/in"

    def run(checkpoint):
        stream = read_change_files(spark, source, 1)
        landing.start(stream, f"{folder}/{checkpoint}", {"availableNow": True}).awaitTermination()

    frame(spark, [change("c", org(), 1, 0)]).write.parquet(source)
    run("a")
    frame(spark, [change("u", org(name="B"), 2, 1), raw(2, "junk")]).coalesce(1).write.mode(
        "append"
    ).parquet(source)
    run("a")
    assert [r["_source_lsn"] for r in landed(landing)] == [1, 2]
    run("b")
    assert [r["_source_lsn"] for r in landed(landing)] == [1, 2]
    assert landing.dead_letters().count() == 1
    assert committed(landing) == {("saas.app.organizations", 0): 3}


def test_batch_and_stream_overlap(spark, folder):
    landing, future = Landing(spark, folder), 4_000_000_000_000
    landing.apply_records(
        frame(spark, [
            change("d", org("org-1"), 9_000_000_000, 1, future),
            change("c", org("org-new", "Old Name"), 9_000_000_001, 2, future + 1),
            change("u", org("org-new", "New Name"), 9_000_000_002, 3, future + 2),
        ]), "overlap", commit_offsets=False,
    )
    loaded = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame(
        [(f"org-{i}", "Name", None, None, None, None, "Active", loaded, loaded, loaded, "b", "postgres_batch")
         for i in (1, 2)], raw_schema("organizations"),
    )
    staged = stg_organizations(current_entity(batch, landing.changes("organizations"), "organizations"))
    assert {r["org_id"]: r["org_name"] for r in staged.collect()} == {"org-2": "Name", "org-new": "New Name"}
    assert duplicate_keys(staged, ["org_id"]).count() == 0
    # A later batch snapshot brings a deleted key back.
    later = batch.withColumn("_loaded_at", F.lit("2100-01-01").cast("timestamp_ntz"))
    again = current_entity(later, landing.changes("organizations"), "organizations")
    assert {r["org_id"] for r in again.collect()} == {"org-1", "org-2", "org-new"}


def test_broker_lag(spark):
    done = spark.createDataFrame([("t", 0, 4), ("t", 1, 2)], "topic string, partition_id long, committed_offset long")
    ends = spark.createDataFrame([("t", 0, 9)], "topic string, partition_id long, end_offset long")
    assert {r["partition_id"]: r["lag"] for r in broker_lag(done, ends).collect()} == {0: 5, 1: -2}


def test_a_batch_opens_only_the_buckets_of_its_offsets(spark, folder):
    landing = Landing(spark, folder)
    for epoch, offset in enumerate((0, 5, 25_000, 25_001, 90_000)):
        landing.apply_records(frame(spark, [change("u", org(f"o{offset}"), offset, offset)]), "b", True, "check", epoch)
    assert spanned([{"first": 9_999, "last": 10_000}, {"first": 7, "last": 8}]) == {0, 1}
    schema = change_schema("organizations")
    opened = landing._read("organizations_cdc", schema, {2, 3}).inputFiles()
    assert opened and all("/bucket=2/" in f for f in opened)
    assert landing.changes("organizations").count() == 5
    ledger = [n for n in folders.names(spark, f"{folder}/_offsets/landing=check")]
    assert ledger == ["epoch=4"] and landing.offsets().first()["committed_offset"] == 90_001


# --- pace, progress and continuous state ----------------------------------

def test_pace_of_the_topics():
    options = topic_options("broker:9092", 8, Pace(most=1000, least=100, delay="30s"))
    assert options["maxOffsetsPerTrigger"] == "1000" and options["minOffsetsPerTrigger"] == "100" and options["maxTriggerDelay"] == "30s"
    assert options["subscribe"].count(",") == 5 and options["minPartitions"] == "8"
    assert "maxOffsetsPerTrigger" in topic_options("b", 1) and "maxOffsetsPerTrigger" not in Pace(most=None).options()
    with pytest.raises(ValueError):
        Pace(most=10, least=11).options()


def many_changes(n, seed=0):
    r, out = random.Random(seed), []
    for i in range(n):
        key = f"org-{r.randrange(7)}"
        if r.random() < 0.1:
            out.append(raw(i, None, f'{{"org_id":"{key}"}}'))
        elif r.random() < 0.1:
            out.append(raw(i, "broken"))
        else:
            out.append(change(r.choice("cud"), org(org_id=key, name=f"n{i}"), 100 + r.randrange(n), i))
    return out


def test_a_backlog_lands_in_bounded_batches_as_in_one(spark, folder):
    records = many_changes(60)
    for i in range(6):
        frame(spark, records[i * 10:(i + 1) * 10]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    landings, epochs = [Landing(spark, f"{folder}/{n}") for n in ("one", "many")], []
    for landing, files in zip(landings, (None, 1)):
        progress = ProgressTable(spark, f"{landing.root}-progress", every=2)
        spark.streams.addListener(progress)
        query = landing.start(read_change_files(spark, f"{folder}/in", files), f"{landing.root}-check", {"availableNow": True})
        query.awaitTermination()
        progress.wait(query.runId)
        spark.streams.removeListener(progress)
        found = progress.table().filter(F.col("run_id") == str(query.runId))
        epochs.append(sorted(r["input_rows"] for r in found.collect() if r["input_rows"]))
        total = rows_read(found).first()
        assert (total["input_rows"], total["query_id"]) == (60, str(query.id))
    assert epochs == [[60], [10] * 6]
    assert landed(landings[0]) == landed(landings[1]) and committed(landings[0]) == committed(landings[1])


def test_broker_ends_come_from_the_latest_offsets(spark):
    row = lambda epoch, latest: ("q", "r", epoch, "KafkaV2[Subscribe[a]]", None, None, latest, 5, "t")
    progress = spark.createDataFrame(
        [row(0, '{"a":{"0":5,"1":9}}'), row(1, '{"a":{"0":7,"1":9},"b":{"2":1}}'), row(2, None), row(3, '{"logOffset":3}'), row(4, "?")], PROGRESS)
    ends = broker_ends(progress)
    assert sorted(map(tuple, ends.collect())) == [("a", 0, 7), ("a", 1, 9), ("b", 2, 1)]
    ledger = spark.createDataFrame([("g", "a", 0, 4, None), ("g", "c", 0, 2, None)], "consumer_group string, topic string, partition_id long, committed_offset long, updated_at timestamp_ntz")
    _, lags = lag_report({"organizations": spark.createDataFrame([], change_schema("organizations"))}, ledger, ends)
    assert sorted(map(tuple, lags.collect())) == [("a", 0, 4, 7, 3), ("c", 0, 2, 0, -2)]


def test_landings_of_equal_size_have_different_signatures(spark):
    sign = lambda *pairs: tuple(landing_signature(spark.createDataFrame(pairs, "k string, _dedup_token string"), "k").first())
    assert sign(("a", "1"), ("a", "1")) != sign(("b", "2"), ("b", "2")) and sign(("a", "1"), ("b", "2")) == sign(("b", "2"), ("a", "1"))
    assert sign((None, "x"))[0] == 1 and landing_signature(spark.createDataFrame([], "k string, _dedup_token string"), "k").first()["digest"] == "0:0"


def test_continuous_state_equals_the_batch_form_after_restarts(spark, folder):
    records, lake = many_changes(90, seed=4), Lake(spark, f"{folder}/lake", key_parts=4)
    order = random.Random(9).sample(range(90), 90)  # files come in any order of offsets
    state, landing = CurrentState(lake, "organizations"), Landing(spark, f"{folder}/cdc")
    for i in range(3):
        frame(spark, [records[j] for j in order[i * 30:(i + 1) * 30]]).repartition(2).write.mode("append").parquet(f"{folder}/in")
        state.start(read_change_files(spark, f"{folder}/in", 1), f"{folder}/check", {"availableNow": True}).awaitTermination()
        landing.apply_records(spark.read.schema(RECORD_SCHEMA).parquet(f"{folder}/in"), f"b{i}")
        last = latest_change(landing.changes("organizations"), "org_id")
        columns = [c for c in last.columns if c not in ("_loaded_at", "_batch_id", "_source_system")]
        assert sorted(map(tuple, state.changes().select(columns).collect()), key=repr) == sorted(map(tuple, last.select(columns).collect()), key=repr)
        if i == 1:  # an epoch whose commit was lost runs again: the same rows are merged once more
            again = latest_changes(spark.read.schema(RECORD_SCHEMA).parquet(f"{folder}/in"), "organizations")
            lake.commit({state.name: lake.upsert(state.name, again, "org_id", change_schema("organizations"))})
    batch = spark.createDataFrame([("org-1", dt.datetime(2030, 1, 1)), ("org-99", dt.datetime(2020, 1, 1))], "org_id string, _loaded_at timestamp_ntz")
    nulls = {f.name: F.lit(None).cast(f.dataType) for f in raw_schema("organizations") if f.name not in batch.columns}
    sides = [current_entity(batch.withColumns(nulls), c, "organizations").select("org_id", "name") for c in (state.changes(), landing.changes("organizations"))]
    assert sorted(map(tuple, sides[0].collect()), key=repr) == sorted(map(tuple, sides[1].collect()), key=repr)


def test_last_changes_parse_a_record_once(spark):
    records = frame(spark, [change("c", org(), i, i) for i in range(4)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    alone = parse_envelopes(with_table(records).filter("_table = 'organizations'"), "organizations")
    assert 0 < plan(latest_changes(records, "organizations")).count("from_json") <= plan(alone).count("from_json")


def test_records_of_one_file_are_dealt_to_tasks(spark, folder):
    records, dealt = many_changes(60, seed=3), []
    frame(spark, records).coalesce(1).write.parquet(f"{folder}/in")

    def seen(batch, epoch):
        dealt.append((batch.select(F.spark_partition_id()).distinct().count(), sorted(batch.select("topic", "partition", "offset", "value").collect(), key=repr)))

    for tasks in (None, 3):
        stream = read_change_files(spark, f"{folder}/in", 1, min_partitions=tasks)
        stream.writeStream.foreachBatch(seen).option("checkpointLocation", f"{folder}/check-{tasks}").trigger(availableNow=True).start().awaitTermination()
    assert [n for n, _ in dealt] == [1, 3] and dealt[0][1] == dealt[1][1] and len(dealt[0][1]) == 60


def test_a_landing_keeps_its_bucket_size(spark, folder):
    Landing(spark, folder, bucket=3).apply_records(frame(spark, [change("c", org(), i, i) for i in range(8)]), "a")
    assert {n for n in folders.names(spark, f"{folder}/organizations_cdc") if n[0] == "b"} == {"bucket=0", "bucket=1", "bucket=2"}
    later = Landing(spark, folder, bucket=100)
    assert later.bucket == 3
    assert later.apply_records(frame(spark, [change("c", org(), i, i) for i in range(8)]), "b")["skipped"] == 8


def test_an_offset_never_goes_back_within_a_landing(spark, folder):
    landing = Landing(spark, folder)
    for epoch, at in enumerate((5, 2)):
        landing.apply_records(frame(spark, [change("c", org(), at, at)]), f"b{epoch}", True, "check", epoch)
    assert committed(landing) == {("saas.app.organizations", 0): 6}

"""Registered queries: each runs an operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.contracts import ENTITIES, PLAN_PRICE_CENTS
from revtide.operators import current, history, marts, movements, quality, reports, staging, upsert
from revtide.plans.oracle import compose, feed_sql, rule_sql
from revtide.plans.ingest import ingest, raw_table
from revtide.plans.publish import Publisher
from revtide.session import configure, shuffles_dropped, work_folder, written
from revtide.sources import samples
from revtide.sources.changes import publish_to_files, read_change_files
from revtide.sources.lake import Lake
from revtide.streaming import lag, promotion
from revtide.streaming.envelope import parse_envelopes, with_table
from revtide.streaming.current_state import CurrentState
from revtide.streaming.landing import Landing
from revtide.streaming.progress import ProgressTable, rows_read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = compose(sql)
        return fn

    return register


# --- frames shared by the queries -----------------------------------------

def live(spark, sf, name: str) -> DataFrame:
    return current.current_entity(
        samples.BATCH[name](spark, sf), samples.CHANGES[name](spark, sf), name
    )


def staged(spark, sf, name: str) -> DataFrame:
    return staging.STAGING[name](live(spark, sf, name))


def moved(spark, sf) -> DataFrame:
    """Movements of the batch events."""
    return movements.subscription_movements(
        staging.stg_subscription_events(samples.subscription_events(spark, sf))
    )


def dim(spark, sf) -> DataFrame:
    names = ("organizations", "subscriptions", "users", "logins")
    return marts.dim_organizations(*[staged(spark, sf, n) for n in names])


def fact(spark, sf) -> DataFrame:
    return marts.fct_logins(staged(spark, sf, "logins"), staged(spark, sf, "users"))


def activity(spark, sf) -> DataFrame:
    return marts.login_activity_daily(fact(spark, sf))


def named_moves(spark, sf) -> DataFrame:
    return reports.changes_with_org(
        marts.fct_plan_changes(moved(spark, sf)), staged(spark, sf, "organizations")
    )


# --- movements and the bridge ---------------------------------------------

@query("movements", "select * from movements")
def _(spark, sf):
    return moved(spark, sf)


@query("month_spine", "select month_start from months")
def _(spark, sf):
    return movements.month_spine(movements.month_bounds(moved(spark, sf)))


@query("org_month_mrr", """select org_id || '-' || month_start as org_month_key, month_start, org_id,
  mrr_cents_after, mrr_cents_after > 0 as is_paying from org_month""")
def _(spark, sf):
    return movements.org_month_mrr(moved(spark, sf))


@query("mrr_monthly", "select * from mrr_monthly")
def _(spark, sf):
    return movements.mrr_monthly(moved(spark, sf))


@query("mrr_monthly_from_states", "select * from mrr_monthly")
def _(spark, sf):
    """The bridge assembled from its parts: month states, flows and churn. What they share is written once."""
    moves = written(moved(spark, sf), "movements")
    states = written(movements.org_month_mrr(moves), "states")
    return movements.mrr_bridge(
        movements.ending_state(states), movements.month_flows(moves),
        movements.starting_churn(moves, states),
    )


@query("ending_state", "select * from ending")
def _(spark, sf):
    return movements.ending_state(movements.org_month_mrr(moved(spark, sf)))


@query("month_flows", "select * from flows")
def _(spark, sf):
    return movements.month_flows(moved(spark, sf))


@query("starting_churn", "select * from churned")
def _(spark, sf):
    moves = written(moved(spark, sf), "movements")
    return movements.starting_churn(moves, movements.org_month_mrr(moves))


@query("mrr_bridge_violations", """select month_start, beginning_mrr_cents, new_mrr_cents,
  expansion_mrr_cents, contraction_mrr_cents, churn_mrr_cents, reactivation_mrr_cents,
  ending_mrr_cents from mrr_monthly where ending_mrr_cents <> beginning_mrr_cents + new_mrr_cents
  + expansion_mrr_cents + contraction_mrr_cents + churn_mrr_cents + reactivation_mrr_cents""")
def _(spark, sf):
    return movements.bridge_violations(movements.mrr_monthly(moved(spark, sf)))


@query("churn_bounds_violations", """select month_start, active_orgs_start, churned_orgs,
  logo_churn_rate from mrr_monthly where logo_churn_rate < 0 or logo_churn_rate > 1
  or (active_orgs_start = 0 and logo_churn_rate is not null) or churned_orgs > active_orgs_start""")
def _(spark, sf):
    return movements.churn_bounds_violations(movements.mrr_monthly(moved(spark, sf)))


def _disturbed(spark, sf):
    """The bridge with a wrong flow every third month and a wrong churn every fifth."""
    months = movements.mrr_monthly(moved(spark, sf))
    place = F.year("month_start") * 12 + F.month("month_start")
    return months.withColumns({
        "churn_mrr_cents": F.col("churn_mrr_cents") + F.when(place % 3 == 0, 1).otherwise(0),
        "churned_orgs": F.when(place % 5 == 0, F.col("active_orgs_start") + 2).otherwise(F.col("churned_orgs")),
        "logo_churn_rate": F.when(place % 7 == 0, F.lit(1.5)).otherwise(F.col("logo_churn_rate")),
    })


_DISTURBED = """(select * replace (
    if((year(month_start) * 12 + month(month_start)) % 3 = 0, churn_mrr_cents + 1, churn_mrr_cents) as churn_mrr_cents,
    if((year(month_start) * 12 + month(month_start)) % 5 = 0, active_orgs_start + 2, churned_orgs) as churned_orgs,
    if((year(month_start) * 12 + month(month_start)) % 7 = 0, 1.5, logo_churn_rate) as logo_churn_rate)
  from mrr_monthly)"""


@query("mrr_bridge_violations_found", f"""select month_start, beginning_mrr_cents, new_mrr_cents,
  expansion_mrr_cents, contraction_mrr_cents, churn_mrr_cents, reactivation_mrr_cents, ending_mrr_cents
  from {_DISTURBED} where (year(month_start) * 12 + month(month_start)) % 3 = 0""")
def _(spark, sf):
    return movements.bridge_violations(_disturbed(spark, sf))


@query("churn_bounds_violations_found", f"""select month_start, active_orgs_start, churned_orgs, logo_churn_rate
  from {_DISTURBED} where logo_churn_rate = 1.5 or churned_orgs = active_orgs_start + 2""")
def _(spark, sf):
    return movements.churn_bounds_violations(_disturbed(spark, sf))


# --- current rows and staging ---------------------------------------------

@query("latest_change", """select * from organizations_cdc qualify row_number() over (
  partition by org_id order by _kafka_offset desc nulls last, _source_lsn desc nulls last) = 1""")
def _(spark, sf):
    return current.latest_change(samples.organizations_cdc(spark, sf).drop("_extra"), "org_id")


@query("current_entity", "select * from current_organizations")
def _(spark, sf):
    return live(spark, sf, "organizations")


@query("dedupe_logins", """select login_id, client_event_id, user_id, logged_in_at, recorded_at
  from deduped_logins""")
def _(spark, sf):
    return staging.dedupe_logins(live(spark, sf, "logins")).select(
        "login_id", "client_event_id", "user_id", "logged_in_at", "recorded_at"
    )


def _register_staging(name: str) -> None:
    @query(f"stg_{name}", f"select * from stg_{name}")
    def _(spark, sf):
        return staged(spark, sf, name)


for _name in ENTITIES:
    _register_staging(_name)


# --- marts ----------------------------------------------------------------

@query("user_counts", "select * from user_counts")
def _(spark, sf):
    return marts.user_counts(staged(spark, sf, "users"))


@query("last_login", "select * from last_login")
def _(spark, sf):
    return marts.last_login(staged(spark, sf, "logins"))


@query("dim_organizations", "select * from dim_organizations")
def _(spark, sf):
    return dim(spark, sf)


EARLY = "2024-01-20"


def _early_fact(spark, sf) -> DataFrame:
    """The login fact as a first run on 2024-01-20 builds it."""
    loaded = F.col("_loaded_at") <= samples.ntz(EARLY)
    early = current.current_entity(
        samples.logins(spark, sf).filter(loaded), samples.logins_cdc(spark, sf).filter(loaded),
        "logins",
    )
    return marts.fct_logins(staging.stg_logins(early), staged(spark, sf, "users"))


@query("fct_logins_first", "select * from early_fact")
def _(spark, sf):
    return _early_fact(spark, sf)


@query("fct_logins_incremental", """select * from early_fact
  where login_id not in (select login_id from late_fact) union all select * from late_fact""")
def _(spark, sf):
    """A second run merges what was loaded after the first into its result."""
    first = written(_early_fact(spark, sf), "early-fact")
    late = marts.fct_logins(staged(spark, sf, "logins"), staged(spark, sf, "users"), target=first)
    return upsert.upsert_by_key(first, late, "login_id")


def _two_runs(spark, sf) -> Publisher:
    """The login fact and its daily activity in a lake, published by a run on EARLY and a later one."""
    lake, users = Lake(spark, work_folder(spark, "facts")), staged(spark, sf, "users")
    for name, loaded in (("early", F.col("_loaded_at") <= samples.ntz(EARLY)), ("late", F.lit(True))):
        publisher, parts = Publisher(
            lake, lambda t, loaded=loaded: samples.BATCH[t](spark, sf).filter(loaded),
            lambda t, loaded=loaded: samples.CHANGES[t](spark, sf).filter(loaded)), {}
        logins = staging.stg_logins(current.current_entity(publisher.raw("logins"), publisher.changes("logins"), "logins"))
        fact_rows, days = publisher.login_fact({"stg_logins": logins, "stg_users": users}, parts, False, "2024-02-01")
        publisher.activity(fact_rows, days, parts, "2024-02-01")
        lake.commit(parts, schemas=publisher.schemas)
    return publisher


@query("fct_logins_changed", """select * from early_fact
  where login_id not in (select login_id from late_fact) union all select * from late_fact""")
def _(spark, sf):
    """The second run stages only what the new loads touch and rewrites only their key partitions."""
    return _two_runs(spark, sf).published("fct_logins").drop("_built_at")


@query("activity_restated", """select cast(logged_in_at as date) as activity_date, org_id, count(*) as login_count,
    count(*) filter (where success) as successful_login_count, count(distinct user_id) as distinct_users
  from (select * from early_fact where login_id not in (select login_id from late_fact) union all select * from late_fact)
  group by all""")
def _(spark, sf):
    """Only the days of newly merged logins are computed and overwritten in the second run."""
    return _two_runs(spark, sf).published("fct_login_activity_daily").drop("_built_at")


@query("fct_logins_full_refresh", "select * from fct_logins")
def _(spark, sf):
    return fact(spark, sf)


@query("login_activity_daily", "select * from activity")
def _(spark, sf):
    return activity(spark, sf)


@query("fct_plan_changes", "select * from movements")
def _(spark, sf):
    return marts.fct_plan_changes(moved(spark, sf))


@query("fct_invoices", "select * exclude (_loaded_at, _batch_id, _source_system) from stg_invoices")
def _(spark, sf):
    return marts.fct_invoices(staged(spark, sf, "invoices"))


@query("scd2_check", """select * exclude (cut), md5(subscription_id || '|' || cut) as scd_id,
  cut as valid_from, lead(cut) over w as valid_to, lead(cut) over w is null as is_current
from versions window w as (partition by subscription_id order by cut)""")
def _(spark, sf):
    """Three history runs over the subscriptions at three cut-off dates."""
    rows = None
    for cut in samples.HISTORY_CUTS:
        state = staging.stg_subscriptions(samples.subscriptions_at(spark, sf, cut))
        rows = history.subscriptions_history(rows, state, cut)
    return rows


@query("scd2_stored", """select * exclude (cut), md5(subscription_id || '|' || cut) as scd_id,
  cut as valid_from, lead(cut) over w as valid_to, lead(cut) over w is null as is_current
from versions window w as (partition by subscription_id order by cut)""")
def _(spark, sf):
    """The same runs over a history stored by state: closed versions added, open ones overwritten by key."""
    lake = Lake(spark, work_folder(spark, "history"))
    for cut in samples.HISTORY_CUTS:
        publisher, parts = Publisher(lake, None, None), {}
        state = staging.stg_subscriptions(samples.subscriptions_at(spark, sf, cut))
        publisher.subscription_history(state, parts, cut)
        lake.commit(parts, schemas=publisher.schemas)
    return publisher.published("subscriptions_history")


# --- batch loads ----------------------------------------------------------

@query("incremental_scan", """select invoice_id, org_id, subscription_id, amount_cents, currency,
  status, period_start, period_end, issued_at, paid_at, recorded_at from invoices
  where recorded_at >= (select max(recorded_at) from invoices) - interval 2 day""")
def _(spark, sf):
    source = samples.invoices(spark, sf)
    mark = source.agg(F.max("recorded_at")).first()[0]
    return upsert.incremental_scan(source, "invoices", mark)


def _reload(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Invoices loaded up to 2001-06-01, and a later scan with changed statuses."""
    source = samples.invoices(spark, sf)
    target = source.filter(F.col("recorded_at") <= samples.ntz("2001-06-01"))
    mark = target.agg(F.max("recorded_at")).first()[0]
    changed = source.withColumn("status", F.upper("status"))
    incoming = upsert.incremental_scan(changed, "invoices", mark)
    return target, upsert.stamp(incoming, "batch-2", "2001-09-01 00:00:00")


@query("upsert_by_key", """select * from invoices where recorded_at <= timestamp '2001-06-01'
    and invoice_id not in (select invoice_id from incoming)
  union all select * from incoming""")
def _(spark, sf):
    target, incoming = _reload(spark, sf)
    return upsert.upsert_by_key(target, incoming, "invoice_id")


@query("keyed_upsert", """select * from invoices where recorded_at <= timestamp '2001-06-01'
    and invoice_id not in (select invoice_id from incoming)
  union all select * from incoming""")
def _(spark, sf):
    """The same merge into a stored table, which rewrites only the key partitions that it falls into."""
    lake = Lake(spark, work_folder(spark, "upsert"))
    for rows in _reload(spark, sf):
        lake.commit({"invoices": lake.upsert("invoices", rows, "invoice_id", rows.schema, ["recorded_at"])})
    return lake.read("invoices", rows.schema)


@query("ingest_state", " union all ".join(
    f"select '{n}' as table_name, max({e.watermark}) as watermark, count(*) as rows_loaded, "
    f"'{e.mode}' as load_mode from {n}" for n, e in ENTITIES.items()))
def _(spark, sf):
    parts = [
        upsert.ingest_state(samples.BATCH[n](spark, sf), n, e.mode, "2024-01-31").drop("updated_at")
        for n, e in ENTITIES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("entity_counts", " union all ".join(
    f"select '{n}' as entity, count(*) as n_rows from {n}" for n in ENTITIES))
def _(spark, sf):
    return quality.entity_counts({n: samples.BATCH[n](spark, sf) for n in ENTITIES})


@query("drop_batch", """select * from both_batches where _batch_id <> 'batch-2'""")
def _(spark, sf):
    target, incoming = _reload(spark, sf)
    return upsert.drop_batch(target.unionByName(incoming), "batch-2")


@query("repair_negative_mrr", """select * replace (case when status <> 'past_due' then mrr_cents
  else case plan when 'trial' then 0 when 'starter' then 4900 when 'growth' then 19900
    when 'enterprise' then 99900 end end as mrr_cents) from stg_subscriptions""")
def _(spark, sf):
    subs = staged(spark, sf, "subscriptions")
    broken = F.when(F.col("status") == "past_due", -F.col("mrr_cents")).otherwise(F.col("mrr_cents"))
    return upsert.repair_negative_mrr(subs.withColumn("mrr_cents", broken), PLAN_PRICE_CENTS)


# --- data quality ---------------------------------------------------------

@query("duplicate_keys", """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
  group by all having count(*) > 1""")
def _(spark, sf):
    return quality.duplicate_keys(
        samples.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query("unique", "select user_id, count(*) as n_rows from events group by all having count(*) > 1")
def _(spark, sf):
    return quality.unique(samples.table(spark, sf, "events"), "user_id")


@query("not_null", "select * from stg_users where email is null")
def _(spark, sf):
    return quality.not_null(staged(spark, sf, "users"), "email")


@query("accepted_values", """select * from events where event_type not in ('click', 'view')
  and user_id > 10""")
def _(spark, sf):
    return quality.accepted_values(
        samples.table(spark, sf, "events"), "event_type", ["click", "view"], "user_id > 10"
    )


@query("relationships", """select user_id as orphan_key, count(*) as n_rows from stg_logins
  where user_id not in (select user_id from stg_users) group by all""")
def _(spark, sf):
    return quality.relationships(
        staged(spark, sf, "logins"), "user_id", staged(spark, sf, "users"), "user_id",
        "user_id is not null",
    )


@query("non_negative", "select * from customer where c_acctbal < 0")
def _(spark, sf):
    return quality.non_negative(samples.table(spark, sf, "customer"), "c_acctbal")


@query("canceled_has_timestamp",
       "select * from stg_subscriptions where status = 'canceled' and canceled_at is null")
def _(spark, sf):
    return quality.canceled_has_timestamp(staged(spark, sf, "subscriptions"))


@query("paid_has_timestamp", "select * from stg_invoices where status = 'paid' and paid_at is null")
def _(spark, sf):
    return quality.paid_has_timestamp(staged(spark, sf, "invoices"))


@query("no_duplicate_keys", " union all ".join(
    f"select cast({e.pk} as varchar) as entity_key, '{n}' as entity from stg_{n} "
    f"group by {e.pk} having count(*) > 1" for n, e in ENTITIES.items()))
def _(spark, sf):
    return quality.no_duplicate_keys({n: staged(spark, sf, n) for n in ENTITIES})


@query("duplicate_current_keys", " union all ".join(
    f"select cast({e.pk} as varchar) as entity_key, '{n}' as entity from stg_{n} "
    f"where cast({e.pk} as bigint) % 10 = 3" for n, e in ENTITIES.items()))
def _(spark, sf):
    """Every tenth key stands twice and must be found, in all six entities."""
    def doubled(df, pk):
        return df.unionByName(df.filter(F.col(pk).cast("bigint") % 10 == 3))

    return quality.no_duplicate_keys({n: doubled(staged(spark, sf, n), e.pk) for n, e in ENTITIES.items()})


@query("freshness", " union all ".join(
    f"select '{n}' as source, max(_loaded_at) as max_loaded_at, "
    "case when max(_loaded_at) is null or max(_loaded_at) < timestamp '2024-02-01 12:00' - interval 72 hour "
    "then 'error' when max(_loaded_at) < timestamp '2024-02-01 12:00' - interval 36 hour then 'warn' "
    f"else 'pass' end as status from {n}" for n in ENTITIES))
def _(spark, sf):
    clock = "2024-02-01 12:00:00"
    parts = [
        quality.freshness(samples.BATCH[n](spark, sf), clock).withColumn("source", F.lit(n))
        for n in ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)


@query("first_by", """select * from stg_subscriptions where status = 'active' and mrr_cents > 0
  order by subscription_id limit 1""")
def _(spark, sf):
    return quality.first_by(
        staged(spark, sf, "subscriptions"), "status = 'active' and mrr_cents > 0", "subscription_id"
    )


@query("with_total", """select org_id, org_name, count(*) over () as total from stg_organizations
  where status = 'churned'""")
def _(spark, sf):
    rows = staged(spark, sf, "organizations").filter("status = 'churned'")
    return quality.with_total(rows.select("org_id", "org_name"))


@query("publish_signature", """select 'fct_mrr_monthly' as mart, timestamp '2024-02-01' as built_at,
    count(*) as n_rows from mrr_monthly
  union all select 'dim_organizations', timestamp '2024-02-01', count(*) from dim_organizations""")
def _(spark, sf):
    stamped = [
        marts.with_built_at(df, "2024-02-01 00:00:00")
        for df in (movements.mrr_monthly(moved(spark, sf)), dim(spark, sf))
    ]
    return quality.publish_signature(*stamped)


# --- reports --------------------------------------------------------------

def _bridge(spark, sf) -> DataFrame:
    return movements.mrr_monthly(moved(spark, sf))


def _money_sql(x: str, plus: str = "") -> str:
    """Dollar text of a double; rounds halves to even like a number formatter."""
    return (f"(case when {x} < 0 then '−' when {x} > 0 then '{plus}' else '' end || '$' || "
            f"format('{{:,}}', cast(round_even(abs({x}), 0) as bigint)))")


@query("kpis", f"""select month_start, strftime(month_start, '%b %Y') as month_label,
  ending_mrr_cents / 100 as current_mrr, p_ending / 100 as previous_mrr,
  ending_mrr_cents / 100 - p_ending / 100 as mrr_change,
  case when p_ending = 0 then 0.0
    else (ending_mrr_cents / 100 - p_ending / 100) / (p_ending / 100) * 100 end as mrr_change_pct,
  active_orgs_end as customers, active_orgs_end - p_active as customer_change, logo_churn_rate,
  (logo_churn_rate - p_rate) * 100 as churn_points, churned_orgs, new_mrr_cents / 100 as new_mrr,
  new_orgs, expansion_mrr_cents / 100 as expansion_mrr,
  {_money_sql("(ending_mrr_cents / 100)")} as current_mrr_text,
  {_money_sql("(ending_mrr_cents / 100 - p_ending / 100)", "+")} as mrr_change_text,
  format('{{:.1f}}%', round(logo_churn_rate * 100, 1)) as churn_text
  from mrr_latest where p_month is not null""")
def _(spark, sf):
    return reports.kpis(_bridge(spark, sf))


@query("trend", """select month_start, strftime(month_start, '%b %Y') as month_label,
  ending_mrr_cents / 100 as ending_mrr, active_orgs_end as customers from mrr_monthly""")
def _(spark, sf):
    return reports.trend(_bridge(spark, sf))


@query("bridge_series", """select month_start, strftime(month_start, '%b %Y') as month_label,
  new_mrr_cents / 100 as new_mrr, expansion_mrr_cents / 100 as expansion_mrr,
  contraction_mrr_cents / 100 as contraction_mrr, churn_mrr_cents / 100 as churn_mrr,
  reactivation_mrr_cents / 100 as reactivation_mrr,
  ending_mrr_cents / 100 - beginning_mrr_cents / 100 as net_change from mrr_monthly""")
def _(spark, sf):
    return reports.bridge_series(_bridge(spark, sf))


_STEPS = [("Start", "beginning", "absolute"), ("New", "new", "relative"),
          ("Expansion", "expansion", "relative"), ("Reactivation", "reactivation", "relative"),
          ("Contraction", "contraction", "relative"), ("Churn", "churn", "relative"),
          ("End", "ending", "total")]


@query("waterfall", " union all ".join(
    f"select month_start, {i} as step, '{label}' as label, '{kind}' as measure, "
    f"{c}_mrr_cents / 100 as amount, "
    f"{_money_sql(f'({c}_mrr_cents / 100)', '+' if kind == 'relative' else '')} as amount_text "
    "from mrr_latest" for i, (label, c, kind) in enumerate(_STEPS, start=1)))
def _(spark, sf):
    return reports.waterfall(_bridge(spark, sf))


@query("by_plan", """select position, plan, mrr_cents, mrr, orgs, paying, active_users,
  case when paying > 0 then mrr / paying end as arpa from plans""")
def _(spark, sf):
    return reports.by_plan(dim(spark, sf))


@query("plan_share", """select plan, mrr,
  cast(mrr_cents as double) / cast(sum(mrr_cents) over () as double) as mrr_share from plans""")
def _(spark, sf):
    return reports.plan_share(reports.by_plan(dim(spark, sf)))


@query("daily_logins", """select activity_date, cast(sum(login_count) as bigint) as logins,
  cast(sum(successful_login_count) as bigint) as successful_logins,
  cast(sum(distinct_users) as bigint) as active_users from activity group by all""")
def _(spark, sf):
    return reports.daily_logins(activity(spark, sf))


@query("changes_with_org", "select * from moves")
def _(spark, sf):
    return named_moves(spark, sf)


@query("moves_per_month", """select strftime(occurred_month, '%Y-%m') as month,
  count(*) filter (where movement_type = 'new') as new,
  count(*) filter (where movement_type = 'expansion') as expansion,
  count(*) filter (where movement_type = 'reactivation') as reactivation,
  count(*) filter (where movement_type = 'contraction') as contraction,
  count(*) filter (where movement_type = 'churn') as churn
  from moves where movement_type <> 'other' group by all""")
def _(spark, sf):
    return reports.moves_per_month(moved(spark, sf))


@query("moves_summary", f"""select position, movement_type, events, mrr,
  {_money_sql("mrr", "+")} || ' · ' || events || ' events' as label
  from (select case movement_type when 'new' then 1 when 'expansion' then 2 when 'reactivation'
    then 3 when 'contraction' then 4 else 5 end as position, movement_type, count(*) as events,
    cast(sum(mrr_delta_cents) as bigint) / 100 as mrr
    from moves where movement_type <> 'other' group by movement_type)""")
def _(spark, sf):
    return reports.moves_summary(moved(spark, sf))


@query("recent_changes", f"""select event_id, strftime(occurred_at, '%b %d, %Y') as "when",
  org_name as customer, upper(movement_type[1]) || movement_type[2:] as movement,
  coalesce(nullif(from_plan, ''), '—') || ' → ' || case when movement_type = 'churn'
    then 'canceled' else coalesce(nullif(to_plan, ''), '—') end as from_to,
  {_money_sql("(mrr_delta_cents / 100)", "+")} as mrr_change
  from moves where movement_type <> 'other' order by occurred_at desc, event_id desc limit 8""")
def _(spark, sf):
    return reports.recent_changes(
        marts.fct_plan_changes(moved(spark, sf)), staged(spark, sf, "organizations")
    )


@query("reporting_numeric", """select month_start, cast(ending_mrr_cents as double) as ending_mrr_cents,
  logo_churn_rate, active_orgs_end from mrr_monthly""")
def _(spark, sf):
    return reports.to_reporting_numeric(
        _bridge(spark, sf).select("month_start", "ending_mrr_cents", "logo_churn_rate", "active_orgs_end")
    )


_TILE = """select {} as position, {} as label, {} as value, {} as detail, {} as direction from (select *, strftime(p_month, '%b %Y') as p_label,
    strftime(month_start, '%b %Y') as label, ending_mrr_cents / 100 - p_ending / 100 as change, active_orgs_end - p_active as customers,
    (logo_churn_rate - p_rate) * 100 as points from mrr_latest where p_month is not null)"""


def _signed_sql(x: str) -> str:
    return f"printf('%+.1f', round_even({x}, 1) + 0.0)"


def _direction_sql(x: str, up: str = "up", down: str = "down") -> str:
    return f"case when {x} > 0 then '{up}' when {x} < 0 then '{down}' else 'flat' end"


_PCT = "case when p_ending = 0 then 0.0 else change / (p_ending / 100) * 100 end"


@query("kpi_tiles", " union all ".join([
    _TILE.format(1, "'MRR, ' || label", _money_sql("(ending_mrr_cents / 100)"), f"p_label || ': ' || {_money_sql('(p_ending / 100)')}", "'flat'"),
    _TILE.format(2, "'MRR change'", _money_sql("change", "+"), f"{_signed_sql(_PCT)} || '%'", _direction_sql("change")),
    _TILE.format(3, "'Customers'", "cast(active_orgs_end as varchar)", "printf('%+d', customers)", _direction_sql("customers")),
    _TILE.format(4, "'Logo churn'", "coalesce(format('{:.1f}%', round_even(logo_churn_rate * 100, 1)), '–')",
                 f"coalesce({_signed_sql('points')} || ' points', '–') || ', ' || churned_orgs || ' lost'", _direction_sql("points", "down", "up")),
    _TILE.format(5, "'New MRR'", _money_sql("(new_mrr_cents / 100)"), "new_orgs || ' new'", _direction_sql("new_mrr_cents")),
    _TILE.format(6, "'Expansion MRR'", _money_sql("(expansion_mrr_cents / 100)"), "''", _direction_sql("expansion_mrr_cents")),
]))
def _(spark, sf):
    return reports.kpi_tiles(_bridge(spark, sf))


@query("report_header", """select count(*) as months, strftime(min(month_start), '%b %Y') as first_month,
    strftime(max(month_start), '%b %Y') as last_month, 'Feb 01, 2024 07:30' as built_at_text from mrr_monthly""")
def _(spark, sf):
    return reports.report_header(marts.with_built_at(_bridge(spark, sf), "2024-02-01 07:30:00"))


def _report(spark, sf, name: str) -> DataFrame:
    return reports.report_frames({
        "fct_mrr_monthly": _bridge(spark, sf), "dim_organizations": dim(spark, sf),
        "fct_login_activity_daily": activity(spark, sf), "fct_plan_changes": marts.fct_plan_changes(moved(spark, sf))})[name]


@query("report_mrr", "select " + ", ".join(
    f"cast({c} as double) as {c}" if c.endswith("_cents") else c for c in (
        "month_start", "beginning_mrr_cents", "new_mrr_cents", "expansion_mrr_cents", "contraction_mrr_cents", "churn_mrr_cents",
        "reactivation_mrr_cents", "ending_mrr_cents", "active_orgs_start", "active_orgs_end", "new_orgs", "churned_orgs", "logo_churn_rate")
) + " from mrr_monthly")
def _(spark, sf):
    return _report(spark, sf, "mrr")


@query("report_orgs", """select org_id, org_name, plan, subscription_status, cast(mrr_cents as double) as mrr_cents, seats, user_count,
    active_user_count, is_active, is_paying from dim_organizations""")
def _(spark, sf):
    return _report(spark, sf, "orgs")


@query("report_logins", """select activity_date, cast(sum(login_count) as bigint) as logins, cast(sum(successful_login_count) as bigint) as successful_logins,
    cast(sum(distinct_users) as bigint) as active_users from activity group by activity_date""")
def _(spark, sf):
    return _report(spark, sf, "logins")


@query("report_changes", """select m.event_id, m.occurred_at, m.occurred_month, m.movement_type, m.event_type, m.from_plan, m.to_plan,
    cast(m.mrr_delta_cents as double) as mrr_delta_cents, d.org_name from movements m left join dim_organizations d using (org_id)""")
def _(spark, sf):
    return _report(spark, sf, "changes")


# --- stream side tables ---------------------------------------------------

@query("landing_lag", " union all ".join(
    f"select '{n}' as table_name, count(*) as n_rows, max(_source_ts) as max_source_ts, "
    "max(_loaded_at) as max_loaded_at, date_diff('microsecond', max(_source_ts), max(_loaded_at)) "
    f"// 1000000 as lag_seconds from {n}_cdc" for n in ENTITIES))
def _(spark, sf):
    parts = [lag.landing_lag(samples.CHANGES[n](spark, sf), n) for n in ENTITIES]
    return reduce(DataFrame.unionByName, parts)


@query("broker_lag", """select c.topic, c.partition_id, committed_offset,
    coalesce(end_offset, 0) as end_offset, coalesce(end_offset, 0) - committed_offset as lag
  from (select 'saas.app.' || event_type as topic, user_id % 4 as partition_id,
      max(event_id) + 1 as committed_offset from events group by all) c
  left join (select 'saas.app.' || event_type as topic, user_id % 4 as partition_id,
      max(event_id) + 1 as end_offset from events where event_type <> 'error' group by all) e
  using (topic, partition_id)""")
def _(spark, sf):
    offsets = samples.table(spark, sf, "events").select(
        F.concat(F.lit("saas.app."), "event_type").alias("topic"),
        (F.col("user_id") % 4).alias("partition_id"), (F.col("event_id") + 1).alias("next"),
    )
    committed = offsets.groupBy("topic", "partition_id").agg(F.max("next").alias("committed_offset"))
    ends = offsets.filter("topic <> 'saas.app.error'").groupBy("topic", "partition_id").agg(
        F.max("next").alias("end_offset")
    )
    return lag.broker_lag(committed, ends)


@query("backfill_promoted", """select event_id, event_type, props as _extra,
  try_cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def _(spark, sf):
    changes = samples.table(spark, sf, "events").select(
        "event_id", "event_type", F.col("props").alias("_extra")
    )
    return promotion.backfill_promoted(changes, "k", "bigint")


# --- change stream --------------------------------------------------------

META = ["_op", "_source_lsn", "_kafka_topic", "_kafka_partition", "_kafka_offset", "_source_ts", "_deleted", "_dedup_token", "_extra"]
LANDED = ["table_name", "entity_id", "org_id", "name", "status", "updated_at", *META]
TOPICS = {"organizations": ("org_id", "name"), "users": ("user_id", "full_name")}


def _of_topics(read: Callable[[str], DataFrame], *more: str) -> DataFrame:
    """Both topics of the sample records in common columns."""
    return reduce(DataFrame.unionByName, [
        read(t).select(F.lit(t).alias("table_name"), F.col(pk).alias("entity_id"), "org_id", F.col(name).alias("name"), "status", "updated_at", *META, *more)
        for t, (pk, name) in TOPICS.items()])


def _record_files(spark, sf, root: str, records: DataFrame | None = None) -> str:
    """Change records as files in offset order, written in one pass."""
    records = samples.change_records(spark, sf) if records is None else records
    records.repartitionByRange(6, "offset").write.parquet(f"{root}/records")
    return f"{root}/records"


def _stream(spark, landing: Landing, files: str, checkpoint: str, files_per_batch=None) -> None:
    """Run the landing stream over the files until all are landed."""
    stream = read_change_files(spark, files, files_per_batch)
    landing.start(stream, checkpoint, {"availableNow": True}).awaitTermination()


def _landed(spark, sf, files_per_batch=None) -> tuple[Landing, str]:
    root = work_folder(spark, "landing")
    files, landing = _record_files(spark, sf, root), Landing(spark, f"{root}/cdc")
    _stream(spark, landing, files, f"{root}/checkpoint", files_per_batch)
    return landing, root


PARSED = [name for name in LANDED if name != "_deleted"]


@query("parse_envelopes", f"""select {", ".join(PARSED)}, cast(null as varchar) as error
    from landed_records
  union all select if(topic = 'saas.app.users', 'users', 'organizations'), null, null, null, null, null, null, null, topic,
    partition_id, offset_id, null, 'kafka:' || dead_letter_id, null, error
    from broken_records""")
def _(spark, sf):
    """Envelopes of both topics as typed columns; broken records carry their reason."""
    records = with_table(samples.change_records(spark, sf))
    parsed = _of_topics(lambda t: parse_envelopes(records.filter(F.col("_table") == t), t), "error")
    # The key of a broken record may still name an entity, and one without a body counts as a delete.
    good = F.col("error").isNull()
    return parsed.select(*[F.when(good, F.col(c)).alias(c) if c in ("entity_id", "org_id", "_op") else c for c in PARSED], "error")


@query("cdc_land", f"select {', '.join(LANDED)} from landed_records")
def _(spark, sf):
    """A stream of change records landed by micro-batches."""
    return _of_topics(_landed(spark, sf)[0].changes)


def _register_feed(name: str) -> None:
    @query(f"cdc_land_{name}", feed_sql(name))
    def _(spark, sf):
        """The feed of an entity with numbers, booleans, times and dates in all their forms, landed."""
        landing = Landing(spark, work_folder(spark, "feed"), bucket=10_000_000_000_000)
        landing.apply_records(samples.entity_feed(spark, sf, name), "feed")
        flags = {c: F.col(c).cast("bigint") for c, typ in ENTITIES[name].columns if typ == "boolean"}
        return landing.changes(name).drop("_loaded_at", "_batch_id", "_source_system").withColumns(flags)


for _name in ("logins", "invoices", "subscriptions", "subscription_events"):
    _register_feed(_name)


@query("cdc_paced", f"select {', '.join(LANDED)} from landed_records")
def _(spark, sf):
    """A backlog taken file by file gives what one batch gives."""
    return _of_topics(_landed(spark, sf, files_per_batch=1)[0].changes)


@query("dead_letters", "select * from broken_records")
def _(spark, sf):
    return _landed(spark, sf)[0].dead_letters().drop("_loaded_at", "_source_system")


@query("dead_letter_topic", "select dead_letter_id as key, payload as value from broken_records")
def _(spark, sf):
    """What goes to the dead-letter topic, in its file form: key and whole payload, each once."""
    root = work_folder(spark, "topic")
    landing = Landing(spark, f"{root}/cdc", publish=publish_to_files(f"{root}/topic"))
    landing.apply_records(samples.change_records(spark, sf), "topic")
    return spark.read.parquet(f"{root}/topic")


@query("dead_letter_reasons", """select topic || ':' || (user_id % 3) || ':' || event_id as dead_letter_id, topic,
    user_id % 3 as partition_id, event_id as offset_id,
    case event_id % 13 when 0 then 'no single json value in the payload' when 1 then 'bytes do not decode as utf-8'
      when 2 then 'json payload holds no object' when 3 then 'op is none of c, u, d, r' when 4 then 'no source block'
      when 5 then 'no row image for this op' when 6 then 'lsn does not read as a whole number'
      when 7 then 'ts_ms does not read as a time' when 8 then 'value of logged_in_at does not read as timestamp'
      when 9 then 'no value for key login_id' when 10 then 'tombstone without login_id in its key'
      when 11 then 'no single json value in the payload' else 'topic saas.app.not_a_table has no table' end as error,
    case event_id % 13 when 0 then length('broken ' || event_id) when 1 then null when 2 then length('[' || event_id || ']')
      when 3 then length('{"op":"x' || event_id || '"}') when 4 then length('{"op":"c","source":"{}"}') when 5 then length('{"op":"c","source":{},"before":{"login_id":"a"}}') when 6 then length('{"op":"c","source":{"lsn":"x"},"after":{"login_id":"a"}}') when 7 then length('{"op":"c","source":{"ts_ms":"soon"},"after":{"login_id":"a"}}')
      when 8 then length('{"op":"c","source":{},"after":{"login_id":"a","logged_in_at":true}}') when 9 then length('{"op":"c","source":{},"after":{"org_id":"a"}}') when 10 then 2 when 11 then 20000 else 2 end as payload_length
  from (select *, if(event_id % 13 = 12, 'saas.app.not_a_table', 'saas.app.logins') as topic from events)""")
def _(spark, sf):
    """Every reason for a dead letter; payloads are kept whole. Broken bytes have no length in characters."""
    landing = Landing(spark, work_folder(spark, "reasons"))
    landing.apply_records(samples.broken_feed(spark, sf), "reasons")
    length = F.when(~F.col("error").startswith("bytes"), F.length("payload")).cast("long")
    return landing.dead_letters().select("dead_letter_id", "topic", "partition_id", "offset_id", "error", length.alias("payload_length"))


@query("cdc_replay", """select table_name, count(*) as n_rows, count(distinct _dedup_token) as n_tokens, 0 as surplus
    from landed_records group by table_name""")
def _(spark, sf):
    """The whole input again under a new checkpoint adds and changes nothing."""
    landing, root = _landed(spark, sf)
    before = {t: landing.changes(t) for t in TOPICS}
    _stream(spark, landing, f"{root}/records", f"{root}/checkpoint-2")

    def audited(table: str) -> DataFrame:
        after = landing.changes(table)
        surplus = lag.assert_replay_safe(before[table], after, TOPICS[table][0]).agg(F.count("*").cast("int")).scalar()
        return after.agg(
            F.lit(table).alias("table_name"), F.count("*").alias("n_rows"),
            F.count_distinct("_dedup_token").alias("n_tokens"), surplus.alias("surplus"))

    return reduce(DataFrame.unionByName, map(audited, TOPICS))


@query("cdc_crash", """select 'saas-cdc-consumer' as consumer_group,
    'saas.app.' || case when user_id % 2 = 0 then 'organizations' else 'users' end as topic,
    user_id % 3 as partition_id, max(event_id) + 1 as committed_offset, 0 as inserted_again
  from events group by all""")
def _(spark, sf):
    """A batch that died after its write: the restart inserts nothing and commits."""
    landing = Landing(spark, work_folder(spark, "crash"))
    records = samples.change_records(spark, sf)
    landing.apply_records(records, "crashed", commit_offsets=False)
    again = landing.apply_records(records, "restart", commit_offsets=True)
    return landing.offsets().drop("updated_at").withColumn(
        "inserted_again", F.lit(again["inserted"])
    )


@query("cdc_poison", """select (select count(*) from events where event_type <> 'view') -
    (select count(*) from broken_records where error like 'tombstone%') as inserted,
  cast(0 as bigint) as skipped, (select count(*) from broken_records) as dead_letters,
  (select count(*) from events) - (select count(*) from broken_records) as parsed_changes,
  (select count(*) from broken_records) as parsed_dead_letters""")
def _(spark, sf):
    """Statistics of one batch in which broken records stand between valid ones."""
    landing = Landing(spark, work_folder(spark, "poison"))
    stats = landing.apply_records(samples.change_records(spark, sf), "poison")
    columns = ", ".join(f"{name} long" for name in stats)
    return spark.createDataFrame([tuple(stats.values())], columns)


@query("cdc_drift", """select table_name, entity_id, _kafka_offset,
    json_extract_string(_extra, '$.plan_note') as plan_note from landed_records""")
def _(spark, sf):
    """An unknown field is promoted between two batches and filled in for the first."""
    root = work_folder(spark, "drift")
    records = samples.change_records(spark, sf)
    early = F.col("offset") % 2 == 0
    Landing(spark, root).apply_records(records.filter(early), "before")
    landing = Landing(spark, root, {t: {"plan_note": "varchar"} for t in TOPICS})
    landing.apply_records(records.filter(~early), "after")
    return reduce(DataFrame.unionByName, [
        promotion.backfill_promoted(landing.changes(t), "plan_note", "varchar").select(
            F.lit(t).alias("table_name"), F.col(pk).alias("entity_id"), "_kafka_offset", "plan_note")
        for t, (pk, _) in TOPICS.items()])


_HALF = "cast(cast('0x' || substr(md5(entity_id || '|' || _dedup_token), {}, 15) as bigint) as hugeint)"


@query("landing_signature", f"""select table_name, count(*) as n_rows,
    cast(sum({_HALF.format(1)}) as varchar) || ':' || cast(sum({_HALF.format(16)}) as varchar) as digest
  from landed_records group by table_name""")
def _(spark, sf):
    landing = _landed(spark, sf)[0]
    return reduce(DataFrame.unionByName, [
        lag.landing_signature(landing.changes(t), pk).withColumn("table_name", F.lit(t)) for t, (pk, _) in TOPICS.items()])


@query("lag_report", """select topic, partition_id, max(if(offset_id % 2 = 0, offset_id + 1, null)) as committed_offset,
    max(offset_id) + 1 as end_offset, max(offset_id) + 1 - max(if(offset_id % 2 = 0, offset_id + 1, null)) as lag,
    (select count(*) from events where event_id % 2 = 0) as input_rows
  from (select 'saas.app.' || case when user_id % 2 = 0 then 'organizations' else 'users' end as topic,
    user_id % 3 as partition_id, event_id as offset_id from events)
  group by topic, partition_id having count_if(offset_id % 2 = 0) > 0""")
def _(spark, sf):
    """Half of the records landed by a stream: its ledger against the ends, and the rows it says it read."""
    root, landing = work_folder(spark, "lag"), Landing(spark, work_folder(spark, "lag-cdc"))
    records, progress = samples.change_records(spark, sf), ProgressTable(spark)
    files = _record_files(spark, sf, root, records.filter("offset % 2 = 0"))
    spark.streams.addListener(progress)
    try:
        running = landing.start(read_change_files(spark, files, 2), f"{root}/checkpoint", {"availableNow": True})
        running.awaitTermination()
        progress.wait(running.runId)
    finally:
        spark.streams.removeListener(progress)
    ends = records.groupBy("topic", F.col("partition").cast("long").alias("partition_id")).agg((F.max("offset") + 1).alias("end_offset"))
    _, offsets = lag.lag_report({t: landing.changes(t) for t in TOPICS}, landing.offsets(), ends)
    mine = rows_read(progress.table().filter(F.col("run_id") == str(running.runId)))
    return offsets.withColumn("input_rows", mine.agg(F.sum("input_rows")).scalar())


@query("current_from_stream", """select table_name, entity_id, name, status from (
  select *, row_number() over (partition by table_name, entity_id order by version desc, source desc) as n from (
    select 'organizations' as table_name, cast(org_id as varchar) as entity_id, name, status, false as gone, _loaded_at as version,
      0 as source from organizations
    union all
    select 'users', cast(user_id as varchar), full_name, status, false, _loaded_at, 0 from users
    union all
    select table_name, entity_id, name, status, _deleted, coalesce(_source_ts, timestamp '2100-01-01'), 1
    from landed_records qualify row_number() over (partition by table_name, entity_id order by _kafka_offset desc) = 1
  )) where n = 1 and not gone""")
def _(spark, sf):
    """Batch rows merged with the landed change tables.

    A tombstone has no source time and counts from when it landed.
    """
    landing = _landed(spark, sf)[0]
    return _current_of_topics(spark, sf, landing.changes)


ORACLES["current_continuous"] = ORACLES["current_from_stream"]


def _current_of_topics(spark, sf, changes: Callable[[str], DataFrame]) -> DataFrame:
    def one(table: str) -> DataFrame:
        pk, name = TOPICS[table]
        batch = samples.BATCH[table](spark, sf).withColumns({c: F.col(c).cast("string") for c in {pk, "org_id"}})
        return current.current_entity(batch, changes(table), table).select(
            F.lit(table).alias("table_name"), F.col(pk).alias("entity_id"), F.col(name).alias("name"), "status")

    return reduce(DataFrame.unionByName, map(one, TOPICS))


@query("current_continuous")
def _(spark, sf):
    """The last change of each key kept by a running stream that is stopped and goes on, merged with the batch."""
    root, lake = work_folder(spark, "state"), Lake(spark, work_folder(spark, "state-lake"))
    records, states = samples.change_records(spark, sf), {t: CurrentState(lake, t) for t in TOPICS}
    for part in (0, 1):  # the second half comes after the first run has ended
        records.filter(F.col("offset") % 2 == part).repartitionByRange(3, "offset").write.mode("append").parquet(f"{root}/records")
        for t, state in states.items():
            stream = read_change_files(spark, f"{root}/records", 2, min_partitions=2 * spark.sparkContext.defaultParallelism)
            state.start(stream, f"{root}/checkpoint-{t}", {"availableNow": True}).awaitTermination()
    return _current_of_topics(spark, sf, lambda t: states[t].changes())


# --- whole runs -----------------------------------------------------------

#: What the second load of `ingest` brings changed, and how far the first one of each incremental table goes.
_CHANGED = {"organizations": "name", "users": "full_name", "subscriptions": "plan", "logins": "idp", "subscription_events": "event_type", "invoices": "status"}
_FIRST_LOAD = {"logins": "2024-01-20", "subscription_events": "2001-06-01", "invoices": "2001-06-01"}


def _ingested_sql(table: str) -> str:
    """Every row's key and the digest of its columns after both loads."""
    entity, column = ENTITIES[table], _CHANGED[table]
    changed = f"upper({column})"
    if table in _FIRST_LOAD:
        mark = (f"(select max({entity.watermark}) from {table} where {entity.watermark} <= timestamp '{_FIRST_LOAD[table]}')")
        changed = f"if({entity.watermark} >= {mark} - interval 2 day, upper({column}), {column})"
    texts = {"timestamp": "cast(epoch_us({}) as varchar)", "date": "cast(date_diff('day', date '1970-01-01', {}) as varchar)"}
    parts = ", ".join(f"coalesce({texts.get(typ, 'cast({} as varchar)').format(changed if c == column else c)}, '~')" for c, typ in entity.columns)
    return f"select '{table}' as table_name, cast({entity.pk} as varchar) as entity_id, md5(concat_ws('|', {parts})) as row_md5 from {table}"


@query("ingest", " union all ".join(map(_ingested_sql, ENTITIES)))
def _(spark, sf):
    """Two batch runs over all tables: a first load, then what the lookback and full tables bring again."""
    lake = Lake(spark, work_folder(spark, "lake"))

    def first(table: str) -> DataFrame:
        rows = samples.BATCH[table](spark, sf)
        return rows.filter(F.col(ENTITIES[table].watermark) <= samples.ntz(_FIRST_LOAD[table])) if table in _FIRST_LOAD else rows

    ingest(lake, first)
    ingest(lake, lambda table: samples.BATCH[table](spark, sf).withColumn(_CHANGED[table], F.upper(_CHANGED[table])))

    def digested(table: str) -> DataFrame:
        texts = {"timestamp": "cast(unix_micros(to_utc_timestamp(cast({} as string), 'UTC')) as string)", "date": "cast(unix_date({}) as string)"}
        parts = ", ".join(f"coalesce({texts.get(typ, 'cast({} as string)').format(c)}, '~')" for c, typ in ENTITIES[table].columns)
        return raw_table(lake, table).selectExpr(f"'{table}' as table_name", f"{ENTITIES[table].pk} as entity_id", f"md5(concat_ws('|', {parts})) as row_md5")

    return reduce(DataFrame.unionByName, map(digested, ENTITIES))


def _gate_inputs(spark, sf, events: DataFrame | None = None):
    """Batch and change frames that pass the gate: no organization is deleted. `events`: the batch events, if they are written already."""
    def batch(table: str) -> DataFrame:
        return events if table == "subscription_events" and events is not None else samples.BATCH[table](spark, sf)

    def changes(table: str) -> DataFrame:
        if table == "subscription_events":
            return samples.subscription_events_cdc(spark, sf, events)
        rows = samples.CHANGES[table](spark, sf)
        return rows.withColumn("_deleted", F.lit(False)) if table == "organizations" else rows

    return batch, changes


@query("run_checks", " union all ".join(rule_sql(r) for r in quality.UPSTREAM_RULES))
def _(spark, sf):
    """All upstream rules over the staged entities, movements and month states."""
    lake = Lake(spark, work_folder(spark, "checks"))
    publisher = Publisher(
        lake, lambda t: samples.BATCH[t](spark, sf), lambda t: samples.CHANGES[t](spark, sf)
    )
    return quality.run_checks(publisher.upstream({}), quality.UPSTREAM_RULES)


@query("stale_blocks_publish", " union all ".join(
    f"select 'freshness.{n}' as rule, case when max(_loaded_at) < timestamp '2024-02-02' - interval 72 hour then 'error' "
    "when max(_loaded_at) < timestamp '2024-02-02' - interval 36 hour then 'warn' else 'error' end as severity, "
    "cast(max(_loaded_at) < timestamp '2024-02-02' - interval 36 hour as bigint) as failures, false as published "
    f"from {n}" for n in ENTITIES))
def _(spark, sf):
    """By default old sources stop a publication before anything is built."""
    lake = Lake(spark, work_folder(spark, "stale"))
    outcome = Publisher(lake, *_gate_inputs(spark, sf)).publish("2024-02-02 00:00:00")
    if outcome.stage != "freshness" or lake.version():
        raise RuntimeError("stale sources were published")
    return outcome.checks.select("rule", "severity", "failures", F.lit(outcome.published).alias("published"))


@query("fct_logins_new_column", """select login_id, 'DE' as region from (
    select * from logins where login_id % 2 = 1)
  union all select login_id, null from (select * from logins where login_id % 2 = 0)""")
def _(spark, sf):
    """A published table whose later segment has one more column keeps it for all rows."""
    lake = Lake(spark, work_folder(spark, "columns"))
    logins = samples.logins(spark, sf).select("login_id")
    first = lake.write("fct_logins", logins.filter("login_id % 2 = 0"))
    lake.commit({"fct_logins": [first]}, schemas={"fct_logins": logins.schema})
    later = logins.filter("login_id % 2 = 1").withColumn("region", F.lit("DE"))
    lake.commit({"fct_logins": [first, lake.write("fct_logins", later)]}, schemas={"fct_logins": later.schema})
    return Publisher(lake, *_gate_inputs(spark, sf)).published("fct_logins")


_BAD = {"fct_mrr_monthly": "bad_mrr_monthly", "fct_plan_changes": "bad_plan_changes", "fct_logins": "bad_logins",
        "fct_login_activity_daily": "bad_activity", "dim_organizations": "bad_dim", "fct_invoices": "bad_invoices",
        "subscriptions_history": "bad_history"}


@query("mart_rules_found", " union all ".join(rule_sql(r, _BAD) for r in quality.MART_RULES))
def _(spark, sf):
    """Every rule over marts in which rows break it."""
    def unless(test: str, column: str, other: str = "null") -> dict[str, Column]:
        return {column: F.expr(f"if({test}, {other}, {column})")}

    def bad(df: DataFrame, again: str, **changed) -> DataFrame:
        return df.select(*[changed.get(c, F.col(c)).alias(c) for c in df.columns]).union(df.filter(again))

    month, bridge = "month(month_start)", movements.mrr_monthly(moved(spark, sf))
    ending = F.expr(f"case {month} when 4 then -1 when 5 then null else ending_mrr_cents end")
    opening = F.expr(f"case {month} when 3 then null when 8 then -1 else beginning_mrr_cents end")
    amount = F.expr("case invoice_id % 7 when 0 then null when 1 then -amount_cents else amount_cents end")
    runs = None
    for cut in samples.HISTORY_CUTS:
        runs = history.subscriptions_history(runs, staging.stg_subscriptions(samples.subscriptions_at(spark, sf, cut)), cut)
    frames = {
        "fct_mrr_monthly": bad(
            bridge, f"{month} = 7", **unless(f"{month} = 2", "month_start"), beginning_mrr_cents=opening, ending_mrr_cents=ending,
            **unless(f"{month} = 6", "logo_churn_rate", "1.5D")),
        "fct_plan_changes": bad(
            marts.fct_plan_changes(moved(spark, sf)), "event_id % 11 = 0", **unless("event_id % 5 = 0", "event_id"), **unless("event_id % 7 = 0", "movement_type")),
        "fct_logins": bad(
            fact(spark, sf), "login_id % 9 = 0", **unless("login_id % 5 = 0", "login_id"), **unless("login_id % 6 = 0", "org_id"),
            **unless("login_id % 7 = 0", "logged_in_at")),
        "fct_login_activity_daily": bad(
            activity(spark, sf), "false", **unless("org_id % 3 = 0", "activity_date"), **unless("org_id % 4 = 0", "org_id"), **unless("org_id % 5 = 0", "login_count")),
        "dim_organizations": bad(
            dim(spark, sf), "org_id % 7 = 0", **unless("org_id % 3 = 0", "org_id"), **unless("org_id % 4 = 0", "is_active"), **unless("org_id % 5 = 0", "is_paying")),
        "fct_invoices": bad(
            marts.fct_invoices(staged(spark, sf, "invoices")), "invoice_id % 9 = 0", **unless("invoice_id % 5 = 0", "invoice_id"), amount_cents=amount),
        "subscriptions_history": bad(runs, "false", **unless("subscription_id % 3 = 0", "subscription_id")),
    }
    return quality.run_checks(frames, quality.MART_RULES)


@query("run_mart_checks", " union all ".join(
    f"select '{r.name}' as rule, '{r.severity}' as severity, cast(0 as bigint) as failures" for r in quality.MART_RULES))
def _(spark, sf):
    """All rules over the marts of a clean publication."""
    raw, changes = _gate_inputs(spark, sf)
    lake = Lake(spark, work_folder(spark, "marts"))
    outcome = Publisher(lake, raw, changes).publish("2024-02-01 00:00:00", check_freshness=False)
    names = [r.name for r in quality.MART_RULES]
    return outcome.checks.filter(F.col("rule").isin(*names)).select("rule", "severity", "failures")


@query("gate_blocks_publish", """select 'fct_mrr_monthly' as mart,
    timestamp '2024-02-01' as built_at, count(*) as n_rows, true as unchanged, false as moved from mrr_monthly
  union all select 'dim_organizations', timestamp '2024-02-01',
    (select count(*) from (select org_id from organizations union select org_id from organizations_cdc)),
    true, false""")
def _(spark, sf):
    """A negative amount stops the second publication; the first stays as it was."""
    with shuffles_dropped(spark):  # both publications read the events twice
        events = written(samples.subscription_events(spark, sf), "events")
    raw, changes = _gate_inputs(spark, sf, events)
    lake = Lake(spark, work_folder(spark, "gate"))

    def signature() -> DataFrame:
        reader = Publisher(lake, raw, changes)
        return quality.publish_signature(
            reader.published("fct_mrr_monthly"), reader.published("dim_organizations")
        )

    def broken(table: str) -> DataFrame:
        rows = changes(table)
        return rows.withColumn("mrr_cents", F.lit(-500)) if table == "subscriptions" else rows

    if not Publisher(lake, raw, changes).publish("2024-02-01 00:00:00", check_freshness=False).published:
        raise RuntimeError("the clean input did not pass the gate")
    before = signature()
    if Publisher(lake, raw, broken).publish("2024-02-02 00:00:00", check_freshness=False).published:
        raise RuntimeError("a negative amount passed the gate")
    after = signature()
    return after.join(quality.gate_audit(before, after), "mart")

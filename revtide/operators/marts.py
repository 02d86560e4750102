"""Published tables: organization dimension, facts and daily activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.functions import count_true, day_of
from revtide.operators.current import current_entity
from revtide.operators.staging import stg_logins


def with_built_at(df: DataFrame, built_at) -> DataFrame:
    """Stamp a build with one driver-fixed time."""
    return df.withColumn("_built_at", F.lit(built_at).cast("timestamp_ntz"))


def user_counts(users: DataFrame) -> DataFrame:
    return users.groupBy("org_id").agg(
        F.count("*").alias("user_count"),
        count_true(F.col("status") == "active").alias("active_user_count"),
    )


def last_login(logins: DataFrame) -> DataFrame:
    return logins.groupBy("org_id").agg(
        F.max(F.when(F.col("success"), F.col("logged_in_at"))).alias("last_successful_login_at")
    )


def dim_organizations(
    orgs: DataFrame, subs: DataFrame, users: DataFrame, logins: DataFrame
) -> DataFrame:
    """Organizations with subscription, user counts and last login.

    Users and logins are reduced to one row per organization before the join.
    """
    subscription = subs.selectExpr(
        "org_id", "subscription_id", "plan", "status as subscription_status", "mrr_cents", "seats",
        "started_at as subscription_started_at", "canceled_at",
    )
    organization = orgs.selectExpr(
        "org_id", "org_name", "domain", "industry", "employee_band", "country_code",
        "status as org_status", "created_at",
    )
    joined = (
        organization.join(subscription, "org_id", "left")
        .join(user_counts(users), "org_id", "left")
        .join(last_login(logins), "org_id", "left")
    )
    return joined.selectExpr(
        "org_id", "org_name", "domain", "industry", "employee_band", "country_code", "org_status",
        "created_at", "subscription_id", "plan", "subscription_status", "mrr_cents", "seats",
        "subscription_started_at", "canceled_at", "coalesce(user_count, 0) as user_count",
        "coalesce(active_user_count, 0) as active_user_count", "last_successful_login_at",
        "coalesce(org_status = 'active' "
        "and subscription_status in ('trialing', 'active', 'past_due'), false) as is_active",
        "coalesce(mrr_cents > 0 and subscription_status in ('active', 'past_due'), false) "
        "as is_paying",
    )


def flag_known(logins: DataFrame, users: DataFrame) -> DataFrame:
    """Mark logins whose user exists; orphans are kept.

    The right side is one row per user. A user (or a null) that owns a large
    share of the logins is split at run time by the adaptive skew join, which
    `session.RUNTIME` turns on.
    """
    known = users.select("user_id").distinct().withColumn("_known", F.lit(True))
    flagged = logins.join(known, "user_id", "left")
    return flagged.withColumn("is_known_user", F.coalesce("_known", F.lit(False))).drop("_known")


def high_water_mark(target: DataFrame, column: str = "_loaded_at"):
    """Largest load time of a table, 1970-01-01 when it is empty."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return target.agg(F.coalesce(F.max(column), start).alias("mark")).first()["mark"]


def fct_logins(staged: DataFrame, users: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Login fact rows to merge by login_id.

    Without a target: every staged login. With one: only rows loaded after
    the newest row of the target. Load time, not login time, decides, so a
    login that is recorded late is still picked up. `changed_logins` stages
    just those rows.
    """
    if target is not None:
        mark = F.lit(high_water_mark(target)).cast("timestamp_ntz")
        staged = staged.filter(F.col("_loaded_at") > mark)
    columns = [
        "login_id", "client_event_id", "user_id", "org_id", "idp", "success", "ip_country",
        "logged_in_at", "recorded_at", "is_late_arriving",
    ]
    return flag_known(staged.select(*columns, "_loaded_at"), users).select(
        *columns, "is_known_user", "_loaded_at"
    )


def changed_logins(batch: DataFrame, changes: DataFrame, mark) -> DataFrame:
    """The staged logins loaded after `mark`, without staging all of them.

    A load of a login can change its own row and which login of its retry group is kept.
    So: the retry groups of all rows loaded after the mark, the logins that have any row in
    such a group, and the usual current row and retry rules over those logins alone. The
    first two scans read keys and load times only, the third joins all columns to the few.
    """
    late = F.col("_loaded_at") > F.lit(mark).cast("timestamp_ntz")
    event = F.coalesce("client_event_id", "login_id").alias("_event")
    keys = [df.select("login_id", event, "_loaded_at") for df in (batch, changes)]
    groups = keys[0].filter(late).union(keys[1].filter(late)).select("_event").distinct()
    members = keys[0].union(keys[1]).join(groups, "_event", "left_semi").select("login_id").distinct()
    few = [df.join(members, "login_id", "left_semi") for df in (batch, changes)]
    return stg_logins(current_entity(*few, "logins")).filter(late)


ACTIVITY_DAY = "coalesce(cast(cast({} as date) as string), 'none')"


def touched_days(rows: DataFrame, target: DataFrame) -> set[str]:
    """The days whose activity a merge of `rows` into the fact changes: theirs, and those they leave.

    One text per day comes to the driver; 'none' is for logins without a time.
    """
    before = target.join(rows.select("login_id"), "login_id", "left_semi")
    day = F.expr(ACTIVITY_DAY.format("logged_in_at")).alias("day")
    return {r["day"] for r in rows.select(day).union(before.select(day)).distinct().collect()}


def restated_activity(fact: DataFrame, days: set[str]) -> DataFrame:
    """Daily activity of some days, from all their logins."""
    known, at = sorted(days - {"none"}), F.col("logged_in_at")
    wanted = F.lit(False)
    if known:
        first, last = (F.lit(d).cast("date").cast("timestamp_ntz") for d in (known[0], known[-1]))
        wanted = (at >= first) & (at < last + F.expr("interval 1 day")) & day_of(at).cast("string").isin(known)
    if "none" in days:
        wanted = wanted | at.isNull()
    return login_activity_daily(fact.filter(wanted))


def login_activity_daily(fact: DataFrame) -> DataFrame:
    """Daily logins per organization, rebuilt in full so late rows restate their day."""
    return fact.groupBy(day_of(F.col("logged_in_at")).alias("activity_date"), "org_id").agg(
        F.count("*").alias("login_count"),
        count_true(F.col("success")).alias("successful_login_count"),
        F.count_distinct("user_id").alias("distinct_users"),
    )


def fct_plan_changes(movements: DataFrame) -> DataFrame:
    return movements.select(
        "event_id", "subscription_id", "org_id", "event_type", "movement_type", "from_plan",
        "to_plan", "mrr_cents_before", "mrr_cents_after", "mrr_delta_cents", "occurred_at",
        "recorded_at", "occurred_month", "is_late_arriving",
    )


def fct_invoices(staged: DataFrame) -> DataFrame:
    return staged.select(
        "invoice_id", "org_id", "subscription_id", "amount_cents", "currency", "status",
        "period_start", "period_end", "issued_at", "paid_at", "recorded_at",
    )

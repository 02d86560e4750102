"""Report frames behind the dashboard panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.contracts import MOVEMENT_ORDER, PLAN_ORDER
from revtide.functions import (
    capitalized,
    count_true,
    display_rank,
    money,
    month_label,
    pct,
    safe_ratio,
    to_units,
    transition,
)
from revtide.operators.movements import FLOWS

# The columns that reports read of an organization.
ORGS_READ = [
    "org_id", "org_name", "plan", "subscription_status", "mrr_cents", "seats", "user_count",
    "active_user_count", "is_active", "is_paying",
]


def to_reporting_numeric(df: DataFrame) -> DataFrame:
    """Cent and rate columns as doubles; text that is no number becomes null."""
    names = [c for c in df.columns if c.endswith("_cents") or c == "logo_churn_rate"]
    return df.withColumns({c: F.col(c).try_cast("double") for c in names})


def daily_logins(activity: DataFrame) -> DataFrame:
    """Day totals; a user active in two organizations counts twice."""
    return activity.groupBy("activity_date").agg(
        F.sum("login_count").alias("logins"),
        F.sum("successful_login_count").alias("successful_logins"),
        F.sum("distinct_users").alias("active_users"),
    )


def changes_with_org(changes: DataFrame, orgs: DataFrame) -> DataFrame:
    """Plan changes with the organization's name.

    The organization side holds one row per key; the adaptive join broadcasts
    it when its measured size is under the threshold and splits hot keys of
    the change side otherwise.
    """
    return changes.join(orgs.select("org_id", "org_name"), "org_id", "left").select(
        "event_id", "occurred_at", "occurred_month", "movement_type", "event_type", "from_plan",
        "to_plan", "mrr_delta_cents", "org_name",
    )


def report_frames(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four frames a report reads, numbers coerced, in report order."""
    frames = {
        "mrr": marts["fct_mrr_monthly"].orderBy("month_start"),
        "orgs": marts["dim_organizations"].select(*ORGS_READ),
        "logins": daily_logins(marts["fct_login_activity_daily"]).orderBy("activity_date"),
        "changes": changes_with_org(
            marts["fct_plan_changes"], marts["dim_organizations"]
        ).orderBy("occurred_at"),
    }
    return {name: to_reporting_numeric(df) for name, df in frames.items()}


def _latest_month(bridge: DataFrame) -> DataFrame:
    """Last month with the month before it alongside; one row per month goes in."""
    months = Window.orderBy("month_start")
    carried = ["month_start", "ending_mrr_cents", "active_orgs_end", "logo_churn_rate"]
    lagged = bridge.withColumns({f"previous_{c}": F.lag(c).over(months) for c in carried})
    return lagged.orderBy(F.desc("month_start")).limit(1)


def kpis(bridge: DataFrame) -> DataFrame:
    """Headline numbers of the latest month; no row with fewer than two months."""
    return _headline(bridge).drop("previous_label")


def _headline(bridge: DataFrame) -> DataFrame:
    now, before = to_units(F.col("ending_mrr_cents")), to_units(F.col("previous_ending_mrr_cents"))
    change = now - before
    points = (F.col("logo_churn_rate") - F.col("previous_logo_churn_rate")) * 100
    return _latest_month(bridge).filter("previous_month_start is not null").select(
        "month_start", month_label(F.col("month_start")).alias("month_label"),
        now.alias("current_mrr"), before.alias("previous_mrr"), change.alias("mrr_change"),
        F.when(before == 0, F.lit(0.0)).otherwise(change / before * 100).alias("mrr_change_pct"),
        F.col("active_orgs_end").alias("customers"),
        (F.col("active_orgs_end") - F.col("previous_active_orgs_end")).alias("customer_change"),
        "logo_churn_rate", points.alias("churn_points"), "churned_orgs",
        to_units(F.col("new_mrr_cents")).alias("new_mrr"), "new_orgs",
        to_units(F.col("expansion_mrr_cents")).alias("expansion_mrr"),
        money(now).alias("current_mrr_text"), money(change, signed=True).alias("mrr_change_text"),
        pct(F.col("logo_churn_rate")).alias("churn_text"), month_label(F.col("previous_month_start")).alias("previous_label"),
    )


def report_header(bridge: DataFrame) -> DataFrame:
    """Months of history, their first and last, and when the tables were built; one row."""
    built = F.date_format(F.max("_built_at"), "MMM dd, yyyy HH:mm")
    return bridge.agg(
        F.count("*").alias("months"), month_label(F.min("month_start")).alias("first_month"),
        month_label(F.max("month_start")).alias("last_month"), built.alias("built_at_text"))


def _signed(value: Column, unit: str = "") -> Column:
    """One place after the point and always a sign; halves to even."""
    return F.when(value.isNotNull(), F.format_string(f"%+.1f{unit}", F.bround(value, 1) + F.lit(0.0)))


def _direction(value: Column, good: str = "up") -> Column:
    """up is good news, down is bad, flat is no change."""
    bad = {"up": "down", "down": "up"}[good]
    return F.when(value > 0, good).when(value < 0, bad).otherwise("flat")


def kpi_tiles(bridge: DataFrame) -> DataFrame:
    """The headline numbers as texts: (position, label, value, detail, direction); six rows."""
    row, none = _headline(bridge), F.lit("–")

    def tile(position: int, label: Column, value: Column, detail: Column, direction: Column) -> Column:
        return F.struct(F.lit(position).alias("position"), label.alias("label"), value.alias("value"),
                        detail.alias("detail"), direction.alias("direction"))

    tiles = [
        tile(1, F.concat(F.lit("MRR, "), "month_label"), F.col("current_mrr_text"),
             F.concat("previous_label", F.lit(": "), money(F.col("previous_mrr"))), F.lit("flat")),
        tile(2, F.lit("MRR change"), F.col("mrr_change_text"), _signed(F.col("mrr_change_pct"), "%%"), _direction(F.col("mrr_change"))),
        tile(3, F.lit("Customers"), F.col("customers").cast("string"), F.format_string("%+d", "customer_change"), _direction(F.col("customer_change"))),
        tile(4, F.lit("Logo churn"), F.coalesce("churn_text", none),
             F.concat(F.coalesce(_signed(F.col("churn_points"), " points"), none), F.lit(", "), F.col("churned_orgs").cast("string"), F.lit(" lost")),
             _direction(F.col("churn_points"), good="down")),
        tile(5, F.lit("New MRR"), money(F.col("new_mrr")), F.concat(F.col("new_orgs").cast("string"), F.lit(" new")), _direction(F.col("new_mrr"))),
        tile(6, F.lit("Expansion MRR"), money(F.col("expansion_mrr")), F.lit(""), _direction(F.col("expansion_mrr"))),
    ]
    return row.select(F.inline(F.array(*tiles)))


def trend(bridge: DataFrame) -> DataFrame:
    return bridge.select(
        "month_start", month_label(F.col("month_start")).alias("month_label"),
        to_units(F.col("ending_mrr_cents")).alias("ending_mrr"),
        F.col("active_orgs_end").alias("customers"),
    )


def bridge_series(bridge: DataFrame) -> DataFrame:
    net = to_units(F.col("ending_mrr_cents")) - to_units(F.col("beginning_mrr_cents"))
    return bridge.select(
        "month_start", month_label(F.col("month_start")).alias("month_label"),
        *[to_units(F.col(f"{flow}_mrr_cents")).alias(f"{flow}_mrr") for flow in FLOWS],
        net.alias("net_change"),
    )


def waterfall(bridge: DataFrame) -> DataFrame:
    """The latest month as seven ordered steps."""
    steps = [("Start", "beginning", "absolute")]
    steps += [(flow.capitalize(), flow, "relative") for flow in
              ("new", "expansion", "reactivation", "contraction", "churn")]
    steps += [("End", "ending", "total")]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"), F.lit(label).alias("label"), F.lit(kind).alias("measure"),
                to_units(F.col(f"{column}_mrr_cents")).alias("amount"),
                money(to_units(F.col(f"{column}_mrr_cents")), kind == "relative").alias("amount_text"),
            )
            for i, (label, column, kind) in enumerate(steps, start=1)
        ]
    )
    return _latest_month(bridge).select("month_start", F.inline(rows))


def by_plan(orgs: DataFrame) -> DataFrame:
    """Customers and revenue per known plan, with revenue per paying customer."""
    totals = orgs.filter(F.col("plan").isin(*PLAN_ORDER)).groupBy("plan").agg(
        F.coalesce(F.sum("mrr_cents"), F.lit(0)).alias("mrr_cents"),
        F.count("org_id").alias("orgs"),
        count_true(F.col("is_paying")).alias("paying"),
        F.sum("active_user_count").alias("active_users"),
    )
    mrr = to_units(F.col("mrr_cents"))
    return totals.select(
        display_rank(F.col("plan"), PLAN_ORDER).alias("position"), "plan", "mrr_cents",
        mrr.alias("mrr"), "orgs", "paying", "active_users",
        F.when(F.col("paying") > 0, mrr / F.col("paying")).alias("arpa"),
    )


def plan_share(plans: DataFrame) -> DataFrame:
    """Share of revenue; one row per plan, so the total is a small window."""
    total = F.sum("mrr_cents").over(Window.partitionBy())
    return plans.select(
        "plan", "mrr", safe_ratio(F.col("mrr_cents"), total).alias("mrr_share")
    )


def commercial_moves(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("movement_type").isin(*MOVEMENT_ORDER))


def moves_per_month(moves: DataFrame) -> DataFrame:
    month = month_label(F.col("occurred_month"), "yyyy-MM").alias("month")
    return (
        commercial_moves(moves).groupBy(month).pivot("movement_type", MOVEMENT_ORDER)
        .count().fillna(0)
    )


def moves_summary(moves: DataFrame) -> DataFrame:
    totals = commercial_moves(moves).groupBy("movement_type").agg(
        F.count("*").alias("events"), to_units(F.sum("mrr_delta_cents")).alias("mrr")
    )
    amount = money(F.col("mrr"), signed=True)
    return totals.select(
        display_rank(F.col("movement_type"), MOVEMENT_ORDER).alias("position"), "movement_type",
        "events", "mrr", F.concat(amount, F.lit(" · "), "events", F.lit(" events")).alias("label"),
    )


def recent_changes(moves: DataFrame, orgs: DataFrame, k: int = 8) -> DataFrame:
    """The k newest plan changes as display texts; the event id breaks ties.

    The top k are taken once, before names are looked up by a plain left join whose
    form Spark chooses by the measured size of its sides.
    """
    newest = commercial_moves(moves).orderBy(F.desc("occurred_at"), F.desc("event_id")).limit(k)
    named = changes_with_org(newest, orgs)
    kind = F.col("movement_type")
    return named.select(
        "event_id", F.date_format("occurred_at", "MMM dd, yyyy").alias("when"),
        F.col("org_name").alias("customer"), capitalized(kind).alias("movement"),
        transition(F.col("from_plan"), F.col("to_plan"), kind).alias("from_to"),
        money(to_units(F.col("mrr_delta_cents")), signed=True).alias("mrr_change"),
    )

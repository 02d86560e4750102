"""Revenue movements, month-end state and the monthly revenue bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.functions import add_months, count_true, month_of, movement_type, safe_ratio

FLOWS = ["new", "expansion", "contraction", "churn", "reactivation"]


def subscription_movements(events: DataFrame) -> DataFrame:
    """Classify each staged subscription event into one revenue movement."""
    return events.selectExpr(
        "event_id", "subscription_id", "org_id", "event_type", "from_plan", "to_plan",
        "coalesce(mrr_cents_before, 0) as mrr_cents_before",
        "coalesce(mrr_cents_after, 0) as mrr_cents_after", "occurred_at", "recorded_at",
        "cast(trunc(occurred_at, 'month') as date) as occurred_month", "is_late_arriving",
    ).selectExpr(
        "event_id", "subscription_id", "org_id", "event_type", "from_plan", "to_plan",
        "mrr_cents_before", "mrr_cents_after",
        "mrr_cents_after - mrr_cents_before as mrr_delta_cents", "occurred_at", "recorded_at",
        "occurred_month", "is_late_arriving",
        movement_type("mrr_cents_before", "mrr_cents_after", "event_type") + " as movement_type",
    )


def month_bounds(movements: DataFrame) -> DataFrame:
    """First and last month of business time; one row."""
    return movements.agg(
        month_of(F.min("occurred_at")).alias("first_month"),
        month_of(F.max("occurred_at")).alias("last_month"),
    )


def month_spine(bounds: DataFrame) -> DataFrame:
    """Every month between the bounds; no rows for an empty input."""
    months = F.sequence("first_month", "last_month", F.expr("interval 1 month"))
    return bounds.filter("first_month is not null").select(F.explode(months).alias("month_start"))


def org_month_steps(movements: DataFrame) -> DataFrame:
    """One row per organization and month with events: state left behind and flows.

    The aggregate combines on the map side, so a hot organization shrinks to
    its months before the shuffle. The later windows per organization see at
    most one row per calendar month.
    """
    flows = [
        F.expr(f"sum(if(movement_type = '{flow}', mrr_delta_cents, 0)) as {flow}_mrr_cents")
        for flow in FLOWS
    ]
    steps = movements.filter("occurred_at is not null").groupBy(
        "org_id", F.col("occurred_month").alias("month_start")
    ).agg(
        F.expr("max_by(mrr_cents_after, struct(occurred_at, event_id)) as mrr_cents_after"),
        *flows,
        F.expr("bool_or(movement_type = 'new') as has_new"),
        F.expr("bool_or(movement_type = 'churn') as has_churn"),
    )
    return steps.selectExpr(
        "*",
        "coalesce(lag(mrr_cents_after) over (partition by org_id order by month_start), 0) "
        "as previous_mrr_cents",
    )


def asof_month_state(movements: DataFrame) -> DataFrame:
    """Last known amount of each organization at each month end.

    Each month with events holds until the month before the next one, so the
    month-by-event range join becomes a sequence per step.
    """
    steps = movements.filter("occurred_at is not null").groupBy(
        "org_id", F.col("occurred_month").alias("step_month")
    ).agg(F.expr("max_by(mrr_cents_after, struct(occurred_at, event_id)) as mrr_cents_after"))
    last_month = month_bounds(movements).select("last_month").scalar()
    held = steps.selectExpr(
        "*", "add_months(lead(step_month) over (partition by org_id order by step_month), -1) "
        "as _until",
    ).withColumn("_until", F.coalesce("_until", last_month))
    return held.selectExpr(
        "explode(sequence(step_month, _until, interval 1 month)) as month_start", "org_id",
        "mrr_cents_after",
    )


def org_month_mrr(movements: DataFrame) -> DataFrame:
    return asof_month_state(movements).selectExpr(
        "concat(org_id, '-', month_start) as org_month_key", "month_start", "org_id",
        "mrr_cents_after", "mrr_cents_after > 0 as is_paying",
    )


def ending_state(org_month: DataFrame) -> DataFrame:
    return org_month.groupBy("month_start").agg(
        F.sum("mrr_cents_after").alias("ending_mrr_cents"),
        count_true(F.col("is_paying")).alias("active_orgs_end"),
    )


def month_flows(movements: DataFrame) -> DataFrame:
    return movements.groupBy(F.col("occurred_month").alias("month_start")).agg(
        *[F.expr(f"sum(if(movement_type = '{flow}', mrr_delta_cents, 0)) as {flow}_mrr_cents")
          for flow in FLOWS],
        F.expr("count(distinct if(movement_type = 'new', org_id, null)) as new_orgs"),
    )


def starting_churn(movements: DataFrame, org_month: DataFrame) -> DataFrame:
    """Organizations that churned in a month and paid at the previous month end."""
    churned = (
        movements.filter("movement_type = 'churn'")
        .select("org_id", F.col("occurred_month").alias("month_start"))
        .distinct()
        .withColumn("state_month", add_months(F.col("month_start"), -1))
    )
    paying = org_month.filter("is_paying").select("org_id", F.col("month_start").alias("state_month"))
    joined = churned.join(paying, ["org_id", "state_month"])
    return joined.groupBy("month_start").agg(F.count("*").alias("churned_orgs"))


def mrr_bridge(ending: DataFrame, flows: DataFrame, churn: DataFrame) -> DataFrame:
    """Assemble the bridge; every input has one row per month."""
    joined = ending.join(flows, "month_start", "left").join(churn, "month_start", "left")
    return _with_opening(joined)


def _with_opening(months: DataFrame) -> DataFrame:
    """Carry the previous month's ending state over; one row per calendar month."""
    flows = [f"coalesce({flow}_mrr_cents, 0) as {flow}_mrr_cents" for flow in FLOWS]
    opened = months.selectExpr(
        "month_start",
        "coalesce(lag(ending_mrr_cents) over (order by month_start), 0) as beginning_mrr_cents",
        *flows, "ending_mrr_cents",
        "coalesce(lag(active_orgs_end) over (order by month_start), 0) as active_orgs_start",
        "active_orgs_end", "coalesce(new_orgs, 0) as new_orgs",
        "coalesce(churned_orgs, 0) as churned_orgs",
    )
    rate = safe_ratio(F.col("churned_orgs"), F.col("active_orgs_start"))
    return opened.withColumn("logo_churn_rate", rate)


def mrr_monthly(movements: DataFrame) -> DataFrame:
    """The monthly bridge straight from movements.

    State at a month end is the running total of state changes, so the
    organization-by-month table is never built: one scan, one reduction to
    (organization, month), and sums per month. `mrr_bridge` over
    `org_month_mrr` gives the same rows.
    """
    flows = [f"{flow}_mrr_cents" for flow in FLOWS]
    changes = org_month_steps(movements).selectExpr(
        "month_start", "mrr_cents_after - previous_mrr_cents as state_change",
        "int(mrr_cents_after > 0) - int(previous_mrr_cents > 0) as paying_change", *flows,
        "int(has_new and org_id is not null) as new_orgs",
        "int(has_churn and previous_mrr_cents > 0 and org_id is not null) as churned_orgs",
    )
    sums = [name for name in changes.columns if name != "month_start"]
    monthly = changes.groupBy("month_start").agg(*[F.sum(name).alias(name) for name in sums])
    # From here on there is one row per calendar month; fill the quiet months.
    spine = monthly.selectExpr(
        "*",
        "coalesce(add_months(lead(month_start) over (order by month_start), -1), month_start) "
        "as _until",
    ).selectExpr(
        "posexplode(sequence(month_start, _until, interval 1 month)) as (_gap, _month)", *sums
    )
    filled = spine.selectExpr(
        "_month as month_start", *[f"if(_gap = 0, {name}, 0) as {name}" for name in sums]
    )
    totals = filled.selectExpr(
        "month_start",
        "sum(state_change) over (order by month_start) as ending_mrr_cents",
        "sum(paying_change) over (order by month_start) as active_orgs_end",
        *flows, "new_orgs", "churned_orgs",
    )
    return _with_opening(totals)


#: What a month looks like whose ending is not its beginning plus the flows, and one with impossible churn.
BRIDGE_BROKEN = "ending_mrr_cents <> beginning_mrr_cents + " + " + ".join(f"{flow}_mrr_cents" for flow in FLOWS)
CHURN_OUT_OF_BOUNDS = ("logo_churn_rate < 0 or logo_churn_rate > 1 or (active_orgs_start = 0 and logo_churn_rate is not null) "
                       "or churned_orgs > active_orgs_start")


def bridge_violations(bridge: DataFrame) -> DataFrame:
    """Months whose ending amount differs from the beginning plus the flows."""
    return bridge.filter(BRIDGE_BROKEN).select(
        "month_start", "beginning_mrr_cents", *[f"{flow}_mrr_cents" for flow in FLOWS],
        "ending_mrr_cents",
    )


def churn_bounds_violations(bridge: DataFrame) -> DataFrame:
    return bridge.filter(CHURN_OUT_OF_BOUNDS).select(
        "month_start", "active_orgs_start", "churned_orgs", "logo_churn_rate")

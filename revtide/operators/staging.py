"""Cleaned entity frames, one row per business key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.contracts import LATE_DAYS
from revtide.operators.current import first_per_key

LOAD = ["_loaded_at", "_batch_id", "_source_system"]


def late(business: str, recorded: str) -> str:
    """Recorded at least LATE_DAYS calendar-day boundaries after it happened."""
    return f"datediff({recorded}, {business}) >= {LATE_DAYS}"


def stg_organizations(current: DataFrame) -> DataFrame:
    return current.selectExpr(
        "org_id", "name as org_name", "domain", "industry", "employee_band", "country_code",
        "lower(status) as status", "created_at", "updated_at", *LOAD,
    )


def stg_users(current: DataFrame) -> DataFrame:
    return current.selectExpr(
        "user_id", "org_id", "email", "full_name", "lower(role) as role",
        "lower(status) as status", "created_at", "updated_at", *LOAD,
    )


def stg_subscriptions(current: DataFrame) -> DataFrame:
    """Plan text is normalised; a negative amount is kept for the publish gate."""
    return current.selectExpr(
        "subscription_id", "org_id", "lower(trim(plan)) as plan", "lower(status) as status",
        "mrr_cents", "seats", "started_at", "canceled_at", "updated_at", *LOAD,
    )


def stg_subscription_events(current: DataFrame) -> DataFrame:
    return current.selectExpr(
        "event_id", "subscription_id", "org_id", "lower(event_type) as event_type",
        "lower(from_plan) as from_plan", "lower(to_plan) as to_plan", "mrr_cents_before",
        "mrr_cents_after", "occurred_at", "recorded_at",
        f"{late('occurred_at', 'recorded_at')} as is_late_arriving", *LOAD,
    )


def dedupe_logins(current: DataFrame) -> DataFrame:
    """Retried logins share a client event: keep the one recorded last."""
    event = F.coalesce("client_event_id", "login_id")
    return first_per_key(current, [event], [F.desc("recorded_at"), F.desc("login_id")])


def stg_logins(current: DataFrame) -> DataFrame:
    return dedupe_logins(current).selectExpr(
        "login_id", "client_event_id", "user_id", "org_id", "lower(idp) as idp",
        "coalesce(success, false) as success", "ip_country", "logged_in_at", "recorded_at",
        f"{late('logged_in_at', 'recorded_at')} as is_late_arriving", *LOAD,
    )


def stg_invoices(current: DataFrame) -> DataFrame:
    return current.selectExpr(
        "invoice_id", "org_id", "subscription_id", "amount_cents", "upper(currency) as currency",
        "lower(status) as status", "period_start", "period_end", "issued_at", "paid_at",
        "recorded_at", *LOAD,
    )


STAGING = {
    "organizations": stg_organizations,
    "users": stg_users,
    "subscriptions": stg_subscriptions,
    "subscription_events": stg_subscription_events,
    "logins": stg_logins,
    "invoices": stg_invoices,
}

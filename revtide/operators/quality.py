"""Data-quality rules and their evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.contracts import ENTITIES
from revtide.operators.movements import BRIDGE_BROKEN, CHURN_OUT_OF_BOUNDS

FRESH_WARN_HOURS = 36
FRESH_ERROR_HOURS = 72


# --- failing rows ---------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return duplicate_keys(df.filter(F.col(col).isNotNull()).select(col), [col])


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: list, where: str | None = None) -> DataFrame:
    """Rows with a value outside the list; nulls pass."""
    rows = df.filter(where) if where else df
    return rows.filter(~F.col(col).isin(*values))


def relationships(
    child: DataFrame, col: str, parent: DataFrame, parent_col: str, where: str | None = None
) -> DataFrame:
    """Child keys without a parent and the rows that carry them.

    The child is counted per key first, so a hot key is one row in the join.
    """
    rows = child.filter(where) if where else child
    counts = rows.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("orphan_key")).agg(
        F.count("*").alias("n_rows")
    )
    keys = parent.select(F.col(parent_col).alias("orphan_key"))
    return counts.join(keys, "orphan_key", "left_anti")


def non_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < 0)


def canceled_has_timestamp(df: DataFrame) -> DataFrame:
    return df.filter("status = 'canceled' and canceled_at is null")


def paid_has_timestamp(df: DataFrame) -> DataFrame:
    return df.filter("status = 'paid' and paid_at is null")


def no_duplicate_keys(entities: dict[str, DataFrame]) -> DataFrame:
    """Keys with more than one current row, over all six entities."""
    parts = [
        duplicate_keys(df, [ENTITIES[name].pk]).select(
            F.col(ENTITIES[name].pk).cast("string").alias("entity_key"),
            F.lit(name).alias("entity"),
        )
        for name, df in entities.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def freshness(
    df: DataFrame, now, warn_h: int = FRESH_WARN_HOURS, error_h: int = FRESH_ERROR_HOURS
) -> DataFrame:
    """Age of the newest load against a clock that the caller passes; one row."""
    newest = df.agg(F.max("_loaded_at").alias("max_loaded_at"))
    clock = F.lit(now).cast("timestamp_ntz")

    def older_than(hours: int) -> Column:
        limit = clock - F.make_dt_interval(F.lit(0), F.lit(hours))
        return F.col("max_loaded_at").isNull() | (F.col("max_loaded_at") < limit)

    status = F.when(older_than(error_h), "error").when(older_than(warn_h), "warn").otherwise("pass")
    return newest.withColumn("status", status)


def entity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(name).alias("entity"), F.count("*").alias("n_rows"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def with_total(df: DataFrame) -> DataFrame:
    """Row count of a filtered selection next to its rows.

    The count is one aggregate joined as a scalar, so no task sees all rows.
    """
    return df.withColumn("total", df.agg(F.count("*")).scalar())


def first_by(df: DataFrame, predicate: str, key: str) -> DataFrame:
    return df.filter(predicate).orderBy(key).limit(1)


def publish_signature(bridge: DataFrame, orgs: DataFrame) -> DataFrame:
    """Build time and row count of two marts; one row."""
    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.agg(F.max("_built_at").alias("built_at"), F.count("*").alias("n_rows")).select(
            F.lit(prefix).alias("mart"), "built_at", "n_rows"
        )

    return named(bridge, "fct_mrr_monthly").unionByName(named(orgs, "dim_organizations"))


def gate_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per mart: unchanged content and whether the build time moved."""
    old = before.select("mart", F.col("built_at").alias("b"), F.col("n_rows").alias("r"))
    return after.join(old, "mart", "left").select(
        "mart",
        (F.col("built_at").eqNullSafe(F.col("b")) & F.col("n_rows").eqNullSafe(F.col("r")))
        .alias("unchanged"),
        F.coalesce(F.col("built_at") > F.col("b"), F.lit(False)).alias("moved"),
    )


# --- rule evaluation ------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    table: str
    kind: str
    column: str = ""
    severity: str = "error"
    where: str | None = None
    values: tuple = field(default=())
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        parts = [self.kind, self.table, self.column]
        return ".".join(p for p in parts if p)

    def condition(self) -> str | None:
        """What one failing row looks like as SQL; None for rules over many rows."""
        values = ", ".join(f"'{v}'" for v in self.values)
        failing = {
            "not_null": f"{self.column} is null",
            "accepted_values": f"{self.column} not in ({values})",
            "non_negative": f"{self.column} < 0",
            "canceled_has_timestamp": "status = 'canceled' and canceled_at is null",
            "paid_has_timestamp": "status = 'paid' and paid_at is null",
            "bridge_identity": BRIDGE_BROKEN,
            "churn_bounds": CHURN_OUT_OF_BOUNDS,
        }.get(self.kind)
        if failing is None:
            return None
        return f"({self.where}) and ({failing})" if self.where else failing


def _entry(condition: str, slot: str, key: str, tag: str = "") -> str:
    return f"if({condition}, named_struct('slot', '{slot}', 'key', cast({key} as string), 'tag', '{tag}'), null)"


def _entries(table: str, df: DataFrame, rules: list[Rule]) -> DataFrame:
    """What one scan of a table gives to all rules: (slot, key, tag).

    A failing row of a row-level rule goes to the rule's own slot. Every value of a key
    column goes to the column's slot: without a tag from the table that the key belongs to,
    with the rule's name from the tables that refer to it.
    """
    found = []
    slots = dict.fromkeys(
        [f"{r.table}.{r.column}" for r in rules if r.table == table and r.kind == "unique"]
        + [".".join(r.parent) for r in rules if r.kind == "relationships" and r.parent[0] == table])
    if any(r.kind == "no_duplicate_keys" for r in rules) and (pk := _staged_keys().get(table)):
        slots[f"{table}.{pk}"] = None
    for slot in slots:
        column = slot.rsplit(".", 1)[1]
        found.append(_entry(f"{column} is not null", slot, column))
    for r in rules:
        if r.table == table and r.kind == "relationships":
            where = f"({r.where}) and " if r.where else ""
            found.append(_entry(f"{where}{r.column} is not null", ".".join(r.parent), r.column, r.name))
        elif r.table == table and (failing := r.condition()):
            found.append(_entry(failing, r.name, "null"))
    return df.selectExpr(f"array_compact(array({', '.join(found)})) as entries").selectExpr("inline(entries)")


def _staged_keys() -> dict[str, str]:
    return {f"stg_{name}": e.pk for name, e in ENTITIES.items()}


def independent(rules: list[Rule]) -> list[list[Rule]]:
    """The rules in groups that have no table in common, so that each can be counted by itself."""
    groups: list[tuple[set[str], list[Rule]]] = []
    for rule in rules:
        tables, mine = {rule.table, *([rule.parent[0]] if rule.parent else [])}, [rule]
        if rule.kind == "no_duplicate_keys":
            tables = set(_staged_keys())
        for group in [g for g in groups if g[0] & tables]:
            groups.remove(group)
            tables, mine = tables | group[0], group[1] + mine
        groups.append((tables, mine))
    return [mine for _, mine in groups]


def run_checks(frames: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Failures per rule: (rule, severity, failures), one row per rule.

    Each table is scanned once. All keys of all rules are counted together, once per key
    column and value, map-side first; uniqueness, duplicates and orphans follow from the
    counts: a value that its own table has more than once, or that only others have.
    """
    references = [r for r in rules if r.kind == "relationships"]
    tables = dict.fromkeys([r.table for r in rules if r.kind != "no_duplicate_keys"] + [r.parent[0] for r in references])
    if any(r.kind == "no_duplicate_keys" for r in rules):
        tables |= dict.fromkeys(_staged_keys())
    entries = reduce(DataFrame.unionByName, [_entries(t, frames[t], rules) for t in tables])
    counted = entries.groupBy("slot", "key").agg(
        F.count_if(F.col("tag") == "").alias("own"),
        *[F.count_if(F.col("tag") == r.name).alias(f"n{i}") for i, r in enumerate(references)])

    def failure(name: str, condition: str, n: str) -> str:
        return f"if({condition}, named_struct('rule', '{name}', 'n', {n}), null)"

    found = [failure(r.name, f"own = 0 and n{i} > 0", f"n{i}") for i, r in enumerate(references)]
    for r in rules:
        if r.kind == "unique":
            found.append(failure(r.name, f"slot = '{r.table}.{r.column}' and own > 1", "1L"))
        elif r.kind == "no_duplicate_keys":
            keys = ", ".join(f"'{t}.{pk}'" for t, pk in _staged_keys().items())
            found.append(failure(r.name, f"slot in ({keys}) and own > 1", "1L"))
        elif r.kind != "relationships":
            found.append(failure(r.name, f"slot = '{r.name}'", "own"))
    per_rule = counted.selectExpr(f"inline(array_compact(array({', '.join(found)})))").groupBy("rule").agg(F.sum("n").alias("n"))
    listed = ", ".join(f"struct('{r.name}' as rule, '{r.severity}' as severity)" for r in rules)
    every = entries.sparkSession.range(1).selectExpr(f"inline(array({listed}))")
    return every.join(per_rule, "rule", "left").selectExpr("rule", "severity", "coalesce(n, 0L) as failures")


def failing_rows(frames: dict[str, DataFrame], rule: Rule) -> DataFrame:
    """The rows, or keys, that a rule counts."""
    if rule.kind == "no_duplicate_keys":
        return no_duplicate_keys({n: frames[f"stg_{n}"] for n in ENTITIES})
    df = frames[rule.table]
    if rule.kind == "unique":
        return unique(df, rule.column)
    if rule.kind == "relationships":
        return relationships(df, rule.column, frames[rule.parent[0]], rule.parent[1], rule.where)
    return df.filter(rule.condition())


def write_failing(frames: dict[str, DataFrame], rules: list[Rule], checks: DataFrame, folder: str) -> dict[str, str]:
    """Write the failing rows of the rules that count any; the folder of each such rule.

    `checks` has been evaluated: one row per rule is read from it. Rules without failures
    cost nothing.
    """
    named = {r.name: r for r in rules}
    failed = [row["rule"] for row in checks.filter("failures > 0").collect() if row["rule"] in named]
    for name in failed:
        failing_rows(frames, named[name]).write.mode("overwrite").parquet(f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in failed}


# The rules and value lists that guard publication.
UPSTREAM_RULES: list[Rule] = [
    Rule("stg_organizations", "unique", "org_id"),
    Rule("stg_organizations", "not_null", "org_id"),
    Rule("stg_organizations", "not_null", "org_name"),
    Rule("stg_organizations", "not_null", "status"),
    Rule("stg_organizations", "accepted_values", "status", values=("active", "churned")),
    Rule("stg_users", "unique", "user_id"),
    Rule("stg_users", "not_null", "user_id"),
    Rule("stg_users", "not_null", "org_id"),
    Rule("stg_users", "not_null", "email", severity="warn"),
    Rule("stg_users", "not_null", "role"),
    Rule("stg_users", "not_null", "status"),
    Rule("stg_users", "accepted_values", "role", values=("owner", "admin", "member")),
    Rule("stg_users", "accepted_values", "status", values=("active", "deactivated")),
    Rule("stg_users", "relationships", "org_id", parent=("stg_organizations", "org_id")),
    Rule("stg_subscriptions", "unique", "subscription_id"),
    Rule("stg_subscriptions", "not_null", "subscription_id"),
    Rule("stg_subscriptions", "unique", "org_id"),
    Rule("stg_subscriptions", "not_null", "org_id"),
    Rule("stg_subscriptions", "not_null", "plan"),
    Rule("stg_subscriptions", "not_null", "status"),
    Rule("stg_subscriptions", "not_null", "mrr_cents"),
    Rule("stg_subscriptions", "non_negative", "mrr_cents"),
    Rule("stg_subscriptions", "canceled_has_timestamp", severity="warn"),
    Rule("stg_subscriptions", "accepted_values", "plan", values=("trial", "starter", "growth", "enterprise")),
    Rule("stg_subscriptions", "accepted_values", "status", values=("trialing", "active", "past_due", "canceled")),
    Rule("stg_subscriptions", "relationships", "org_id", parent=("stg_organizations", "org_id")),
    Rule("stg_subscription_events", "unique", "event_id"),
    Rule("stg_subscription_events", "not_null", "event_id"),
    Rule("stg_subscription_events", "not_null", "subscription_id"),
    Rule("stg_subscription_events", "not_null", "org_id"),
    Rule("stg_subscription_events", "not_null", "event_type"),
    Rule("stg_subscription_events", "not_null", "occurred_at"),
    Rule("stg_subscription_events", "non_negative", "mrr_cents_after"),
    Rule("stg_subscription_events", "accepted_values", "event_type", values=("created", "upgraded", "downgraded", "canceled", "reactivated")),
    Rule("stg_subscription_events", "relationships", "subscription_id", parent=("stg_subscriptions", "subscription_id")),
    Rule("stg_subscription_events", "relationships", "org_id", parent=("stg_organizations", "org_id")),
    Rule("stg_logins", "unique", "login_id"),
    Rule("stg_logins", "not_null", "login_id"),
    Rule("stg_logins", "unique", "client_event_id"),
    Rule("stg_logins", "not_null", "client_event_id"),
    Rule("stg_logins", "not_null", "org_id"),
    Rule("stg_logins", "not_null", "logged_in_at"),
    Rule("stg_logins", "relationships", "org_id", parent=("stg_organizations", "org_id")),
    Rule("stg_logins", "relationships", "user_id", severity="warn", where="user_id is not null", parent=("stg_users", "user_id")),
    Rule("stg_logins", "accepted_values", "idp", where="idp is not null", values=("okta", "azure_ad", "google_workspace", "onelogin")),
    Rule("stg_invoices", "unique", "invoice_id"),
    Rule("stg_invoices", "not_null", "invoice_id"),
    Rule("stg_invoices", "not_null", "org_id"),
    Rule("stg_invoices", "not_null", "amount_cents"),
    Rule("stg_invoices", "non_negative", "amount_cents"),
    Rule("stg_invoices", "not_null", "currency"),
    Rule("stg_invoices", "not_null", "status"),
    Rule("stg_invoices", "paid_has_timestamp", severity="warn"),
    Rule("stg_invoices", "accepted_values", "currency", values=("USD", "EUR", "GBP")),
    Rule("stg_invoices", "accepted_values", "status", values=("open", "paid", "void")),
    Rule("stg_invoices", "relationships", "org_id", parent=("stg_organizations", "org_id")),
    Rule("int_subscription_movements", "unique", "event_id"),
    Rule("int_subscription_movements", "not_null", "event_id"),
    Rule("int_subscription_movements", "not_null", "movement_type"),
    Rule("int_subscription_movements", "not_null", "occurred_month"),
    Rule("int_subscription_movements", "accepted_values", "movement_type", values=("new", "expansion", "contraction", "churn", "reactivation", "other")),
    Rule("int_org_month_mrr", "unique", "org_month_key"),
    Rule("int_org_month_mrr", "not_null", "org_month_key"),
    Rule("int_org_month_mrr", "not_null", "month_start"),
    Rule("int_org_month_mrr", "not_null", "org_id"),
    Rule("int_org_month_mrr", "not_null", "mrr_cents_after"),
    Rule("int_org_month_mrr", "non_negative", "mrr_cents_after"),
    Rule("staging", "no_duplicate_keys"),
]
MART_RULES: list[Rule] = [
    Rule("fct_mrr_monthly", "unique", "month_start"),
    Rule("fct_mrr_monthly", "not_null", "month_start"),
    Rule("fct_mrr_monthly", "not_null", "ending_mrr_cents"),
    Rule("fct_mrr_monthly", "non_negative", "ending_mrr_cents"),
    Rule("fct_mrr_monthly", "not_null", "beginning_mrr_cents"),
    Rule("fct_mrr_monthly", "non_negative", "beginning_mrr_cents"),
    Rule("fct_mrr_monthly", "bridge_identity"),
    Rule("fct_mrr_monthly", "churn_bounds"),
    Rule("fct_plan_changes", "unique", "event_id"),
    Rule("fct_plan_changes", "not_null", "event_id"),
    Rule("fct_plan_changes", "not_null", "movement_type"),
    Rule("fct_logins", "unique", "login_id"),
    Rule("fct_logins", "not_null", "login_id"),
    Rule("fct_logins", "not_null", "org_id"),
    Rule("fct_logins", "not_null", "logged_in_at"),
    Rule("fct_login_activity_daily", "not_null", "activity_date"),
    Rule("fct_login_activity_daily", "not_null", "org_id"),
    Rule("fct_login_activity_daily", "not_null", "login_count"),
    Rule("dim_organizations", "unique", "org_id"),
    Rule("dim_organizations", "not_null", "org_id"),
    Rule("dim_organizations", "not_null", "is_active"),
    Rule("dim_organizations", "not_null", "is_paying"),
    Rule("fct_invoices", "unique", "invoice_id"),
    Rule("fct_invoices", "not_null", "invoice_id"),
    Rule("fct_invoices", "not_null", "amount_cents"),
    Rule("fct_invoices", "non_negative", "amount_cents"),
    Rule("subscriptions_history", "not_null", "subscription_id"),
]

"""Gated publication: staging, checks, marts and history in one commit or none."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.contracts import ENTITIES
from revtide.operators import history, marts, movements
from revtide.operators.current import current_entity
from revtide.operators.quality import MART_RULES, UPSTREAM_RULES, freshness, independent, run_checks, write_failing
from revtide.operators.staging import STAGING
from revtide.session import shuffles_dropped, side_by_side, work_folder, written
from revtide.sources.lake import Lake

HISTORY = "subscriptions_history"
#: The history is stored by state: closed versions are only added to, open ones lie by key.
OPEN, CLOSED = f"{HISTORY}_open", f"{HISTORY}_closed"
ACTIVITY = "fct_login_activity_daily"


@dataclass
class Outcome:
    published: bool
    stage: str
    checks: DataFrame
    failing: dict[str, str] = field(default_factory=dict)  # folders with the failing rows of each such rule

    @property
    def failed(self) -> DataFrame:
        return self.checks.filter("severity = 'error' and failures > 0")


class Publisher:
    """Builds the model tables of a lake from raw batch tables and change tables."""

    def __init__(
        self, lake: Lake, raw: Callable[[str], DataFrame], changes: Callable[[str], DataFrame]
    ) -> None:
        self.lake = lake
        self.raw = raw
        self.changes = changes
        self.schemas: dict[str, T.StructType] = {}  # of what this publication stages

    def _stage(
        self, models: dict[str, Callable[[], DataFrame]], staged: dict[str, list[str]]
    ) -> dict[str, DataFrame]:
        """Write independent frames side by side and go on from the written tables."""
        def write(name: str) -> DataFrame:
            df = models[name]()
            staged[name], self.schemas[name] = self.lake.replace(name, df), df.schema
            return self.lake.read(name, df.schema, staged[name])

        return dict(zip(models, side_by_side(self.lake.spark, write, models), strict=True))

    def published(self, name: str) -> DataFrame | None:
        """A published table, or None before its first publication.

        Read by the schema it was published with: a column that came later is null in
        older segments, whichever file Spark opens first.
        """
        if name == HISTORY:
            open_rows, closed = self.published(OPEN), self.published(CLOSED)
            return None if open_rows is None else closed.unionByName(open_rows)
        schema = self.lake.schema(name)
        return None if schema is None else self.lake.read(name, schema)

    def check_freshness(self, now) -> DataFrame:
        """One row per batch source; change tables are not checked, quiet is fine there."""
        parts = [
            freshness(self.raw(t), now).select(
                F.lit(f"freshness.{t}").alias("rule"),
                F.when(F.col("status") == "warn", "warn").otherwise("error").alias("severity"),
                (F.col("status") != "pass").cast("bigint").alias("failures"),
            )
            for t in ENTITIES
        ]
        return reduce(DataFrame.unionByName, parts)

    def upstream(self, staged: dict[str, list[str]]) -> dict[str, DataFrame]:
        def staging(table: str) -> Callable[[], DataFrame]:
            return lambda: STAGING[table](
                current_entity(self.raw(table), self.changes(table), table)
            )

        frames: dict[str, DataFrame] = {}
        with shuffles_dropped(self.lake.spark):
            # Each entity shuffles all its rows: one after another, so that the disk holds one table's shuffle at a time.
            for table in STAGING:
                frames |= self._stage({f"stg_{table}": staging(table)}, staged)
            events = frames["stg_subscription_events"]
            frames |= self._stage(
                {"int_subscription_movements": lambda: movements.subscription_movements(events)}, staged
            )
            moves = frames["int_subscription_movements"]
            return frames | self._stage(
                {"int_org_month_mrr": lambda: movements.org_month_mrr(moves)}, staged
            )

    def login_fact(self, frames: dict[str, DataFrame], staged: dict, full_refresh: bool, at):
        """The login fact and, unless it is built anew, the days that its new rows touch.

        Logins loaded since the fact's newest row are staged from their own retry groups and
        merged into the key partitions that they fall into.
        """
        target = None if full_refresh else self.published("fct_logins")
        logins = frames["stg_logins"] if target is None else marts.changed_logins(
            self.raw("logins"), self.changes("logins"), marts.high_water_mark(target))
        rows = marts.with_built_at(marts.fct_logins(logins, frames["stg_users"]), at)
        old = [] if target is None else target.schema.fields
        added = [f for f in rows.schema.fields if f.name not in {o.name for o in old}]
        schema = self.schemas["fct_logins"] = T.StructType([*old, *added])
        days = None
        if target is None:
            staged["fct_logins"] = self.lake.replace_keyed("fct_logins", rows, "login_id", ["logged_in_at"])
        else:
            rows = written(rows.select(*[F.col(n) if n in rows.columns else F.lit(None).cast(schema[n].dataType).alias(n)
                                         for n in schema.names]), "fct_logins")
            days = marts.touched_days(rows, target)
            staged["fct_logins"] = self.lake.upsert("fct_logins", rows, "login_id", schema, ["logged_in_at"])
        return self.lake.read("fct_logins", schema, staged["fct_logins"]), days

    def activity(self, fact: DataFrame, days: set[str] | None, staged: dict, at) -> DataFrame:
        """Daily activity; with `days`, only those are computed and overwritten."""
        part = F.expr(marts.ACTIVITY_DAY.format("activity_date"))
        schema = self.lake.schema(ACTIVITY)
        if days is None or schema is None:
            rows = marts.with_built_at(marts.login_activity_daily(fact), at)
            staged[ACTIVITY] = self.lake.write_parts(ACTIVITY, rows, part, ["org_id"])
            schema = rows.schema
        elif days:
            rows = marts.with_built_at(marts.restated_activity(fact, days), at)
            staged[ACTIVITY] = self.lake.overwrite_parts(ACTIVITY, rows, part, days, ["org_id"])
        self.schemas[ACTIVITY] = schema
        return self.lake.read(ACTIVITY, schema, staged.get(ACTIVITY))

    def subscription_history(self, subs: DataFrame, staged: dict, now) -> DataFrame:
        """Close and open versions where subscriptions changed; other files stay."""
        key, current = "subscription_id", subs.select(*history.SUBSCRIPTION_COLUMNS)
        before = self.published(OPEN)
        if before is None:
            rows = history.first_versions(current, key, now)
            schema = rows.schema
            staged[OPEN], staged[CLOSED] = self.lake.replace_keyed(OPEN, rows, key), []
        else:
            delta = written(history.scd2_delta(before, current, key, history.SUBSCRIPTION_CHECK, now), "history")
            schema = delta.schema
            staged[OPEN] = self.lake.upsert(OPEN, delta.filter("is_current"), key, schema)
            closed = delta.filter("not is_current")
            staged[CLOSED] = self.lake.segments(CLOSED) + ([self.lake.write(CLOSED, closed)] if closed.head(1) else [])
        self.schemas[OPEN] = self.schemas[CLOSED] = schema
        return self.lake.read(CLOSED, schema, staged[CLOSED]).unionByName(self.lake.read(OPEN, schema, staged[OPEN]))

    def build_marts(
        self, frames: dict[str, DataFrame], staged: dict[str, list[str]], now, full_refresh: bool
    ) -> dict[str, DataFrame]:
        moves, subs = frames["int_subscription_movements"], frames["stg_subscriptions"]
        fact, days = self.login_fact(frames, staged, full_refresh, now)
        models = {
            "fct_mrr_monthly": lambda: movements.mrr_monthly(moves),
            "fct_plan_changes": lambda: marts.fct_plan_changes(moves),
            "dim_organizations": lambda: marts.dim_organizations(
                frames["stg_organizations"], subs, frames["stg_users"], frames["stg_logins"]
            ),
            "fct_invoices": lambda: marts.fct_invoices(frames["stg_invoices"]),
        }

        def stamped(build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
            return lambda: marts.with_built_at(build(), now)

        stages = {name: stamped(build) for name, build in models.items()}
        return {
            "fct_logins": fact, ACTIVITY: self.activity(fact, days, staged, now),
            HISTORY: self.subscription_history(subs, staged, now), **self._stage(stages, staged),
        }

    def publish(
        self, now: datetime | None = None, full_refresh: bool = False, clock=None,
        check_freshness: bool = True,
    ) -> Outcome:
        """Freshness, then staging with its rules, then marts with theirs.

        A failing rule of error severity stops before the commit: what was
        published stays as it is. Freshness is measured at `clock`, by default the
        build time; turn it off only for data that is meant to be old.
        """
        with shuffles_dropped(self.lake.spark):
            return self._publish(now, full_refresh, clock, check_freshness)

    def _publish(self, now: datetime | None, full_refresh: bool, clock, check_freshness: bool) -> Outcome:
        started = self.lake.version()
        now = now or datetime.now(UTC).replace(tzinfo=None)
        fresh = None
        if check_freshness:
            fresh = self._settle(self.check_freshness(clock or now))
            if self._blocked(fresh):
                return Outcome(False, "freshness", fresh)
        staged: dict[str, list[str]] = {}
        frames = self.upstream(staged)
        upstream = self._settle(*[run_checks(frames, rules) for rules in independent(UPSTREAM_RULES)])
        checks = upstream if fresh is None else fresh.unionByName(upstream)
        if self._blocked(upstream):
            return Outcome(False, "upstream", checks, self._kept(frames, UPSTREAM_RULES, upstream))
        built = self.build_marts(frames, staged, now, full_refresh)
        mart_checks = self._settle(run_checks(built, MART_RULES))
        checks = checks.unionByName(mart_checks)
        if self._blocked(mart_checks):
            return Outcome(False, "marts", checks, self._kept(built, MART_RULES, mart_checks))
        self.lake.commit(staged, based_on=started, schemas=self.schemas)
        return Outcome(True, "published", checks)

    def _kept(self, frames: dict[str, DataFrame], rules: list, checks: DataFrame) -> dict[str, str]:
        return write_failing(frames, rules, checks, work_folder(self.lake.spark, "failing"))

    def _settle(self, *checks: DataFrame) -> DataFrame:
        """Evaluate the rules once, one frame after another; one row per rule reaches the driver."""
        return self.lake.spark.createDataFrame([row for part in checks for row in part.collect()], checks[0].schema)

    @staticmethod
    def _blocked(checks: DataFrame) -> bool:
        return bool(checks.filter("severity = 'error' and failures > 0").limit(1).count())

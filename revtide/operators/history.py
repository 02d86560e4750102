"""Type-2 history by comparing tracked columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUBSCRIPTION_CHECK = ["plan", "status", "mrr_cents", "seats", "canceled_at"]
SUBSCRIPTION_COLUMNS = [
    "subscription_id", "org_id", "plan", "status", "mrr_cents", "seats", "started_at",
    "canceled_at", "updated_at",
]
VALIDITY = ["scd_id", "valid_from", "valid_to", "is_current"]


def _opened(rows: DataFrame, key: str, at) -> DataFrame:
    return rows.withColumns(
        {
            "scd_id": F.md5(F.concat_ws("|", F.col(key).cast("string"), at.cast("string"))),
            "valid_from": at,
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    )


def scd2_check(
    history: DataFrame | None, current: DataFrame, key: str, check_cols: list[str], now
) -> DataFrame:
    """The next state of the history.

    A key gets a new version only when a checked column changed, compared
    null-safely; the open version is closed at the same time. Keys missing
    from `current` stay open. Closed versions pass through without a shuffle.
    """
    at = F.lit(now).cast("timestamp_ntz")
    if history is None:
        return _opened(current, key, at)
    columns = current.columns
    open_rows = history.filter("is_current")
    old = open_rows.select(F.col(key).alias("_key"), F.struct(*columns, *VALIDITY).alias("o"))
    new = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("n"))
    same = F.struct(*[f"o.{c}" for c in check_cols]).eqNullSafe(
        F.struct(*[f"n.{c}" for c in check_cols])
    )
    pairs = old.join(new, "_key", "full").withColumns(
        {
            "_opens": F.col("n").isNotNull() & (F.col("o").isNull() | ~same),
            "_closes": F.col("o").isNotNull() & F.col("n").isNotNull() & ~same,
        }
    )
    kept = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in columns], F.col("o.scd_id").alias("scd_id"),
        F.col("o.valid_from").alias("valid_from"),
        F.when(F.col("_closes"), at).alias("valid_to"),
        (~F.col("_closes")).alias("is_current"),
    )
    fresh = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in columns],
        F.md5(F.concat_ws("|", F.col("_key").cast("string"), at.cast("string"))).alias("scd_id"),
        at.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.filter(
        F.array(F.when(F.col("o").isNotNull(), kept), F.when(F.col("_opens"), fresh)),
        lambda r: r.isNotNull(),
    )
    versions = pairs.select(F.inline(rows))
    closed = history.filter("not is_current").select(*columns, *VALIDITY)
    return closed.unionByName(versions)


def scd2_delta(
    open_rows: DataFrame, current: DataFrame, key: str, check_cols: list[str], now
) -> DataFrame:
    """What a run changes: the versions it closes and those it opens.

    For a history stored by state, closed versions apart from open ones: the closed rows of
    this frame are appended there, the open ones replace their key's open version here.
    Closed versions are never read. Keys missing from `current` stay open.
    """
    at, columns = F.lit(now).cast("timestamp_ntz"), current.columns
    old = open_rows.select(F.col(key).alias("_key"), F.struct(*columns, *VALIDITY).alias("o"))
    new = _opened(current, key, at).select(F.col(key).alias("_key"), F.struct(*columns, *VALIDITY).alias("n"))
    changed = F.col("o").isNull() | ~F.struct(*[f"o.{c}" for c in check_cols]).eqNullSafe(
        F.struct(*[f"n.{c}" for c in check_cols]))
    closed = F.col("o").withField("valid_to", at).withField("is_current", F.lit(False))
    pairs = new.join(old, "_key", "left").filter(changed)
    return pairs.select(F.inline(F.array_compact(F.array(F.when(F.col("o").isNotNull(), closed), "n"))))


def first_versions(current: DataFrame, key: str, now) -> DataFrame:
    """The open versions of a history that begins."""
    return _opened(current, key, F.lit(now).cast("timestamp_ntz"))


def subscriptions_history(history: DataFrame | None, staged: DataFrame, now) -> DataFrame:
    return scd2_check(
        history, staged.select(*SUBSCRIPTION_COLUMNS), "subscription_id", SUBSCRIPTION_CHECK, now
    )

"""Queries over the event tables. Relative times count back from ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
INSTALL = "install"
PURCHASES = ["af_purchase", "purchase"]
RECENT_COLUMNS = [
    "appsflyer_id", "event_name", "event_time", "customer_user_id", "platform", "media_source",
    "campaign",
]
LATEST_COLUMNS = RECENT_COLUMNS[:-1]


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(as_of).cast("timestamp_ntz")


def since(df: DataFrame, as_of, interval: str, column: str = "event_time", strict: bool = False):
    """Rows from ``as_of - interval`` on; the bound folds to a literal and reaches the scan."""
    bound = _as_of(as_of) - F.expr(f"INTERVAL {interval}")
    return df.where(F.col(column) > bound if strict else F.col(column) >= bound)


def daily_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "event_name").agg(F.count("*").alias("event_count"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def events_by_name(df: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    return (
        since(df, as_of, f"{days} DAYS")
        .groupBy("event_name")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "event_name")
    )


def attribution(df: DataFrame, as_of=None, days: int = 30, approximate: bool = False) -> DataFrame:
    """Installs and distinct users by media source and campaign. Counting users exactly
    shuffles on (source, campaign, user), so a source that dominates is spread by user."""
    user = F.col("customer_user_id")
    users = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    return (
        since(df, as_of, f"{days} DAYS")
        .where(F.col("event_name") == INSTALL)
        .groupBy("media_source", "campaign")
        .agg(F.count("*").alias("installs"), users.alias("unique_users"))
        .orderBy(F.desc("installs"), "media_source", "campaign")
    )


def revenue_by_device(df: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    return (
        since(df, as_of, f"{days} DAYS")
        .where(F.col("event_name").isin(PURCHASES) & F.col("event_revenue_usd").isNotNull())
        .groupBy("platform")
        .agg(
            F.count("*").alias("purchase_count"),
            F.sum("event_revenue_usd").cast("decimal(28,6)").alias("total_revenue_usd"),
        )
    )


def freshness(df: DataFrame, as_of=None, minutes: int = 5) -> DataFrame:
    return since(df, as_of, f"{minutes} MINUTES", strict=True).agg(
        F.count("*").alias("event_count"), F.max("event_time").alias("latest_event_time")
    )


def recent_events(df: DataFrame, rows: int = 100) -> DataFrame:
    return df.select(*RECENT_COLUMNS).orderBy(F.desc("event_time"), "appsflyer_id").limit(rows)


def latest_loaded(df: DataFrame, rows: int = 10) -> DataFrame:
    return (
        df.orderBy(F.desc("created_at"), F.desc("event_time"), "appsflyer_id")
        .limit(rows)
        .select(*LATEST_COLUMNS)
    )


def lookup(df: DataFrame, event_id: str, only_latest: bool = False) -> DataFrame:
    """All rows of an id, or the latest; of equal times the one with the largest hash of all its text."""
    found = df.where(F.col("appsflyer_id") == event_id)
    if not only_latest:
        return found
    return found.orderBy(F.desc("event_time"), F.xxhash64(F.to_json(F.struct(*df.columns))).desc()).limit(1)

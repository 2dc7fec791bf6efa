"""CSV export rows -> canonical engagement events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.times import first_time
from eventmart.functions.values import present
from eventmart.sources.csvlines import values_at

PROFILE_UPDATE = "profile_update"  # fixed value
NAME_IN_FILE = "([A-Z][a-zA-Z_]+)"  # fixed value


def _known(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def event_time(as_of: Column, mode: str = "reference") -> Column:
    return F.date_trunc("second", first_time(_known(values_at(F.col("time_slots"))), as_of, mode)).cast(
        "timestamp_ntz"
    )


def user_id() -> Column:
    """First non-blank identity column of the file's kind, trimmed."""
    found = F.transform(values_at(F.col("identity_slots")), present)
    return F.get(_known(found), F.lit(0))


def event_name() -> Column:
    """First name column with a value, else a capitalised word of the file name."""
    base = F.element_at(F.split("source_file", "/"), -1)
    return F.coalesce(
        F.get(_known(values_at(F.col("name_slots"))), F.lit(0)),
        F.nullif(F.regexp_extract(base, NAME_IN_FILE, 1), F.lit("")),
        F.lit(PROFILE_UPDATE),
    )


def attributes() -> Column:
    """All other columns under their own names; empty values are JSON null."""
    return F.to_variant_object(F.map_from_arrays("attr_names", values_at(F.col("attr_slots"))))


def to_events(
    rows: DataFrame, as_of: Column | None = None, mode: str = "reference", keep: tuple = ()
) -> DataFrame:
    """Canonical events. A row whose time is taken but cannot be stored has a null
    ``event_ts``; the load rejects it."""
    as_of = F.current_timestamp() if as_of is None else as_of
    ts = F.col("event_ts")
    return rows.withColumn("event_ts", event_time(as_of, mode)).select(
        ts.cast("date").alias("event_date"),
        ts,
        user_id().alias("user_id"),
        event_name().alias("event_name"),
        "source_file",
        attributes().alias("attributes"),
        *keep,
    )


def without_profile_updates(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_name") != PROFILE_UPDATE)

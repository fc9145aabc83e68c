"""Date and number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorlake.functions import fixed


def date_key(day: Column) -> Column:
    """year*10000 + month*100 + day, of a date or timestamp."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_parts(day: Column) -> dict[str, Column]:
    """Year, quarter, month and ISO day of week (Monday = 1)."""
    return {
        "year": F.year(day).cast("short"),
        "quarter": F.quarter(day).cast("short"),
        "month": F.month(day).cast("short"),
        "day_of_week": (F.weekday(day) + 1).cast("short"),
    }


def days_on_site(day: Column, first_seen_at: Column) -> Column:
    """Whole days since first seen; negative when the snapshot is older."""
    return F.datediff(day, F.to_date(first_seen_at)).cast("int")


def backoff_minutes(attempts: Column) -> Column:
    """min(2^attempts, one day); the inner cap keeps the power in range."""
    power = F.pow(F.lit(2), F.least(attempts, F.lit(11)))
    return F.least(power, F.lit(fixed.BACKOFF_CAP_MINUTES)).cast("int")


def next_retry_at(attempts: Column, now: Column) -> Column:
    return F.timestamp_add("MINUTE", backoff_minutes(attempts), now)


def safe_ratio(part: Column, whole: Column) -> Column:
    """0.0 over an empty set."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def on_day(ts: Column, day: Column) -> Column:
    """``to_date(ts) = day`` as a range, which a file scan can push down."""
    start = day.cast("timestamp")
    return (ts >= start) & (ts < F.date_add(day, 1).cast("timestamp"))

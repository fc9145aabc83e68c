"""The crawl queue: inserts, claims and state transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.functions import fixed
from motorlake.functions.dates import next_retry_at
from motorlake.operators.merge import insert_if_absent, new_keys_only
from motorlake.schemas import QUEUE


def new_queue_rows(found: DataFrame, now: Column) -> DataFrame:
    """Queue rows with the column defaults for (listing_id, url)."""
    defaults = {
        "discovered_at": now, "state": F.lit(fixed.STATE_NEW), "attempts": F.lit(0),
    }
    return found.select([
        F.col(f.name) if f.name in ("listing_id", "url")
        else defaults.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in QUEUE.fields
    ])


def enqueue(queue: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    return insert_if_absent(queue, new_queue_rows(found, now), ["listing_id"])


def newly_queued(queue: DataFrame, found: DataFrame) -> DataFrame:
    return new_keys_only(queue, found, ["listing_id"])


def is_pending() -> Column:
    return F.col("state").isin(fixed.STATE_NEW, fixed.STATE_RETRY)


def is_ready(now: Column) -> Column:
    return is_pending() & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now))


def claim(queue: DataFrame, now: Column, n: int = fixed.CLAIM_BATCH) -> DataFrame:
    """The ``n`` ready rows that wait longest (a top-n, kept per task)."""
    waiting_since = F.coalesce("next_retry_at", "discovered_at")
    return (
        queue.where(is_ready(now)).orderBy(waiting_since, "listing_id").limit(n)
        .select("listing_id", "url", "attempts")
    )


def apply_outcomes(queue: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Fold one run's outcomes (listing_id, outcome, error) into the queue.

    Every attempted row counts an attempt. Parsed pages become FETCHED, missing
    ones INACTIVE, blocked and failed ones RETRY with a doubling delay. The
    outcomes hold each listing once.
    """
    hit = outcomes.select("listing_id", F.col("outcome").alias("_outcome"), F.col("error").alias("_error"))
    joined = queue.join(hit, "listing_id", "left")
    outcome = F.col("_outcome")
    tried, done = outcome.isNotNull(), outcome.isin("parsed", "gone")
    attempts = F.col("attempts") + 1
    error = F.when(outcome == "blocked", fixed.BLOCKED_ERROR).otherwise(F.col("_error"))
    new_values = {
        "state": F.when(outcome == "parsed", fixed.STATE_FETCHED)
        .when(outcome == "gone", fixed.STATE_INACTIVE).otherwise(fixed.STATE_RETRY),
        "attempts": attempts,
        "last_attempt_at": now,
        "next_retry_at": F.when(~done, next_retry_at(attempts, now)),
        "last_http_status": F.when(outcome == "parsed", 200).when(outcome == "gone", 404).otherwise(0),
        "last_error": F.when(~done, error),
    }
    return joined.select([
        F.when(tried, new_values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        if f.name in new_values else F.col(f.name)
        for f in QUEUE.fields
    ])

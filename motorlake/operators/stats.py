"""Run statistics over an outcome table.

Outcome rows: (run, listing_id, at, outcome, http_status, error) where outcome
is one of fetched, parsed, failed, blocked, duplicate, discovered. A parsed page
counts as fetched too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.functions import fixed


def run_counters(outcomes: DataFrame, *group: str) -> DataFrame:
    """The six run counters, per group."""
    is_ = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return outcomes.groupBy(*group).agg(
        is_("discovered").alias("discovered"),
        F.count_if(F.col("http_status").isNotNull()).alias("fetched"),
        is_("parsed").alias("parsed"),
        is_("failed").alias("failed"),
        is_("blocked").alias("blocked"),
        is_("duplicate").alias("duplicates"),
    )


def status_histogram(outcomes: DataFrame, *group: str) -> DataFrame:
    return (
        outcomes.where(F.col("http_status").isNotNull())
        .groupBy(*group, "http_status").agg(F.count(F.lit(1)).alias("n"))
    )


def status_map(outcomes: DataFrame, *group: str) -> DataFrame:
    """The histogram as one map per group; status codes are a few dozen values."""
    entry = F.struct(F.col("http_status"), F.col("n"))
    return status_histogram(outcomes, *group).groupBy(*group).agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("status_codes")
    )


def recent_errors(outcomes: DataFrame, group: str, n: int = fixed.RECENT_ERRORS) -> DataFrame:
    """Error count and the last ``n`` errors per group.

    Counting is a partial aggregate and the rank filter keeps ``n`` rows per
    group and task, so no task sees all errors of a run.
    """
    failed = outcomes.where(F.col("error").isNotNull())
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("at"), F.desc("listing_id")))
    tail = failed.withColumn("recency", rank).where(F.col("recency") <= n)
    counts = failed.groupBy(group).agg(F.count(F.lit(1)).alias("error_count"))
    return tail.join(counts, group).select(group, "error_count", "recency", "at", "listing_id", "error")

"""Generated sources: calendar days and index page addresses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.functions import fixed
from motorlake.functions.dates import calendar_parts, date_key
from motorlake.functions.text import index_page_url
from motorlake.operators.joins import BROADCAST_ROW_LIMIT


def calendar_days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included, with key and calendar parts."""
    if (end - start).days >= BROADCAST_ROW_LIMIT:
        raise ValueError("calendar range too long to stay broadcastable")
    days = spark.range(0, (end - start).days + 1, numPartitions=1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("d")
    )
    parts = [c.alias(name) for name, c in calendar_parts(F.col("d")).items()]
    return days.select(date_key(F.col("d")).alias("date_key"), "d", *parts)


def calendar_around(spark: SparkSession, as_of: dt.date, reach: int = fixed.CALENDAR_REACH_DAYS) -> DataFrame:
    """The days within ``reach`` of ``as_of``: 731 rows by default."""
    step = dt.timedelta(days=reach)
    return calendar_days(spark, as_of - step, as_of + step)


def index_pages(pages: DataFrame, page_no: str, base_url: str) -> DataFrame:
    """Address of every index page: the first has no page argument."""
    return pages.select(page_no, index_page_url(base_url, F.col(page_no)).alias("page_url"))


def index_page_range(spark: SparkSession, first: int, last: int, base_url: str) -> DataFrame:
    return index_pages(spark.range(first, last + 1).withColumnRenamed("id", "page_no"), "page_no", base_url)

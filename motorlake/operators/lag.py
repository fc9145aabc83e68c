"""The previous value per key in time order, safe for very hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.session import staged

# The most rows of one key that a window may sort in one task; beyond that, all rows are cut by their order.
HOT_KEY_ROWS = 10_000_000
# Rows a segment may have before there are more segments than shuffle partitions: each is a task and a file.
SEGMENT_ROWS = 1_000_000


def previous_value(
    df: DataFrame, key: str, ts: str, value: str, out: str, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Add ``out``: ``value`` of the preceding row of the same key by ``ts``.

    Equals ``lag(value) over (partition by key order by ts, value)``; rows are
    kept whole. The input is written once. Where no key has more than
    ``hot_key_rows`` rows, a plain window is enough. Else all rows are cut at
    quantiles of their order (key, time, value, row): segments are equally large
    however many rows share a key, a time or a value. There are as many as keep
    them under ``hot_key_rows`` rows, but beyond one per shuffle partition only as
    many as keep them under ``SEGMENT_ROWS``. ``lag`` runs inside a
    segment, and only the first row of a key in a segment takes the last value of
    the segment before it.
    """
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "timeline")
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    largest, total = per_key.agg(F.max("n"), F.sum("n")).first()
    if (largest or 0) <= hot_key_rows:
        order = Window.partitionBy(key).orderBy(ts, value)
        return rows.withColumn(out, F.lag(value).over(order)).select(*df.columns, out)

    cut = segments(rows, [key, ts, value, "_row"], segment_count(df, total, hot_key_rows))
    inside = Window.partitionBy(key, "_segment").orderBy(ts, value, "_row")
    local = cut.withColumn("_before", F.lag(value).over(inside)).withColumn("_place", F.row_number().over(inside))
    ends = cut.groupBy(key, "_segment").agg(F.max(F.struct(ts, value, "_row")).alias("_last"))
    by_order = Window.partitionBy(key).orderBy("_segment")
    # A key goes on over the border of a segment at most once per border: fewer rows than segments.
    carried = ends.withColumn("_carry", F.lag(F.struct(F.col(f"_last.{value}").alias("value"))).over(by_order)).where(
        F.col("_carry").isNotNull()).select(key, "_segment", "_carry")
    joined = local.join(F.broadcast(carried), [key, "_segment"], "left")
    previous = F.when(F.col("_place") == 1, F.col("_carry.value")).otherwise(F.col("_before"))
    return joined.withColumn(out, previous).select(*df.columns, out)


def segment_count(df: DataFrame, total: int, most: int) -> int:
    """Segments of at most about ``most`` rows, unless that makes more than tasks are worth."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(-(-2 * total // most), max(tasks, -(-2 * total // SEGMENT_ROWS)))


def segments(rows: DataFrame, order: list[str], count: int) -> DataFrame:
    """The rows with ``_segment``: ``count`` ranges of about equally many rows, by a total order of the rows.

    Written once: sampled again, the borders might fall elsewhere.
    """
    placed = rows.repartitionByRange(max(2, count), *order)
    return staged(placed.withColumn("_segment", F.spark_partition_id()), "segments")

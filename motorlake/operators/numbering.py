"""Gapless numbering of distinct keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlake.session import staged

# Three hex digits: 4,096 buckets of equal size, whatever the keys look like.
_BUCKET_DIGITS = 3


def key_digest(keys: list[str]) -> Column:
    """md5 of the key columns; a null differs from every text."""
    parts = ", ".join(f"coalesce('+' || CAST({k} AS STRING), '-')" for k in keys)
    return F.expr(f"md5(concat_ws(char(31), {parts}))")


def dense_index(df: DataFrame, keys: list[str], out: str, base: DataFrame | None = None) -> DataFrame:
    """Number distinct keys 1..n in digest order, starting after ``base``.

    Rows are ranked inside a digest bucket, in parallel, and shifted by the row
    count of the buckets before it. Everything is a function of the row's own
    key and the bucket counts, so a recomputed task assigns the same numbers.
    ``base`` is a one-row frame with the highest number in use. The rows are
    computed once and written, since the counts and the ranks both need them.
    """
    tagged = staged(df.withColumn("_digest", key_digest(keys)).withColumn(
        "_bucket", F.substring("_digest", 1, _BUCKET_DIGITS)
    ), "numbering")
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    if base is not None:
        # The empty name sorts before every bucket, so it shifts all of them.
        start = base.select(F.lit("").alias("_bucket"), F.coalesce(F.col(base.columns[0]), F.lit(0)).alias("_n"))
        counts = counts.unionByName(start)
    # At most 4,097 rows, a constant: one task and a broadcast are fine here.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", *keys))
    return (
        tagged.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, (F.col("_offset") + F.col("_rank")).cast("bigint"))
        .select(*df.columns, out)
    )


def assign_surrogate_keys(new: DataFrame, existing: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Keys for new business keys, above every key in use; used keys stay."""
    highest = existing.agg(F.max(out).alias("_highest"))
    return dense_index(new, keys, out, highest).select(out, *new.columns)


def id_chunks(ids: DataFrame, key: str, size: int) -> DataFrame:
    """Fixed-size chunks of distinct ids: (chunk_no, ids) comma-joined."""
    numbered = dense_index(ids, [key], "_index")
    chunk = F.floor((F.col("_index") - 1) / size).cast("bigint")
    return (
        numbered.groupBy(chunk.alias("chunk_no"))
        .agg(F.sort_array(F.collect_list(key)).alias("_ids"))  # at most ``size`` ids
        .select("chunk_no", F.size("_ids").alias("n_ids"), F.array_join(F.col("_ids").cast("array<string>"), ",").alias("ids"))
    )


def batch_numbers(rows: DataFrame, key: str, size: int, out: str = "batch_no") -> DataFrame:
    """Assign rows with distinct keys to batches of ``size``, numbered from 1."""
    numbered = dense_index(rows, [key], "_index")
    return numbered.withColumn(out, (F.floor((F.col("_index") - 1) / size) + 1).cast("bigint")).drop("_index")

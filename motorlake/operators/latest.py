"""First and last row per key, without gathering a key's rows in one task.

All of these are aggregates with a map-side partial step (or a window the
planner limits before the shuffle), so a key that holds a large part of the
data costs each task one candidate row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlake.session import staged


def last_per_key(
    df: DataFrame, keys: list[str], order: list[str], where: Column | None = None
) -> DataFrame:
    """The row with the greatest ``order`` per key; remaining columns break ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    candidate = F.struct(*order, *rest)
    rows = df if where is None else df.where(where)
    return (
        rows.groupBy(*keys).agg(F.max(candidate).alias("_last"))
        .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in order + rest])
        .select(*df.columns)
    )


def first_in_order(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, first in ``order`` (SQL's DISTINCT ON)."""
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key. The rank filter lets the planner keep only
    ``n`` rows per key and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_and_last_seen(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(ts).alias("first_seen_at"), F.max(ts).alias("last_seen_at"))


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail when a merge source holds a key twice; otherwise the rows as they are.

    The source is written once. Keys are counted by a hash aggregate of their own
    columns; the rows themselves are not shuffled or sorted for it.
    """
    rows = staged(df, "merge-source")
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"duplicate merge key: {', '.join(f'{k}={twice[0][k]}' for k in keys)}")
    return rows

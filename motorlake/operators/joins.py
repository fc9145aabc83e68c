"""Join helpers: null-safe keys, lookups, conflict checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROW_LIMIT = 100_000


def keys_match(left: str, right: str, plain: list[str], null_safe: list[str] = ()) -> Column:
    """Equality on ``plain`` and IS NOT DISTINCT FROM on ``null_safe`` columns.

    ``left`` and ``right`` are frame aliases. Catalyst turns the null-safe
    conjuncts into hashable keys, so the join stays an equi-join.
    """
    parts = [f"{left}.{c} = {right}.{c}" for c in plain] + [f"{left}.{c} <=> {right}.{c}" for c in null_safe]
    return F.expr(" AND ".join(parts))


def key_digest64(columns: list[str]) -> Column:
    """64 bits of the columns together; a null differs from any value, and its place counts."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def lookup_key(rows: DataFrame, dimension: DataFrame, columns: list[str], key: str) -> DataFrame:
    """``rows`` with the ``key`` of the dimension row that has equal ``columns``, nulls being equal values.

    The join is on one digest of the columns, however many there are. The columns
    themselves are compared where digests meet, as a sum over all of them that no
    rule takes for a join key, so a digest shared by chance joins nothing.
    """
    left = rows.withColumn("_digest", key_digest64(columns)).alias("s")
    right = dimension.select(key, *columns, key_digest64(columns).alias("_digest")).alias("d")
    equal = sum((F.col(f"s.{c}").eqNullSafe(F.col(f"d.{c}")).cast("int") for c in columns[1:]), F.col(f"s.{columns[0]}").eqNullSafe(F.col(f"d.{columns[0]}")).cast("int"))
    met = left.join(right, (F.col("s._digest") == F.col("d._digest")) & (equal == len(columns)))
    return met.select(*[F.col(f"s.{c}").alias(c) for c in rows.columns], F.col(f"d.{key}").alias(key))


def not_in(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not present yet (nulls count as equal values)."""
    known = existing.select(*keys).alias("known")
    return rows.alias("sent").join(known, keys_match("sent", "known", [], keys), "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Orphan keys with their row counts: child rows are counted per key before
    the join, so a key that fills the table is one row in it."""
    per_key = child.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return orphans(per_key, column, parent, parent_column)


def broadcast_calendar(days: DataFrame) -> DataFrame:
    """Broadcast a calendar: one row per day, so 100,000 rows are 270 years.

    The limit is the proof of the bound, not a cut: callers build calendars
    from a day range and ``calendar_days`` refuses a longer one.
    """
    return F.broadcast(days)

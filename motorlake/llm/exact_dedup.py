"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

A counter summary of Misra-Gries kind (``freqItems``: every digest with more than ``support`` of the rows is in it, and
it holds at most ``1 / support`` digests) finds the digests that may be frequent. Their winners are verified by exact
aggregates over all rows, with a map-side step, and broadcast: at most ``1 / support`` rows, whatever the input. Rows of
frequent digests are resolved map-side and never shuffled; all others take an ordinary shuffle on the digest, where no
group can hold more than ``support`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import identity, rows_chosen, staged

SUPPORT = 0.001

def _rank() -> Column:
    """(key, row) as one decimal, so that the winner comes from a hash aggregate; a null key is below all others."""
    return F.expr("""
        cast(coalesce(cast(key AS decimal(19,0)), cast('-9223372036854775809' AS decimal(19,0)))
             * cast('10000000000000000000' AS decimal(20,0)) + cast(9223372036854775807 - row AS decimal(19,0))
             AS decimal(38,0))""")


def _winners(rows: DataFrame) -> DataFrame:
    """One row per digest: the key that stays, its row number, the size of the group."""
    best = rows.groupBy("digest").agg(
        F.max("key").alias("keep_id"), F.max(_rank()).alias("best"), F.count(F.lit(1)).alias("group_size"))
    row = F.expr("9223372036854775807 - cast(pmod(best, cast('10000000000000000000' AS decimal(20,0))) AS bigint)")
    return best.select("digest", "keep_id", "group_size", row.alias("keep_row"))


def _marked(rows: DataFrame, support: float) -> DataFrame:
    # Written once: evaluated again, the summary may hold other digests, and rows would go to both sides or neither.
    frequent = staged(rows.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest")), "frequent")
    hot = _winners(rows.join(F.broadcast(frequent), "digest", "left_semi"))
    hot_rows = rows.join(F.broadcast(hot), "digest")
    rest = rows.join(F.broadcast(frequent), "digest", "left_anti")
    return hot_rows.unionByName(rest.join(_winners(rest), "digest"))


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Row number, identity, key and digest of every row, written once so that the numbers stay what they are."""
    return staged(docs.select(
        F.monotonically_increasing_id().alias("row"), identity(key, text).alias("id"),
        F.col(f"`{key}`").cast("bigint").alias("key"),
        F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256).alias("digest")), "exact-dedup")


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """Every row's group of equal texts and whether it is the one that stays.

    Result, one row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``. Of equal texts the row with the
    largest key stays. A null text equals the empty one. A null key is smaller than any other; a group of null keys
    only has a null ``keep_id``. Rows repeated with key and text count each, and exactly one of them is kept. Texts of
    any length are digested whole. An empty table gives an empty result. Other columns are ignored.
    """
    rows = numbered(docs, key, text)
    return _marked(rows, support).select(
        F.col("key").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows that ``mark_copies`` keeps, with all their columns, whatever their names."""
    rows = numbered(docs, key, text)
    many = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_many"))
    kept = _marked(rows, support).where(F.col("row") == F.col("keep_row")).select("id").distinct()
    chosen = staged(kept.join(many, "id").withColumnRenamed("id", "_id"), "kept")
    return rows_chosen(docs, chosen, key, text)

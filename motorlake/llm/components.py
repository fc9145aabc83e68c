"""Connected components as repeated DataFrame joins (alternating large and small stars).

Every round is written to the shared folder; nothing is collected but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node links its larger (or its smaller) neighbours to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        out = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
    else:
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        linked = both.join(least, "u")
        out = linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` of every node that has a link to another one; the root is the component's smallest node."""
    edges = staged(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = None
    while True:
        edges = staged(_star(_star(edges, large=True), large=False), "edges")
        # Done when every node hangs on its root alone and nothing moved.
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("bigint")).alias("h")).first()
        if (now["n"], now["h"]) == state:
            break
        state = (now["n"], now["h"])
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""Registry of named queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.checks.bindings import Tables
from motorlake.checks.oracle import with_views


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None, views: str = ""):
    """Register a query under its function name.

    ``covers``: inventory ids it exercises; ``sql``: the same result in plain
    SQL over the given tables; ``views``: domain views that SQL uses.
    """
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = Query(fn.__name__, covers, fn, with_views(sql, views) if sql else None)
        return fn

    return register


def present(df: DataFrame) -> DataFrame:
    """Types that compare alike across engines: text days, doubles, local times."""
    out = []
    for f in df.schema.fields:
        column, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "date":
            column = column.cast("string")
        elif kind == "decimal":
            column = column.cast("double")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "array":
            column = F.array_join(column.cast("array<string>"), "|")
        elif kind in ("short", "byte"):
            column = column.cast("int")
        out.append(column.alias(f.name))
    return df.select(out)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, folder: present(q.run(Tables(spark, folder)))

    return {name: bind(q) for name, q in QUERIES.items()}


def oracle() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}

"""Publishing the gold tables through a named sink."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from motorlake.schemas import GOLD_ORDER, LAKE
from motorlake.sinks.files import column_types, conform, counted_write, export_table, write_table


@dataclass
class ParquetSink:
    """Published copy as Parquet tables under ``root/gold``."""

    root: str
    name: str = "parquet"

    def load(self, df: DataFrame, table: str) -> int:
        return write_table(df, f"{self.root}/gold/{table}", table)


@dataclass
class JdbcSink:
    """Published copy in a database, written by parallel batched inserts."""

    url: str
    properties: dict
    schema: str = "gold"
    name: str = "jdbc"

    def load(self, df: DataFrame, table: str) -> int:
        def write(rows: DataFrame) -> None:
            (
                rows.write.format("jdbc").mode("overwrite").options(**self.properties)
                .option("url", self.url).option("dbtable", f"{self.schema}.{table}")
                .option("truncate", True).option("batchsize", 10_000)
                .option("createTableColumnTypes", column_types(rows.schema)).save()
            )

        return counted_write(df, write)


_SINKS: dict[str, Callable] = {"parquet": ParquetSink, "jdbc": JdbcSink, "none": lambda **_: None}


def register_sink(name: str, factory: Callable) -> None:
    """Add a sink: a factory of objects with ``name`` and ``load(df, table)``."""
    _SINKS[name] = factory


def get_sink(name: str, **options):
    """The sink of this name; 'none' gives no sink."""
    try:
        return _SINKS[name.lower()](**options)
    except KeyError:
        raise ValueError(f"unknown sink {name!r}, expected one of {sorted(_SINKS)}") from None


def publish(tables: dict[str, DataFrame], sink, export_root: str, as_of) -> list[tuple]:
    """Export and load each gold table, dimensions first.

    A failing table is reported and does not stop the others; ``raise_failed``
    ends the run after them. The loop runs
    over table names; each step is a distributed write. The load reads the
    export back, so a table is computed once.
    """
    results = []
    if sink is None:
        return results
    for name in [t for t in GOLD_ORDER if t in tables]:
        try:
            spark = tables[name].sparkSession
            path = export_table(conform(tables[name], LAKE["gold"][name]), export_root, name, as_of)
            rows = sink.load(conform(spark.read.parquet(path), LAKE["gold"][name]), name)
            results.append((name, rows, "loaded", None))
        except Exception as error:  # noqa: BLE001 - isolate per table
            results.append((name, None, "failed", str(error).split("\n")[0]))
    return results


def raise_failed(results: list[tuple]) -> None:
    """Fail a publishing run at its end if any of its tables failed."""
    failed = [f"{name}: {error}" for name, _, status, error in results if status == "failed"]
    if failed:
        raise RuntimeError("tables not published: " + "; ".join(failed))


def publish_summary(spark: SparkSession, results: list[tuple]) -> DataFrame:
    """One row per table (at most six)."""
    return spark.createDataFrame(results, "table_name string, rows long, status string, error string")

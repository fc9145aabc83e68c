"""Declarative data-quality checks over whole tables.

All column checks of a table share one scan. Every check yields the same row:
(check_name, table_name, value, threshold, direction, level, passed).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.functions.dates import safe_ratio
from motorlake.operators.joins import orphan_counts

COLUMNS = ["check_name", "table_name", "value", "threshold", "direction", "level", "passed"]


class QualityError(ValueError):
    """An error-level check failed."""


@dataclass(frozen=True)
class Threshold:
    """One aggregate over a table with the bound its value has to keep."""

    name: str
    table: str
    value: Column
    bound: float
    direction: str = "max"  # 'max': value <= bound, 'min': value >= bound
    level: str = "error"


def not_null(table: str, column: str, where: Column | None = None, level: str = "error") -> Threshold:
    broken = F.col(column).isNull() if where is None else F.col(column).isNull() & where
    return Threshold(f"not_null_{column}", table, F.count_if(broken), 0, "max", level)


def accepted_values(table: str, column: str, values: list, level: str = "error") -> Threshold:
    broken = F.col(column).isNotNull() & ~F.col(column).isin(values)
    return Threshold(f"accepted_values_{column}", table, F.count_if(broken), 0, "max", level)


def null_ratio(column: str, where: Column | None = None) -> Column:
    """Share of nulls among the rows, 0.0 over no rows."""
    of = F.lit(True) if where is None else where
    return safe_ratio(F.count_if(of & F.col(column).isNull()), F.count_if(of))


def run_thresholds(table: DataFrame, checks: list[Threshold]) -> DataFrame:
    """All checks of one table in one aggregation, one output row per check."""
    wide = table.agg(*[c.value.cast("double").alias(f"_c{i}") for i, c in enumerate(checks)])
    rows = [_result(c, F.col(f"_c{i}")) for i, c in enumerate(checks)]
    return wide.select(F.inline(F.array(*rows)))


def _result(check: Threshold, value: Column) -> Column:
    bound = F.lit(float(check.bound))
    ok = value <= bound if check.direction == "max" else value >= bound
    return F.struct(
        F.lit(check.name).alias("check_name"), F.lit(check.table).alias("table_name"), value.alias("value"),
        bound.alias("threshold"), F.lit(check.direction).alias("direction"), F.lit(check.level).alias("level"),
        ok.alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups with more than one row; nulls count as equal values."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique(df: DataFrame, table: str, keys: list[str], ignore_nulls: bool = False) -> DataFrame:
    """A uniqueness check, as a result row."""
    rows = df.dropna(subset=keys) if ignore_nulls else df
    check = Threshold("unique_" + "_".join(keys), table, F.count(F.lit(1)), 0)
    return run_thresholds(duplicate_keys(rows, keys), [check])


def relationship(child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """A foreign-key check, as a result row."""
    rows = F.coalesce(F.sum("n"), F.lit(0))
    check = Threshold(f"relationship_{column}", child_name, rows, 0)
    return run_thresholds(orphan_counts(child, column, parent, parent_column), [check])


def combine(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> dict:
    """Raise on failed error-level checks; return the counts otherwise.

    Reads one row per configured check, never table data.
    """
    failed = results.where(~F.col("passed")).collect()
    errors = [r for r in failed if r["level"] == "error"]
    if errors:
        lines = [f"{r['table_name']}.{r['check_name']} = {r['value']} (bound {r['threshold']})" for r in errors]
        raise QualityError("Data quality checks failed:\n" + "\n".join(lines))
    return {"dq_checks_passed": True, "warnings": len(failed), "errors": 0}

"""File sinks: dated exports, published copies and listing files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlake.functions.text import redact_secrets
from motorlake.functions.values import flatten_list, repair_integers
from motorlake.schemas import PARTITION_COLUMN


def export_path(root: str, table: str, as_of) -> str:
    """``{root}/YYYY/MM/DD/{table}_{YYYYMMDD}.parquet``"""
    return f"{root}/{as_of:%Y/%m/%d}/{table}_{as_of:%Y%m%d}.parquet"


def export_table(df: DataFrame, root: str, table: str, as_of, date_key: int | None = None) -> str:
    """Write a dated snappy Parquet snapshot and return its path."""
    rows = df.where(F.col("date_key") == date_key) if date_key else df
    path = export_path(root, table, as_of)
    repair_integers(rows).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order and types; a failing cast raises."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and count in the same pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_table(df: DataFrame, path: str, table: str) -> int:
    """Replace a published table; facts are partitioned by date key.

    Rows are brought together by their day before writing: a day is one file, or
    as many as its size asks for, and not one from every task.
    """
    def write(rows: DataFrame) -> None:
        partition = PARTITION_COLUMN.get(table)
        if partition:
            rows.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)

    return counted_write(df, write)


def write_json_lines(listings: DataFrame, path: str) -> None:
    """One JSON object per line, nulls included."""
    listings.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(listings: DataFrame, path: str) -> None:
    """With header; photos joined by '; ', other lists as JSON text."""
    flat = listings.select([
        flatten_list(F.col(f.name)).alias(f.name) if f.name == "photos"
        else F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name)
        for f in listings.schema.fields
    ])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_bulk_csv(df: DataFrame, path: str) -> None:
    """Headerless CSV for a bulk load: null and '' are both written empty."""
    df.write.mode("overwrite").option("emptyValue", "").option("nullValue", "").option("escape", '"').csv(path)


def read_bulk_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The loaded form: an empty field is null."""
    return spark.read.schema(schema).option("escape", '"').csv(path)


_TARGET_TYPES = [
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "BIGINT"),
    ((T.FloatType, T.DoubleType, T.DecimalType), "NUMERIC"),
    ((T.BooleanType,), "BOOLEAN"),
    ((T.TimestampType, T.TimestampNTZType), "TIMESTAMPTZ"),
]


def target_type(kind: T.DataType) -> str:
    """Database column type for a table without a declared schema."""
    return next((name for kinds, name in _TARGET_TYPES if isinstance(kind, kinds)), "TEXT")


def column_types(schema: T.StructType) -> str:
    """Column types of a created table, in Spark's own names, which the database's dialect maps; decimals keep their size."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def target_profile(df: DataFrame) -> DataFrame:
    """(column_name, target_type, filled_rows) of a table, in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])
    rows = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(target_type(f.dataType)).alias("target_type"),
                 F.col(f"`{f.name}`").alias("filled_rows"))
        for f in df.schema.fields
    ]
    return counts.select(F.inline(F.array(*rows)))


def hide_secrets(df: DataFrame, column: str) -> DataFrame:
    """Redact a text column before it leaves the lake."""
    return df.withColumn(column, redact_secrets(F.col(column)))

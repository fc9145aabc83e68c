"""Lake tables: scans, registration and the catalog listing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlake.functions.values import repair_integers
from motorlake.schemas import LAKE, PARTITION_COLUMN


def scan_table(spark: SparkSession, path: str, date_key: int | None = None) -> DataFrame:
    """A table scan, limited to one date key where one is given."""
    table = spark.read.parquet(path)
    return table.where(F.col("date_key") == date_key) if date_key else table


def scan_repaired(spark: SparkSession, path: str) -> DataFrame:
    """A scan of a file whose whole numbers may be stored as floats."""
    return repair_integers(spark.read.parquet(path))


def ddl_of(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, NOT NULL included."""
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema.fields
    )


def create_lake(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Create the four databases and their tables where they are missing."""
    for database, tables in LAKE.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{database}` LOCATION '{root}/{database}'")
        for table in tables:
            create_table(spark, f"{prefix}{database}", table, LAKE[database][table], f"{root}/{database}/{table}")


def create_table(spark: SparkSession, database: str, table: str, schema: T.StructType, location: str) -> None:
    partition = PARTITION_COLUMN.get(table)
    clause = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({ddl_of(schema)}) USING parquet {clause} LOCATION '{location}'"
    )


def register_files(spark: SparkSession, database: str, table: str, path: str) -> None:
    """Register existing files as an external table."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` USING parquet LOCATION '{path}'")


def catalog_tables(spark: SparkSession, prefix: str = "") -> DataFrame:
    """(schema_name, table_name) of every database whose name has the prefix."""
    found = [
        (db.name, t.name)
        for db in spark.catalog.listDatabases(f"{prefix}*")
        for t in spark.catalog.listTables(db.name)
        if not t.isTemporary
    ]
    return spark.createDataFrame(found, "schema_name string, table_name string")


def missing_tables(spark: SparkSession, expected: DataFrame, prefix: str = "") -> DataFrame:
    return expected.exceptAll(catalog_tables(spark, prefix))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)

"""Quality suites and the published-copy report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.functions.dates import date_key, on_day
from motorlake.operators import quality as Q
from motorlake.plans.gold import Gold
from motorlake.plans.silver import Silver
from motorlake.schemas import FOREIGN_KEYS, LOCATION_COLUMNS, PRIMARY_KEYS, SELLER_COLUMNS, VEHICLE_COLUMNS
from motorlake.sources.tables import row_counts


def run_suite(raw: DataFrame, silver: Silver, facts: DataFrame, day, error_level: str = "error") -> DataFrame:
    """The five run checks; ``error_level='warning'`` is the relaxed suite."""
    today = F.lit(day).cast("date")
    missing = F.col("make").isNull() | F.col("model").isNull()
    per_table = [
        (raw, [Q.Threshold("Bronze rows today", "raw_listing_html", F.count_if(on_day(F.col("fetched_at"), today)), 0, "min", "warning")]),
        (silver.snapshots, [Q.Threshold("Silver snapshots today", "listing_snapshot_daily", F.count_if(F.col("snapshot_date") == today), 0, "min", "warning")]),
        (facts, [Q.Threshold("Gold facts today", "fact_listing_daily", F.count_if(F.col("date_key") == date_key(today)), 0, "min", "warning")]),
        (silver.current, [
            Q.Threshold("Price Null Ratio (Max)", "listing_current", Q.null_ratio("price_kzt", F.col("is_active")), 0.5, "max", error_level),
            Q.Threshold("Missing make/model (should be 0)", "listing_current", F.count_if(missing), 0, "max", error_level),
        ]),
    ]
    return Q.combine([Q.run_thresholds(df, checks) for df, checks in per_table])


# table -> (not-null columns, not-null-when-active columns)
_NOT_NULL = {
    "fact_listing_daily": (["date_key", "listing_id", "location_key", "vehicle_key", "seller_key", "is_active"], ["price_kzt"]),
    "fact_price_event": (["listing_id", "event_ts", "date_key"], []),
    "dim_date": (["date_key", "d"], []),
    "dim_vehicle": (["vehicle_key", "make", "model"], []),
    "dim_location": (["location_key", "city"], []),
    "dim_seller": (["seller_key"], []),
    "listing_current": (["listing_id", "is_active"], ["price_kzt", "make", "model"]),
    "listing_snapshot_daily": (["listing_id", "snapshot_date", "is_active"], []),
}
_UNIQUE = {
    "dim_date": [["date_key"], ["d"]],
    "dim_vehicle": [["vehicle_key"]],
    "dim_location": [["location_key"]],
    "dim_seller": [["seller_key"]],
    "listing_current": [["listing_id"]],
}
_BUSINESS_KEYS = {"dim_location": LOCATION_COLUMNS, "dim_vehicle": VEHICLE_COLUMNS, "dim_seller": SELLER_COLUMNS}
_BOOLEANS = ["fact_listing_daily", "listing_current", "listing_snapshot_daily"]


def not_null_results(tables: dict[str, DataFrame]) -> DataFrame:
    results = []
    for name, (always, when_active) in _NOT_NULL.items():
        if name in tables:
            checks = [Q.not_null(name, c) for c in always]
            checks += [Q.not_null(name, c, F.col("is_active")) for c in when_active]
            results.append(Q.run_thresholds(tables[name], checks))
    return Q.combine(results)


def accepted_value_results(tables: dict[str, DataFrame]) -> DataFrame:
    return Q.combine([
        Q.run_thresholds(tables[n], [Q.accepted_values(n, "is_active", [True, False])]) for n in _BOOLEANS if n in tables
    ])


def unique_results(tables: dict[str, DataFrame]) -> DataFrame:
    return Q.combine([
        Q.unique(tables[n], n, keys, ignore_nulls=True) for n, sets in _UNIQUE.items() if n in tables for keys in sets
    ])


def primary_key_results(tables: dict[str, DataFrame]) -> DataFrame:
    return Q.combine([Q.unique(df, n, PRIMARY_KEYS[n]) for n, df in tables.items()])


def business_key_results(tables: dict[str, DataFrame]) -> DataFrame:
    return Q.combine([Q.unique(tables[n], n, keys) for n, keys in _BUSINESS_KEYS.items() if n in tables])


def relationship_results(tables: dict[str, DataFrame]) -> DataFrame:
    return Q.combine([
        Q.relationship(tables[child], child, column, tables[parent], parent_column)
        for child, column, parent, parent_column in FOREIGN_KEYS
    ])


def schema_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared column and key check of the silver and gold tables."""
    return Q.combine([
        not_null_results(tables), unique_results(tables), accepted_value_results(tables), relationship_results(tables),
    ])


def top_makes(facts: DataFrame, dim_vehicle: DataFrame, n: int = 5) -> DataFrame:
    """The makes with most fact rows; facts are counted per key before the lookup."""
    per_vehicle = facts.groupBy("vehicle_key").agg(F.count(F.lit(1)).alias("_n"))
    makes = per_vehicle.join(dim_vehicle.select("vehicle_key", "make"), "vehicle_key")
    return makes.groupBy("make").agg(F.sum("_n").alias("n")).orderBy(F.desc("n"), F.asc("make")).limit(n)


def publish_report(gold: Gold) -> DataFrame:
    """(probe, label, value): counts, distinct listings, latest key, top makes."""
    facts = gold.fact_listing_daily
    counts = row_counts(gold.tables()).select(F.lit("rows").alias("probe"), F.col("table_name").alias("label"), F.col("row_count").alias("value"))
    span = facts.agg(F.count_distinct("listing_id").alias("u"), F.max("date_key").cast("bigint").alias("k"))
    summary = span.select(F.inline(F.array(
        F.struct(F.lit("unique_listings").alias("probe"), F.lit("fact_listing_daily").alias("label"), F.col("u").alias("value")),
        F.struct(F.lit("latest_date_key").alias("probe"), F.lit("fact_listing_daily").alias("label"), F.col("k").alias("value")),
    )))
    makes = top_makes(facts, gold.dim_vehicle).select(F.lit("top_make").alias("probe"), F.col("make").alias("label"), F.col("n").alias("value"))
    return Q.combine([counts, summary, makes])


def probe_each(probes: dict) -> list[tuple]:
    """Run named probes apart from each other: (name, value, error)."""
    results = []
    for name, probe in probes.items():
        try:
            results.append((name, probe(), None))
        except Exception as error:  # noqa: BLE001 - one failing probe must not hide the others
            results.append((name, None, str(error).split("\n")[0]))
    return results

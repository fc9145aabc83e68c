"""Gold: the star schema, built by insert-if-absent dimensions and fact merges."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.functions.dates import calendar_parts, date_key, days_on_site
from motorlake.operators.joins import broadcast_calendar, lookup_key, not_in
from motorlake.operators.latest import first_in_order
from motorlake.operators.merge import insert_if_absent, upsert
from motorlake.operators.numbering import assign_surrogate_keys
from motorlake.plans.silver import Silver
from motorlake.schemas import (
    FACT_LISTING_DAILY, FACT_PRICE_EVENT, LAKE, LOCATION_COLUMNS, SELLER_COLUMNS, VEHICLE_COLUMNS, empty,
)


@dataclass
class Gold:
    dim_date: DataFrame
    dim_location: DataFrame
    dim_vehicle: DataFrame
    dim_seller: DataFrame
    fact_listing_daily: DataFrame
    fact_price_event: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        """In load order: dimensions first."""
        return {f.name: getattr(self, f.name) for f in fields(self)}


def empty_gold(spark: SparkSession) -> Gold:
    return Gold(**{name: empty(spark, schema) for name, schema in LAKE["gold"].items()})


def location_rows(current: DataFrame) -> DataFrame:
    return current.where(F.col("city").isNotNull()).select(*LOCATION_COLUMNS).distinct()


def vehicle_rows(current: DataFrame) -> DataFrame:
    return current.dropna(subset=["make", "model"]).select(*VEHICLE_COLUMNS).distinct()


def seller_rows(current: DataFrame) -> DataFrame:
    """No filter: an all-null seller is a row of its own."""
    return current.select(*SELLER_COLUMNS).distinct()


def new_dimension_rows(dimension: DataFrame, rows: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Unseen business keys with surrogate keys above those in use."""
    return assign_surrogate_keys(not_in(rows, dimension, keys), dimension, keys, key)


def grow_dimension(dimension: DataFrame, rows: DataFrame, keys: list[str], key: str) -> DataFrame:
    new = new_dimension_rows(dimension, rows, keys, key)
    return dimension.unionByName(new.select(*dimension.columns))


def grow_calendar(dim_date: DataFrame, days: DataFrame) -> DataFrame:
    return insert_if_absent(dim_date, days, ["d"])


def snapshot_days(snapshots: DataFrame) -> DataFrame:
    """Calendar rows of the days that snapshots fall on."""
    days = snapshots.select(F.col("snapshot_date").alias("d")).where(F.col("d").isNotNull()).distinct()
    return days.select(date_key(F.col("d")).alias("date_key"), "d", *[c.alias(n) for n, c in calendar_parts(F.col("d")).items()])


def _resolvable() -> Column:
    return F.col("city").isNotNull() & F.col("make").isNotNull() & F.col("model").isNotNull()


def listing_keys(current: DataFrame, location: DataFrame, vehicle: DataFrame, seller: DataFrame) -> DataFrame:
    """Dimension keys per listing.

    The lookups run on one row per listing, not on one row per listing and day,
    each on a digest of the business key. A listing without city, make or model
    has no keys.
    """
    attributes = dict.fromkeys(LOCATION_COLUMNS + VEHICLE_COLUMNS + SELLER_COLUMNS)
    rows = current.where(_resolvable()).select("listing_id", "first_seen_at", *attributes)
    rows = lookup_key(rows, location, LOCATION_COLUMNS, "location_key")
    rows = lookup_key(rows, vehicle, VEHICLE_COLUMNS, "vehicle_key")
    rows = lookup_key(rows, seller, SELLER_COLUMNS, "seller_key")
    return rows.select("listing_id", "first_seen_at", "location_key", "vehicle_key", "seller_key")


def dropped_snapshots(snapshots: DataFrame, current: DataFrame, dim_date: DataFrame) -> DataFrame:
    """(reason, n) of the snapshots that ``resolve_star`` leaves out."""
    days = broadcast_calendar(dim_date.select(F.col("d").alias("snapshot_date"), F.lit(True).alias("_day")))
    listed = current.select("listing_id", F.lit(True).alias("_listed"), F.col("city").isNull().alias("_no_city"), (~_resolvable()).alias("_no_keys"))
    reason = (
        F.when(F.col("_listed").isNull(), "unknown listing").when(F.col("_no_city"), "no city")
        .when(F.col("_no_keys"), "no make or model").when(F.col("_day").isNull(), "day outside the calendar")
    )
    joined = snapshots.join(days, "snapshot_date", "left").join(listed, "listing_id", "left").select(reason.alias("reason"))
    return joined.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def resolve_star(snapshots: DataFrame, keys: DataFrame, dim_date: DataFrame, distinct_on: bool = False) -> DataFrame:
    """Fact rows of the snapshots: calendar and dimension keys resolved.

    ``keys`` comes from ``listing_keys``. A calendar grown by ``snapshot_days``
    has every day; days outside of it drop out, as ``dropped_snapshots`` counts.
    The keyed snapshot table cannot hold two rows for a listing and
    day; ``distinct_on`` keeps one where the input is not keyed, at the price of
    one more shuffle.
    """
    days = broadcast_calendar(dim_date.select("date_key", F.col("d").alias("snapshot_date")))
    rows = snapshots.join(days, "snapshot_date").join(keys, "listing_id")
    if distinct_on:
        rows = first_in_order(
            rows, ["date_key", "listing_id"],
            [F.desc("snapshot_date"), F.desc_nulls_last("price_kzt"), F.desc_nulls_last("photo_count"), F.desc("is_active")],
        )
    measures = {
        "days_on_site": days_on_site(F.col("snapshot_date"), F.col("first_seen_at")),
    }
    return rows.select([measures.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FACT_LISTING_DAILY.fields])


def upsert_facts(facts: DataFrame, batch: DataFrame) -> DataFrame:
    """Measures follow the batch; dimension keys stay as first inserted."""
    return upsert(
        facts, batch, ["date_key", "listing_id"],
        overwrite=["price_kzt", "is_active", "days_on_site", "views", "photo_count"],
        keep=["location_key", "vehicle_key", "seller_key"],
    )


def price_event_facts(events: DataFrame) -> DataFrame:
    return events.withColumn("date_key", date_key(F.col("event_ts"))).select(*FACT_PRICE_EVENT.names)


def insert_price_facts(facts: DataFrame, events: DataFrame) -> DataFrame:
    return insert_if_absent(facts, price_event_facts(events), ["listing_id", "event_ts"])


def ml_features(facts: DataFrame) -> DataFrame:
    """Feature rows with an untrained label column."""
    return facts.select(
        "date_key", "listing_id", "vehicle_key", "location_key", "seller_key", "price_kzt", "days_on_site",
        "views", "photo_count", F.lit(None).cast("int").alias("y_sold_30d_proxy"),
    )


def create_feature_view(facts: DataFrame, name: str = "ml_features_listing_day") -> None:
    ml_features(facts).createOrReplaceTempView(name)


def grow_dimensions(gold: Gold, current: DataFrame, days: DataFrame) -> Gold:
    return Gold(
        grow_calendar(gold.dim_date, days),
        grow_dimension(gold.dim_location, location_rows(current), LOCATION_COLUMNS, "location_key"),
        grow_dimension(gold.dim_vehicle, vehicle_rows(current), VEHICLE_COLUMNS, "vehicle_key"),
        grow_dimension(gold.dim_seller, seller_rows(current), SELLER_COLUMNS, "seller_key"),
        gold.fact_listing_daily,
        gold.fact_price_event,
    )


def grow_facts(gold: Gold, silver: Silver) -> Gold:
    keys = listing_keys(silver.current, gold.dim_location, gold.dim_vehicle, gold.dim_seller)
    batch = resolve_star(silver.snapshots, keys, gold.dim_date)
    return Gold(
        gold.dim_date, gold.dim_location, gold.dim_vehicle, gold.dim_seller,
        upsert_facts(gold.fact_listing_daily, batch),
        insert_price_facts(gold.fact_price_event, silver.price_events),
    )


def build_gold(gold: Gold, silver: Silver, days: DataFrame) -> Gold:
    """Dimensions, then facts. Running it again on the same input changes nothing.

    The calendar holds ``days`` and the days of all snapshots.
    """
    grown = grow_calendar(days, snapshot_days(silver.snapshots))
    return grow_facts(grow_dimensions(gold, silver.current, grown), silver)

"""Table schemas, keys and load order of the lakehouse."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S = T.LongType(), T.IntegerType(), T.StringType()
B, D, TS = T.BooleanType(), T.DateType(), T.TimestampType()
SHORT, DOUBLE = T.ShortType(), T.DoubleType()
MONEY, VOLUME = T.DecimalType(14, 2), T.DecimalType(3, 1)
STRINGS = T.ArrayType(S)


def _table(*fields: tuple) -> T.StructType:
    """Fields as (name, type) or (name, type, False) for NOT NULL."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


PAGE = _table(("listing_id", L, False), ("url", S, False), ("html", S, False))

PARSED = _table(
    ("listing_id", L, False), ("url", S, False), ("title", S), ("price_kzt", L),
    ("city", S), ("region", S), ("make", S), ("model", S), ("generation", S), ("trim", S),
    ("car_year", I), ("mileage_km", I), ("body_type", S), ("engine_volume_l", DOUBLE),
    ("engine_type", S), ("transmission", S), ("drivetrain", S), ("steering", S), ("color", S),
    ("customs_cleared", B), ("seller_name", S), ("seller_type", S, False),
    ("options_text", S), ("options_list", STRINGS, False), ("photos", STRINGS, False),
    ("photo_count", I, False),
)

QUEUE = _table(
    ("listing_id", L, False), ("url", S, False), ("discovered_at", TS, False), ("state", S, False),
    ("attempts", I, False), ("last_attempt_at", TS), ("next_retry_at", TS),
    ("last_http_status", I), ("last_error", S),
)

RAW_HTML = _table(
    ("listing_id", L, False), ("fetched_at", TS, False), ("bucket", S, False),
    ("object_key", S, False), ("sha256", S, False), ("http_status", I, False),
)

LISTING_CURRENT = _table(
    ("listing_id", L, False), ("url", S, False), ("title", S), ("price_kzt", MONEY),
    ("currency", S), ("city", S), ("region", S), ("make", S), ("model", S), ("generation", S),
    ("trim", S), ("car_year", I), ("mileage_km", I), ("body_type", S), ("engine_volume_l", VOLUME),
    ("engine_type", S), ("transmission", S), ("drivetrain", S), ("steering", S), ("color", S),
    ("customs_cleared", B), ("seller_name", S), ("seller_type", S), ("seller_user_id", L),
    ("seller_months_on_site", I), ("seller_inventory_count", I), ("seller_address", S),
    ("options_text", S), ("photos", S), ("first_seen_at", TS, False), ("last_seen_at", TS, False),
    ("is_active", B, False), ("payload_hash", S),
)

SNAPSHOT_DAILY = _table(
    ("listing_id", L, False), ("snapshot_date", D, False), ("price_kzt", MONEY),
    ("is_active", B, False), ("views", L), ("photo_count", I),
)

PRICE_EVENT = _table(
    ("listing_id", L, False), ("event_ts", TS, False), ("old_price_kzt", MONEY), ("new_price_kzt", MONEY),
)

DIM_DATE = _table(
    ("date_key", I, False), ("d", D, False), ("year", SHORT, False), ("quarter", SHORT, False),
    ("month", SHORT, False), ("day_of_week", SHORT, False),
)

DIM_LOCATION = _table(("location_key", L, False), ("region", S), ("city", S, False))

DIM_VEHICLE = _table(
    ("vehicle_key", L, False), ("make", S, False), ("model", S, False), ("generation", S), ("trim", S),
    ("car_year", I), ("body_type", S), ("engine_type", S), ("engine_volume_l", VOLUME),
    ("transmission", S), ("drivetrain", S), ("steering", S), ("color", S),
)

DIM_SELLER = _table(
    ("seller_key", L, False), ("seller_type", S), ("seller_name", S), ("seller_user_id", L), ("city", S),
)

FACT_LISTING_DAILY = _table(
    ("date_key", I, False), ("listing_id", L, False), ("location_key", L, False),
    ("vehicle_key", L, False), ("seller_key", L, False), ("price_kzt", MONEY), ("is_active", B, False),
    ("days_on_site", I), ("views", L), ("photo_count", I),
)

FACT_PRICE_EVENT = _table(
    ("event_ts", TS, False), ("date_key", I, False), ("listing_id", L, False),
    ("old_price_kzt", MONEY), ("new_price_kzt", MONEY),
)

# database -> table -> schema
LAKE = {
    "ctl": {"scrape_queue": QUEUE},
    "bronze": {"raw_listing_html": RAW_HTML},
    "silver": {
        "listing_current": LISTING_CURRENT,
        "listing_snapshot_daily": SNAPSHOT_DAILY,
        "listing_price_event": PRICE_EVENT,
    },
    "gold": {
        "dim_date": DIM_DATE,
        "dim_location": DIM_LOCATION,
        "dim_vehicle": DIM_VEHICLE,
        "dim_seller": DIM_SELLER,
        "fact_listing_daily": FACT_LISTING_DAILY,
        "fact_price_event": FACT_PRICE_EVENT,
    },
}

PRIMARY_KEYS = {
    "scrape_queue": ["listing_id"],
    "raw_listing_html": ["listing_id", "fetched_at"],
    "listing_current": ["listing_id"],
    "listing_snapshot_daily": ["listing_id", "snapshot_date"],
    "listing_price_event": ["listing_id", "event_ts"],
    "dim_date": ["date_key"],
    "dim_location": ["location_key"],
    "dim_vehicle": ["vehicle_key"],
    "dim_seller": ["seller_key"],
    "fact_listing_daily": ["date_key", "listing_id"],
    "fact_price_event": ["listing_id", "event_ts"],
}

# Business keys; nulls count as equal values in them.
LOCATION_COLUMNS = ["region", "city"]
VEHICLE_COLUMNS = [f.name for f in DIM_VEHICLE.fields[1:]]
SELLER_COLUMNS = [f.name for f in DIM_SELLER.fields[1:]]

# Dimensions load before the facts that point at them.
GOLD_ORDER = list(LAKE["gold"])
PARTITION_COLUMN = {"fact_listing_daily": "date_key", "fact_price_event": "date_key"}

FOREIGN_KEYS = [
    ("fact_listing_daily", "date_key", "dim_date", "date_key"),
    ("fact_listing_daily", "location_key", "dim_location", "location_key"),
    ("fact_listing_daily", "vehicle_key", "dim_vehicle", "vehicle_key"),
    ("fact_listing_daily", "seller_key", "dim_seller", "seller_key"),
    ("fact_price_event", "date_key", "dim_date", "date_key"),
]


def empty(spark, schema: T.StructType):
    """A table of this schema without rows.

    The filter folds to an empty relation, so merging into it leaves no join
    and no shuffle in the plan.
    """
    columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    return spark.range(1).where("false").selectExpr(*columns)

"""Silver: current state, daily snapshots and price events.

Input rows are *observations*: (listing_id, fetched_at, http_status) plus the
parsed record, whose fields are null on a failed fetch. Every table has one
definition as a merge of a batch into a state; the history form is the same
merge into an empty state. Inside a batch, observations order by fetch time,
and an observation that is not newer than the state never rewinds it, so a
replayed batch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlake.functions import fixed
from motorlake.functions.values import price_changed
from motorlake.operators.joins import not_in
from motorlake.operators.lag import HOT_KEY_ROWS, previous_value
from motorlake.operators.merge import insert_if_absent, update_join, upsert
from motorlake.schemas import LISTING_CURRENT, PRICE_EVENT, SNAPSHOT_DAILY, empty

# Columns an upsert overwrites, nulls included.
PAYLOAD = [
    "url", "title", "price_kzt", "city", "region", "make", "model", "generation", "trim", "car_year",
    "mileage_km", "body_type", "engine_volume_l", "engine_type", "transmission", "drivetrain", "steering",
    "color", "customs_cleared", "seller_name", "seller_type", "options_text", "photos",
]
# Columns only ever set by the first insert.
FIRST_ONLY = ["currency", "seller_user_id", "seller_months_on_site", "seller_inventory_count", "seller_address"]
#: Current state as a stream keeps it: with the time each listing was last missing, listings only ever missing included.
CURRENT_STATE = T.StructType([*LISTING_CURRENT.fields, T.StructField("gone_at", T.TimestampType())])
#: What price events follow from: one price per listing and fetch time.
PRICE_POINT = T.StructType([PRICE_EVENT["listing_id"], T.StructField("fetched_at", T.TimestampType()), LISTING_CURRENT["price_kzt"]])


@dataclass
class Silver:
    current: DataFrame
    snapshots: DataFrame
    price_events: DataFrame


def empty_silver(spark: SparkSession) -> Silver:
    return Silver(empty(spark, LISTING_CURRENT), empty(spark, SNAPSHOT_DAILY), empty(spark, PRICE_EVENT))


def is_ok() -> Column:
    return F.col("http_status") < 400


def is_gone() -> Column:
    return F.col("http_status") == 404


def split_valid(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rows without listing id or fetch time)."""
    usable = F.col("listing_id").isNotNull() & F.col("fetched_at").isNotNull()
    return observations.where(usable), observations.where(~usable)


def to_table_types(observations: DataFrame) -> DataFrame:
    """Cast record columns to their table types; photos become JSON text."""
    kinds = {f.name: f.dataType.simpleString() for f in LISTING_CURRENT.fields}

    def column(field) -> str:
        if field.name == "photos" and field.dataType.typeName() == "array":
            return "CASE WHEN http_status < 400 THEN to_json(coalesce(photos, array())) END AS photos"
        return f"CAST({field.name} AS {kinds[field.name]}) AS {field.name}" if field.name in kinds else field.name

    return observations.selectExpr(*[column(f) for f in observations.schema.fields])


def listing_summary(observations: DataFrame) -> DataFrame:
    """Per listing: the last good record and the last time it was missing.

    One aggregation with a map-side partial step: however many observations a
    listing has, each task passes on one candidate.
    """
    rows = to_table_types(observations)
    record = F.struct("fetched_at", *PAYLOAD, "payload_hash")
    return rows.groupBy("listing_id").agg(
        F.max(F.when(is_ok(), record)).alias("last"),
        F.min(F.when(is_ok(), F.col("fetched_at"))).alias("first_seen_at"),
        F.max(F.when(is_gone(), F.col("fetched_at"))).alias("gone_at"),
    )


def _current_rows(summary: DataFrame) -> DataFrame:
    unset = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in LISTING_CURRENT.fields if f.name in FIRST_ONLY[1:]]
    return summary.selectExpr(
        "listing_id", *[f"last.{c}" for c in PAYLOAD], "last.payload_hash", "first_seen_at",
        "last.fetched_at AS last_seen_at", f"'{fixed.CURRENCY}' AS currency", *unset, "gone_at",
    )


_IS_NEWER = "(b.last_seen_at IS NOT NULL AND (t.last_seen_at IS NULL OR b.last_seen_at > t.last_seen_at))"
_FIRST_SEEN = {"first_seen_at": "least(t.first_seen_at, b.first_seen_at)"}


def upsert_current(current: DataFrame, summary: DataFrame) -> DataFrame:
    """Merge listing summaries: newer good records overwrite, a later miss deactivates.

    A listing that was only ever missing is not inserted.
    """
    is_missing = "b.gone_at > greatest(b.last_seen_at, t.last_seen_at)"
    return upsert(
        current, _current_rows(summary), ["listing_id"],
        overwrite=PAYLOAD + ["payload_hash", "last_seen_at"], keep=FIRST_ONLY,
        computed=_FIRST_SEEN | {"is_active": f"CASE WHEN {is_missing} THEN false WHEN {_IS_NEWER} THEN true ELSE t.is_active END"},
        apply_when=_IS_NEWER, insert_when="b.last_seen_at IS NOT NULL",
    )


def upsert_current_state(state: DataFrame, summary: DataFrame) -> DataFrame:
    """``upsert_current`` for batches in any order of time, on a ``CURRENT_STATE``.

    A miss is remembered, also of a listing not seen yet, so whether a listing is
    active follows from its last good and its last missing fetch alone.
    """
    seen, gone = "greatest(b.last_seen_at, t.last_seen_at)", "greatest(b.gone_at, t.gone_at)"
    return upsert(
        state, _current_rows(summary), ["listing_id"],
        overwrite=PAYLOAD + ["payload_hash", "last_seen_at"], keep=FIRST_ONLY,
        computed=_FIRST_SEEN | {"gone_at": gone, "is_active": f"coalesce({seen} >= {gone}, {seen} IS NOT NULL)"},
        apply_when=_IS_NEWER,
    )


def known_listings(state: DataFrame) -> DataFrame:
    """The current table of a ``CURRENT_STATE``: listings fetched at least once."""
    return state.where(F.col("last_seen_at").isNotNull()).select(*LISTING_CURRENT.names)


def merge_current(current: DataFrame, observations: DataFrame) -> DataFrame:
    return upsert_current(current, listing_summary(observations))


def mark_inactive(current: DataFrame, gone: DataFrame) -> DataFrame:
    """Deactivate listings (listing_id, gone_at) found missing after they were last seen."""
    rows = current.join(gone.select("listing_id", "gone_at"), "listing_id", "left")
    missing = F.coalesce(F.col("gone_at") > F.col("last_seen_at"), F.lit(False))
    return rows.withColumn("is_active", F.when(missing, False).otherwise(F.col("is_active"))).select(*current.columns)


def day_summary(observations: DataFrame) -> DataFrame:
    """Per listing and day: last good price and photo count, last time missing."""
    rows = to_table_types(observations).withColumn("snapshot_date", F.to_date("fetched_at"))
    record = F.struct("fetched_at", "price_kzt", "photo_count")
    return rows.groupBy("listing_id", "snapshot_date").agg(
        F.max(F.when(is_ok(), record)).alias("last"),
        F.max(F.when(is_gone(), F.col("fetched_at"))).alias("gone_at"),
    )


def upsert_snapshots(snapshots: DataFrame, days: DataFrame) -> DataFrame:
    """Merge day summaries. A new row has unknown views; an update keeps the views
    it finds. A miss after the day's last good fetch deactivates that day's row."""
    batch = days.selectExpr(
        "listing_id", "snapshot_date", "last.price_kzt", "last.photo_count", "CAST(NULL AS BIGINT) AS views",
        "last.fetched_at AS seen_at", "gone_at",
    )
    is_missing = "b.gone_at IS NOT NULL AND (b.seen_at IS NULL OR b.gone_at > b.seen_at)"
    is_active = f"CASE WHEN {is_missing} THEN false WHEN b.seen_at IS NOT NULL THEN true ELSE t.is_active END"
    return upsert(
        snapshots, batch, ["listing_id", "snapshot_date"],
        overwrite=["price_kzt", "photo_count"], keep=["views"], computed={"is_active": is_active},
        apply_when="b.seen_at IS NOT NULL", insert_when="b.seen_at IS NOT NULL",
    )


def upsert_snapshot_state(state: DataFrame, days: DataFrame) -> DataFrame:
    """``upsert_snapshots`` for batches in any order of time.

    The state also holds when each listing was last fetched and last missing on a day (days with misses only
    included), so an older observation that arrives late never overwrites a newer one.
    """
    batch = days.selectExpr(
        "listing_id", "snapshot_date", "last.price_kzt", "last.photo_count", "CAST(NULL AS BIGINT) AS views",
        "last.fetched_at AS seen_at", "gone_at",
    )
    seen, gone = "greatest(b.seen_at, t.seen_at)", "greatest(b.gone_at, t.gone_at)"
    return upsert(
        state, batch, ["listing_id", "snapshot_date"],
        overwrite=["price_kzt", "photo_count"], keep=["views"],
        computed={"seen_at": seen, "gone_at": gone, "is_active": f"coalesce({seen} >= {gone}, {seen} IS NOT NULL)"},
        apply_when="b.seen_at IS NOT NULL AND (t.seen_at IS NULL OR b.seen_at >= t.seen_at)",
    )


def merge_snapshots(snapshots: DataFrame, observations: DataFrame) -> DataFrame:
    return upsert_snapshots(snapshots, day_summary(observations))


def mark_snapshots_inactive(snapshots: DataFrame, gone: DataFrame) -> DataFrame:
    """Deactivate the snapshots of the days listings (listing_id, gone_at) were missing."""
    updates = gone.select("listing_id", F.to_date("gone_at").alias("snapshot_date"), F.lit(False).alias("is_active")).distinct()
    return update_join(snapshots, updates, ["listing_id", "snapshot_date"], ["is_active"])


def price_changes(prices: DataFrame, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Price events of (listing_id, fetched_at, price_kzt) rows in fetch order.

    An event needs a known price before and after: an unknown price in between
    resets the baseline.
    """
    rows = prices.select("listing_id", F.col("fetched_at").alias("event_ts"), F.col("price_kzt").alias("new_price_kzt"))
    chained = previous_value(rows, "listing_id", "event_ts", "new_price_kzt", "old_price_kzt", hot_key_rows)
    return chained.where(price_changed(F.col("old_price_kzt"), F.col("new_price_kzt"))).select(*PRICE_EVENT.names)


def batch_price_events(current: DataFrame, observations: DataFrame, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Events of a batch, with the stored price as each listing's first one."""
    prices = to_table_types(observations.where(is_ok())).select("listing_id", "fetched_at", "price_kzt")
    stored = current.select("listing_id", F.col("last_seen_at").alias("fetched_at"), "price_kzt")
    known = stored.join(prices.select("listing_id").distinct(), "listing_id", "left_semi")
    newer = prices.join(known.select("listing_id", F.col("fetched_at").alias("_seen")), "listing_id", "left").where(
        F.col("_seen").isNull() | (F.col("fetched_at") > F.col("_seen"))
    )
    return price_changes(known.unionByName(newer.drop("_seen")), hot_key_rows)


def price_points(observations: DataFrame) -> DataFrame:
    """The prices of good fetches, unknown ones included."""
    return to_table_types(observations.where(is_ok())).select(*PRICE_POINT.names)


def fresh_points(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """The price points that are not stored yet, each once."""
    return not_in(arrived.distinct(), stored, PRICE_POINT.names).select(*PRICE_POINT.names)


def touched_points(stored: DataFrame, fresh: DataFrame, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The price points whose event new points change, with the point before them: the new ones and those right after one.

    Each new point stands between the stored point before it and the one after
    it, wherever in time that is: it may make an event of its own, and it takes
    the place of the predecessor of the point after it, whose old event goes.
    ``stored`` must hold, of every listing in ``fresh``, all points from the
    last one before its first new point on (more do no harm). A fetch time holds
    one point of a listing.
    """
    points = stored.select(*PRICE_POINT.names, F.lit(False).alias("is_new")).unionByName(
        fresh.select(*PRICE_POINT.names, F.lit(True).alias("is_new")))
    timed = points.select("listing_id", "fetched_at", F.struct("price_kzt", "is_new").alias("point"))
    chained = previous_value(timed, "listing_id", "fetched_at", "point", "before", hot_key_rows)
    return chained.where(F.col("point.is_new") | F.coalesce(F.col("before.is_new"), F.lit(False)))


def revised_price_events(touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What touched points change: (points whose stored event no longer holds, events that hold instead)."""
    gone = touched.where(~F.col("point.is_new")).select("listing_id", F.col("fetched_at").alias("event_ts"))
    events = touched.where(price_changed(F.col("before.price_kzt"), F.col("point.price_kzt"))).select(
        "listing_id", F.col("fetched_at").alias("event_ts"), F.col("before.price_kzt").alias("old_price_kzt"),
        F.col("point.price_kzt").alias("new_price_kzt"))
    return gone, events


def append_price_events(events: DataFrame, new: DataFrame) -> DataFrame:
    return insert_if_absent(events, new, ["listing_id", "event_ts"])


def apply_batch(state: Silver, observations: DataFrame, hot_key_rows: int = HOT_KEY_ROWS) -> Silver:
    """Merge a batch of observations into the three silver tables."""
    valid, _ = split_valid(observations)
    events = batch_price_events(state.current, valid, hot_key_rows)
    return Silver(
        merge_current(state.current, valid),
        merge_snapshots(state.snapshots, valid),
        append_price_events(state.price_events, events),
    )


def from_history(spark: SparkSession, observations: DataFrame, hot_key_rows: int = HOT_KEY_ROWS) -> Silver:
    """The silver tables of a complete observation history."""
    return apply_batch(empty_silver(spark), observations, hot_key_rows)


def missing_views(snapshots: DataFrame, day) -> DataFrame:
    """Snapshots of ``day`` without a view count (a partition-pruned filter)."""
    return snapshots.where((F.col("snapshot_date") == day) & F.col("views").isNull())


def set_views(snapshots: DataFrame, counts: DataFrame, day) -> DataFrame:
    """Store view counts (listing_id once each) on the snapshots of ``day``."""
    updates = counts.select("listing_id", F.lit(day).cast("date").alias("snapshot_date"), "views")
    return update_join(snapshots, updates, ["listing_id", "snapshot_date"], ["views"])

"""Silver tables: merges, price changes, snapshots, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.oracle import AS_OF
from motorlake.checks.registry import query
from motorlake.functions.values import price_changed
from motorlake.operators.joins import not_in
from motorlake.operators.latest import first_and_last_seen, last_per_key, require_unique
from motorlake.operators.merge import delete_keys, insert_if_absent
from motorlake.plans import silver as S
from motorlake.schemas import LISTING_CURRENT, empty
from motorlake.session import staged
from motorlake.sources.views_payload import view_counts

_CURRENT = [
    "listing_id", "url", "title", "price_kzt", "city", "region", "make", "model", "trim", "car_year", "mileage_km",
    "body_type", "engine_volume_l", "engine_type", "transmission", "steering", "customs_cleared", "seller_name",
    "seller_type", "first_seen_at", "last_seen_at", "is_active",
]
_MONEY = ("price_kzt", "engine_volume_l")
_CURRENT_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _MONEY else c for c in _CURRENT)


def _good(t):
    return B.records(t).where(S.is_ok())


def _current(t, where=None):
    rows = B.records(t) if where is None else B.records(t).where(where)
    return S.merge_current(empty(t.spark, LISTING_CURRENT), rows)


def _two_step_current(t):
    return S.merge_current(_current(t, B.before_split()), B.records(t).where(~B.before_split()))


@query("W3 R3", f"SELECT {_CURRENT_SQL} FROM cur", "cur")
def latest_state_per_listing(t):
    return _current(t).select(*_CURRENT)


@query("M1", f"SELECT {_CURRENT_SQL}, 'KZT' AS currency, CAST(NULL AS BIGINT) AS seller_user_id FROM cur", "cur")
def current_state_upsert(t):
    return _two_step_current(t).select(*_CURRENT, "currency", "seller_user_id")


@query("M4", """
  SELECT c.listing_id, c.is_active AND NOT EXISTS (
           SELECT 1 FROM records x WHERE x.listing_id = c.listing_id AND x.http_status = 404 AND x.fetched_at > c.last_seen_at) AS is_active
  FROM cur_a c""", "cur_a records")
def listings_marked_inactive(t):
    """Later misses deactivate stored listings; nothing else changes."""
    state = B.silver_at_split(t).current
    gone = B.records(t).where(S.is_gone()).groupBy("listing_id").agg(F.max("fetched_at").alias("gone_at"))
    return S.mark_inactive(state, gone).select("listing_id", "is_active")


@query("M4", """
  SELECT s.listing_id, s.snapshot_date::VARCHAR AS snapshot_date, s.is_active AND NOT EXISTS (
           SELECT 1 FROM events e WHERE e.user_id = s.listing_id AND e.event_type = 'error' AND CAST(e.ts AS DATE) = s.snapshot_date) AS is_active
  FROM snap s""", "snap")
def snapshots_marked_inactive(t):
    gone = B.records(t).where(S.is_gone()).select("listing_id", F.col("fetched_at").alias("gone_at"))
    return S.mark_snapshots_inactive(B.silver(t).snapshots, gone).select("listing_id", "snapshot_date", "is_active")


@query("W4", "SELECT listing_id, snapshot_date::VARCHAR AS snapshot_date, CAST(price_kzt AS DOUBLE) AS price_kzt, photo_count FROM snap", "snap")
def last_observation_per_day(t):
    rows = _good(t).withColumn("snapshot_date", F.to_date("fetched_at"))
    kept = rows.select("listing_id", "snapshot_date", "fetched_at", "price_kzt", "photo_count")
    return last_per_key(kept, ["listing_id", "snapshot_date"], ["fetched_at"]).drop("fetched_at")


@query("M3 M4", """
  SELECT s.listing_id, s.snapshot_date::VARCHAR AS snapshot_date, CAST(s.price_kzt AS DOUBLE) AS price_kzt, s.is_active,
         CASE WHEN a.listing_id IS NOT NULL THEN 7::BIGINT END AS views, s.photo_count
  FROM snap s LEFT JOIN snap_a a USING (listing_id, snapshot_date)""", "snap snap_a")
def daily_snapshot_upsert(t):
    """Views stored before the second batch survive it."""
    enriched = B.silver_at_split(t).snapshots.withColumn("views", F.lit(7))
    return S.merge_snapshots(enriched, B.records(t))


@query("W2", """
  SELECT listing_id, event_ts, CAST(old_price_kzt AS DOUBLE) AS old_price_kzt, CAST(new_price_kzt AS DOUBLE) AS new_price_kzt
  FROM pevents""", "pevents")
def price_changes(t):
    return S.price_changes(_good(t).select("listing_id", "fetched_at", "price_kzt"))


@query("W2", """
  SELECT listing_id, event_ts, CAST(old_price_kzt AS DOUBLE) AS old_price_kzt, CAST(new_price_kzt AS DOUBLE) AS new_price_kzt
  FROM pevents""", "pevents")
def price_changes_hot_listings(t):
    """The same with every listing treated as hot, its timeline cut in segments."""
    return S.price_changes(_good(t).select("listing_id", "fetched_at", "price_kzt"), hot_key_rows=10)


@query("M2", """
  SELECT listing_id, event_ts, CAST(old_price_kzt AS DOUBLE) AS old_price_kzt, CAST(new_price_kzt AS DOUBLE) AS new_price_kzt
  FROM pevents""", "pevents")
def price_event_append(t):
    return B.silver_two_steps(t).price_events


@query("J6 P13", f"""
  SELECT o.listing_id, o.fetched_at, CAST(c.price_kzt AS DOUBLE) AS old_price_kzt, coalesce(c.first_seen_at, o.fetched_at) AS first_seen_at
  FROM records o LEFT JOIN cur_a c USING (listing_id)
  WHERE o.http_status < 400 AND o.fetched_at >= TIMESTAMP '2024-01-15 00:00:00'""", "records cur_a")
def stored_state_lookup(t):
    state = _current(t, B.before_split()).select("listing_id", F.col("price_kzt").alias("old_price_kzt"), "first_seen_at")
    batch = _good(t).where(~B.before_split()).select("listing_id", "fetched_at")
    found = batch.join(state, "listing_id", "left")
    return found.withColumn("first_seen_at", F.coalesce("first_seen_at", "fetched_at"))


@query("D8", """
  SELECT event_id, coalesce(CAST(value AS DECIMAL(14,2)) <> CAST(CASE WHEN event_id % 2 = 0 THEN value * 2 ELSE value END AS DECIMAL(14,2)), FALSE) AS changed,
         event_id % 3 = 2 AND value IS NOT NULL AS changed_by_rounding FROM events""")
def price_comparison(t):
    """Prices that double every other time; cents that rounding changes every third time."""
    v, cents = F.col("value"), F.floor(F.col("value") * 100)
    moved = (cents * 10 + 1 + F.col("event_id") % 3 * 3) / 1000  # .1, .4 or .7 of a cent more
    return t.events.select(
        "event_id", price_changed(v, F.when(F.col("event_id") % 2 == 0, v * 2).otherwise(v)).alias("changed"),
        price_changed(cents / 100, moved).alias("changed_by_rounding"))


@query("A10", "SELECT listing_id, min(fetched_at) AS first_seen_at, max(fetched_at) AS last_seen_at FROM records WHERE http_status < 400 GROUP BY 1", "records")
def first_and_last_seen_per_listing(t):
    return first_and_last_seen(_good(t), "listing_id", "fetched_at")


@query("W7", "SELECT event_id, user_id AS listing_id, ts AS fetched_at FROM events")
def merge_source_with_unique_keys(t):
    rows = B.observations(t).select("listing_id", "fetched_at", "event_id")
    return require_unique(rows, ["listing_id", "fetched_at"])


@query("J7", "SELECT listing_id, make FROM attrs a WHERE NOT EXISTS (SELECT 1 FROM cur_a c WHERE c.listing_id = a.listing_id AND c.make IS NOT DISTINCT FROM a.make)", "attrs cur_a")
def rows_without_conflict(t):
    """Anti-join on a key with nulls, nulls equal."""
    return not_in(B.attributes(t).select("listing_id", "make"), _current(t, B.before_split()), ["listing_id", "make"])


@query("M16", f"SELECT listing_id, count(*) AS n FROM snap WHERE listing_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100) GROUP BY 1", "snap")
def delete_by_key(t):
    gone = t.events.where("event_type = 'purchase' and value > 100").select(F.col("user_id").alias("listing_id")).distinct()
    left = delete_keys(B.silver(t).snapshots, gone)
    return left.groupBy("listing_id").agg(F.count(F.lit(1)).alias("n"))


@query("P5", f"SELECT listing_id, snapshot_date::VARCHAR AS snapshot_date FROM snap WHERE snapshot_date = {AS_OF}", "snap")
def snapshots_missing_views(t):
    return S.missing_views(B.silver(t).snapshots, B.AS_OF).select("listing_id", "snapshot_date")


_LAST_COUNT = """
  SELECT listing_id, views FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY event_id DESC) AS rn FROM vcounts) q WHERE rn = 1"""


def _last_counts(t):
    counts = view_counts(B.view_payloads(t), carry=["event_id"])
    return last_per_key(counts, ["listing_id"], ["event_id"]).select("listing_id", "views")


@query("J8 M15", f"""
  SELECT s.listing_id, s.snapshot_date::VARCHAR AS snapshot_date, v.views
  FROM snap s LEFT JOIN ({_LAST_COUNT}) v ON v.listing_id = s.listing_id AND s.snapshot_date = {AS_OF}""", "snap vcounts")
def views_enrichment(t):
    return S.set_views(B.silver(t).snapshots, _last_counts(t), B.AS_OF).select("listing_id", "snapshot_date", "views")


@query("J1", """
  SELECT s.listing_id, s.snapshot_date::VARCHAR AS snapshot_date, c.make, c.city, c.last_seen_at
  FROM snap s JOIN cur c USING (listing_id)""", "snap cur")
def snapshots_with_current_state(t):
    sv = B.silver(t)
    return sv.snapshots.join(sv.current, "listing_id").select("listing_id", "snapshot_date", "make", "city", "last_seen_at")


@query("M2 M4", """
  SELECT listing_id, event_ts, CAST(old_price_kzt AS DOUBLE) AS old_price_kzt, CAST(new_price_kzt AS DOUBLE) AS new_price_kzt FROM pevents""", "pevents")
def price_events_replayed(t):
    """Applying the second batch twice adds nothing."""
    batch = B.records(t).where(~B.before_split())
    once = S.apply_batch(B.silver_at_split(t), batch)
    events = S.batch_price_events(staged(once.current, "current"), batch)
    return insert_if_absent(staged(once.price_events, "events"), events, ["listing_id", "event_ts"])

"""Streaming runs: three arriving slices, one run after each, compared with the batch result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.registry import query
from motorlake.plans.silver import PAYLOAD
from motorlake.schemas import FACT_LISTING_DAILY, FACT_PRICE_EVENT, PRICE_EVENT
from motorlake.session import scratch_path
from motorlake.streaming import incremental as R
from motorlake.streaming.store import LakeStore

_CUTS = [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)]
_LATE = dt.datetime(2024, 2, 1)


def _replay(t, rows, ts, run):
    """Write each time slice to the source folder, then run on what arrived."""
    source, checkpoint = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "progress")
    store = LakeStore(t.spark, scratch_path(t.spark, "store"), buckets=16)  # for the few listings of these tables
    bounds = [None, *_CUTS, None]
    result = None
    for start, end in zip(bounds, bounds[1:]):
        slice_ = rows
        if start is not None:
            slice_ = slice_.where(F.col(ts) >= F.lit(start).cast("timestamp"))
        if end is not None:
            slice_ = slice_.where(F.col(ts) < F.lit(end).cast("timestamp"))
        slice_.write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(rows.schema).parquet(source)
        result = run(stream, store, checkpoint)
    return store, result


def _out_of_order(t, rows):
    """Each observation arrives with one of the three slices, whatever its time: rows come weeks late."""
    slices = F.array(*[F.lit(x).cast("timestamp") for x in (dt.datetime(2024, 1, 1), *_CUTS)])
    return rows.withColumn("arrives", F.get(slices, F.pmod(F.xxhash64("listing_id", "fetched_at"), F.lit(3)).cast("int")))


def _mixed(t, rows, run):
    return _replay(t, _out_of_order(t, rows), "arrives", lambda s, store, c: run(s.drop("arrives"), store, c))[0]


def _incremental(t):
    days = B.calendar(t)
    return _mixed(t, B.records(t), lambda s, store, c: R.run_incremental(s, store, c, days))


_FACT = "date_key, listing_id, CAST(price_kzt AS DOUBLE) AS price_kzt, is_active, days_on_site, photo_count"


@query("R1", f"SELECT {_FACT} FROM facts", "facts")
def streamed_facts(t):
    facts = _incremental(t).read("fact_listing_daily", FACT_LISTING_DAILY)
    return facts.select("date_key", "listing_id", "price_kzt", "is_active", "days_on_site", "photo_count")


@query("R1 M3", "SELECT listing_id, snapshot_date::VARCHAR AS snapshot_date, CAST(price_kzt AS DOUBLE) AS price_kzt, is_active, photo_count FROM snap", "snap")
def streamed_snapshots(t):
    return R.snapshots(_incremental(t)).drop("views")


@query("R1 M2 M14", "SELECT event_ts, date_key, listing_id, CAST(old_price_kzt AS DOUBLE) AS old_price_kzt, CAST(new_price_kzt AS DOUBLE) AS new_price_kzt FROM pfacts", "pfacts")
def streamed_price_facts(t):
    return _incremental(t).read("fact_price_event", FACT_PRICE_EVENT)


@query("R2 M2", "SELECT listing_id, event_ts, CAST(old_price_kzt AS DOUBLE) AS old_price_kzt, CAST(new_price_kzt AS DOUBLE) AS new_price_kzt FROM pevents", "pevents")
def streamed_price_events(t):
    rows = B.records(t).select("listing_id", "fetched_at", "http_status", "price_kzt")
    return _mixed(t, rows, R.run_price_detector).read("price_events", PRICE_EVENT)


_STATE = ["listing_id", "price_kzt", "city", "first_seen_at", "last_seen_at", "is_active"]


@query("R3 M1", "SELECT listing_id, CAST(price_kzt AS DOUBLE) AS price_kzt, city, first_seen_at, last_seen_at, is_active FROM cur", "cur")
def streamed_current_state(t):
    rows = B.records(t).select("listing_id", "fetched_at", "http_status", *PAYLOAD, "payload_hash")
    return R.current(_mixed(t, rows, R.run_current_state)).select(*_STATE)


@query("R4", "SELECT listing_id, fetched_at, http_status FROM obs", "obs")
def streamed_exactly_once(t):
    """Every observation is delivered twice in its slice, and every third once more with the last slice."""
    rows = B.observations(t).select("listing_id", "fetched_at", "http_status")
    again = rows.where(F.xxhash64("listing_id", "fetched_at") % 3 == 0)
    arrives = rows.unionByName(rows).withColumn("arrives", F.col("fetched_at")).unionByName(
        again.withColumn("arrives", F.lit(_LATE).cast("timestamp")))
    return _replay(t, arrives, "arrives", lambda s, store, c: R.run_ingest(s.drop("arrives"), store, c))[1]


@query("R5 A7", """
  SELECT date_trunc('hour', "at") AS hour, count(*) FILTER (outcome = 'discovered') AS discovered, count(http_status) AS fetched,
         count(*) FILTER (outcome = 'parsed') AS parsed, count(*) FILTER (outcome = 'failed') AS failed,
         count(*) FILTER (outcome = 'blocked') AS blocked, count(*) FILTER (outcome = 'duplicate') AS duplicates
  FROM outs GROUP BY 1""", "outs")
def streamed_hourly_counters(t):
    """A fifth of the outcomes arrives with the last slice, up to weeks late."""
    late = F.xxhash64("listing_id", "at") % 5 == 0
    rows = B.outcomes(t).withColumn("arrives", F.when(late, F.lit(_LATE).cast("timestamp")).otherwise(F.col("at")))
    return _replay(t, rows, "arrives", lambda s, store, c: R.run_hourly_counters(s.drop("arrives"), store, c))[1]

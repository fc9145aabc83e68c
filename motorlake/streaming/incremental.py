"""The hourly incremental run as Structured Streaming.

Each micro-batch merges into versioned tables (``LakeStore``) and is switched on
as a whole by one log entry:

* ``current`` – listings in buckets of their id's hash; only touched buckets are
  read and rewritten, and their untouched rows never leave their tasks;
* ``snapshots``, ``fact_listing_daily``, ``price_events``, ``fact_price_event`` –
  one part per day; only touched days are rewritten or added to;
* ``price_points`` – every known price, in the buckets of ``current``, for the
  neighbours of late ones;
* the dimensions – appended, a few parts at a time becoming one.

The previous state is read from these tables, never from executor memory, so
lost executors cost a re-read and no stream state has to fit a task. Batches may
come in any order of time: a late observation ends up where it belongs, and price
events, first-seen times and the facts of older days follow it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlake.functions.dates import date_key
from motorlake.operators.merge import new_keys_only
from motorlake.operators.stats import run_counters
from motorlake.plans import gold as G
from motorlake.plans import silver as S
from motorlake.schemas import (
    FACT_LISTING_DAILY, FACT_PRICE_EVENT, LAKE, LOCATION_COLUMNS, PRICE_EVENT, SELLER_COLUMNS, SNAPSHOT_DAILY, VEHICLE_COLUMNS,
)
from motorlake.session import staged
from motorlake.streaming.store import Commit, LakeStore

#: Listings of a batch whose ids are broadcast to the state's tasks (8 bytes each); a larger batch is joined by a shuffle.
BROADCAST_IDS = 2_000_000

#: Snapshots with the times that decide between observations of a day.
_SNAPSHOT_STATE = T.StructType(
    [*SNAPSHOT_DAILY.fields, T.StructField("seen_at", T.TimestampType()), T.StructField("gone_at", T.TimestampType())])


def listing_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("listing_id"), F.lit(buckets)).cast("int")


def _distinct(rows: DataFrame, column: Column) -> list:
    """Distinct days or buckets of a batch: a few hundred at most."""
    return [r[0] for r in rows.select(column.alias("v")).distinct().collect()]


def _ids(rows: DataFrame) -> DataFrame:
    ids = rows.select("listing_id").distinct()
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def merge_buckets(commit: Commit, table: str, schema: T.StructType, batch: DataFrame,
                  merge: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Merge a batch, one row per listing, into a table in listing buckets.

    Stored rows of other listings pass from the old files of a touched bucket to
    its new ones inside a task; only the batch's own listings are shuffled.
    Returns the stored and the new rows of the batch's listings.
    """
    bucket = listing_bucket(commit.buckets)
    buckets = _distinct(batch, bucket)
    state, ids = commit.read(table, schema, buckets), _ids(batch)
    met = staged(state.join(ids, "listing_id", "left_semi"), f"{table}-met")
    new = staged(merge(met, batch), f"{table}-new")
    rest = state.join(ids, "listing_id", "left_anti")
    spread = new.withColumn("_bucket", bucket).repartition("_bucket").drop("_bucket")
    commit.replace(table, rest.unionByName(spread), bucket, buckets)
    return met, new


def merge_price_points(commit: Commit, arrived: DataFrame, last: DataFrame) -> tuple[DataFrame, list, list]:
    """Price events after new price points of good fetches.

    ``last`` holds the last stored point of the listings that arrived. A listing
    whose points are all newer needs no other; for late points the listing's
    stored timeline is read from its bucket. Returns the events that hold now, the
    days whose events were made anew, and the days that were only added to.
    """
    seen = last.select("listing_id", F.col("fetched_at").alias("_seen"))
    late = arrived.join(seen, "listing_id").where(F.col("fetched_at") <= F.col("_seen")).select("listing_id").distinct()
    late = staged(late, "late")
    stored = last.select(*S.PRICE_POINT.names)
    bucket = listing_bucket(commit.buckets)
    buckets = _distinct(late, bucket)
    if buckets:
        ids = _ids(late)
        timeline = commit.read("price_points", S.PRICE_POINT, buckets).join(ids, "listing_id", "left_semi")
        stored = stored.join(ids, "listing_id", "left_anti").unionByName(timeline)
    stored = staged(stored, "stored-points")
    fresh = staged(S.fresh_points(stored, arrived), "fresh-points")
    gone, events = S.revised_price_events(staged(S.touched_points(stored, fresh), "touched-points"))
    commit.append("price_points", fresh, bucket)

    day = F.to_date("event_ts")
    anew = _distinct(gone, day) if buckets else []
    if anew:
        held = commit.read("price_events", PRICE_EVENT, anew).join(gone, ["listing_id", "event_ts"], "left_anti")
        commit.replace("price_events", held.unionByName(events.where(day.isin(anew))), day, anew)
    added = events.where(~day.isin(anew)) if anew else events
    commit.append("price_events", added, day)
    return added, anew, _distinct(added, day)


def stored_snapshots(rows: DataFrame) -> DataFrame:
    """The daily snapshots: days on which a listing was fetched."""
    return rows.where(F.col("seen_at").isNotNull()).select(*SNAPSHOT_DAILY.names)


def snapshots(store: LakeStore | Commit, days: list | None = None) -> DataFrame:
    rows = store.read("snapshots", _SNAPSHOT_STATE) if days is None else store.read("snapshots", _SNAPSHOT_STATE, days)
    return stored_snapshots(rows)


def current(store: LakeStore | Commit) -> DataFrame:
    return S.known_listings(store.read("current", S.CURRENT_STATE))


def _moved(met: DataFrame, new: DataFrame) -> DataFrame:
    """Listings whose older facts a batch changes: seen earlier than known, or with keys for the first time."""
    keyed = F.col("city").isNotNull() & F.col("make").isNotNull() & F.col("model").isNotNull()
    before = S.known_listings(met).select("listing_id", F.col("first_seen_at").alias("_first"), keyed.alias("_keyed"))
    after = S.known_listings(new).select("listing_id", "first_seen_at", keyed.alias("now_keyed"))
    both = after.join(before, "listing_id")
    return both.where((F.col("first_seen_at") < F.col("_first")) | (F.col("now_keyed") & ~F.col("_keyed"))).select("listing_id")


def keep_valid(commit: Commit, observations: DataFrame) -> DataFrame:
    """The usable rows of a micro-batch; the others go to ``rejected``.

    A micro-batch is read whole whatever is asked of it, so it is read once; of
    the copy a question reads its own columns.
    """
    valid, rejected = S.split_valid(staged(observations, "arrived"))
    if not rejected.isEmpty():
        commit.append("rejected", rejected)
    return valid


def merge_silver(commit: Commit, observations: DataFrame) -> list:
    """Current state, snapshots and price events of one micro-batch; returns the snapshot days whose facts change."""
    valid = keep_valid(commit, observations)
    summary = staged(S.listing_summary(valid), "listings")
    met, new = merge_buckets(commit, "current", S.CURRENT_STATE, summary, S.upsert_current_state)
    last = S.known_listings(met).select("listing_id", F.col("last_seen_at").alias("fetched_at"), "price_kzt")
    added, anew, _ = merge_price_points(commit, S.price_points(valid), last)
    if anew:
        events = commit.read("price_events", PRICE_EVENT, anew)
        commit.replace("fact_price_event", G.price_event_facts(events), F.to_date("event_ts"), anew)
    commit.append("fact_price_event", G.price_event_facts(added), F.to_date("event_ts"))

    days = staged(S.day_summary(valid), "days")
    touched = _distinct(days, F.col("snapshot_date"))
    merged = S.upsert_snapshot_state(commit.read("snapshots", _SNAPSHOT_STATE, touched), days)
    commit.replace("snapshots", merged, F.col("snapshot_date"), touched)

    moved = staged(_moved(met, new), "moved")
    if not moved.isEmpty():
        older = snapshots(commit).join(_ids(moved), "listing_id", "left_semi")
        touched = sorted({*touched, *_distinct(older, F.col("snapshot_date"))})
    return touched


def merge_gold(commit: Commit, calendar: DataFrame, days: list | None = None) -> None:
    """Dimensions and facts after a silver batch.

    ``days`` limits the fact merge to the given snapshot days; without it all
    days are merged, as a full refresh does.
    """
    schemas = LAKE["gold"]
    listings = current(commit)
    sources = {
        "dim_location": (G.location_rows(listings), LOCATION_COLUMNS, "location_key"),
        "dim_vehicle": (G.vehicle_rows(listings), VEHICLE_COLUMNS, "vehicle_key"),
        "dim_seller": (G.seller_rows(listings), SELLER_COLUMNS, "seller_key"),
    }
    for name, (rows, keys, key) in sources.items():
        new = G.new_dimension_rows(commit.read(name, schemas[name]), rows, keys, key)
        commit.append(name, new.select(*schemas[name].names))
    held = snapshots(commit, days)
    grown = G.grow_calendar(calendar, G.snapshot_days(held))
    commit.append("dim_date", new_keys_only(commit.read("dim_date", schemas["dim_date"]), grown, ["d"]))

    dims = {name: commit.read(name, schemas[name]) for name in [*sources, "dim_date"]}
    keys = G.listing_keys(listings, dims["dim_location"], dims["dim_vehicle"], dims["dim_seller"])
    day_keys = None if days is None else [d.year * 10000 + d.month * 100 + d.day for d in days]
    stored = commit.read("fact_listing_daily", FACT_LISTING_DAILY, day_keys)
    facts = G.resolve_star(held, keys, dims["dim_date"])
    commit.replace("fact_listing_daily", G.upsert_facts(stored, facts), F.col("date_key"), day_keys or [])


def observation_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _run(stream: DataFrame, store: LakeStore, checkpoint: str, handle: Callable[[Commit, DataFrame], None]) -> None:
    """Process all available input, then stop. A batch that the log has already is skipped."""
    def commit_batch(rows: DataFrame, batch: int) -> None:
        commit = store.begin(checkpoint, batch)
        if commit is not None:
            handle(commit, rows)
            commit.close()

    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(commit_batch).trigger(availableNow=True).start()
    query.awaitTermination()


def run_incremental(stream: DataFrame, store: LakeStore, checkpoint: str, calendar: DataFrame) -> None:
    """Bronze observations to silver and gold, batch by batch."""
    _run(stream, store, checkpoint, lambda commit, rows: merge_gold(commit, calendar, merge_silver(commit, rows)))


def run_current_state(stream: DataFrame, store: LakeStore, checkpoint: str) -> None:
    """Only the current-state table."""
    def handle(commit: Commit, rows: DataFrame) -> None:
        summary = staged(S.listing_summary(S.split_valid(rows)[0]), "listings")
        merge_buckets(commit, "current", S.CURRENT_STATE, summary, S.upsert_current_state)

    _run(stream, store, checkpoint, handle)


def run_price_detector(stream: DataFrame, store: LakeStore, checkpoint: str) -> None:
    """Price events with the last known price point per listing as the state."""
    def handle(commit: Commit, rows: DataFrame) -> None:
        arrived = staged(S.price_points(S.split_valid(rows)[0]), "arrived")
        newest = arrived.groupBy("listing_id").agg(F.max(F.struct("fetched_at", "price_kzt")).alias("p"))
        newest = staged(newest.select("listing_id", "p.fetched_at", "p.price_kzt"), "newest")

        def later(state: DataFrame, batch: DataFrame) -> DataFrame:
            both = state.unionByName(batch).groupBy("listing_id").agg(F.max(F.struct("fetched_at", "price_kzt")).alias("p"))
            return both.select("listing_id", "p.fetched_at", "p.price_kzt")

        met, _ = merge_buckets(commit, "last_price", S.PRICE_POINT, newest, later)
        merge_price_points(commit, arrived, met)

    _run(stream, store, checkpoint, handle)


_OBSERVATION = ["listing_id", "fetched_at"]


def run_ingest(stream: DataFrame, store: LakeStore, checkpoint: str) -> DataFrame:
    """Bronze with every (listing_id, fetched_at) once, however late a row or its repeat arrives.

    A batch is compared with the stored rows of the days it touches; no state is kept in memory.
    """
    day = F.to_date("fetched_at")

    def handle(commit: Commit, rows: DataFrame) -> None:
        new = staged(rows.dropDuplicates(_OBSERVATION), "arrived")
        held = commit.read("bronze", stream.schema, _distinct(new, day))
        commit.append("bronze", new_keys_only(held.select(*_OBSERVATION), new, _OBSERVATION), day)

    _run(stream, store, checkpoint, handle)
    return store.read("bronze", stream.schema)


def run_hourly_counters(stream: DataFrame, store: LakeStore, checkpoint: str) -> DataFrame:
    """Run counters per hour of event time, kept up to date as batches arrive.

    Counts add up: each batch appends its own counts, late outcomes included, and
    reading sums them. Of a day with many parts the sums become one part, in the
    same commit, so nothing is lost or counted twice whatever fails.
    """
    def counters(rows: DataFrame) -> DataFrame:
        return run_counters(rows.withColumn("hour", F.date_trunc("hour", "at")), "hour")

    def summed(parts: DataFrame) -> DataFrame:
        return parts.groupBy("hour").agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in parts.columns if c != "hour"])

    schema = counters(stream.sparkSession.createDataFrame([], stream.schema)).schema
    _run(stream, store, checkpoint, lambda commit, rows: commit.append("hourly_counters", counters(rows), F.to_date("hour"), summed))
    return summed(store.read("hourly_counters", schema))

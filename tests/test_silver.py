import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows, ts
from motorlake.operators import lag
from motorlake.operators.lag import previous_value, segments
from motorlake.plans import silver as S
from motorlake.plans.silver import PAYLOAD
from motorlake.schemas import LISTING_CURRENT
from motorlake.session import staged

OBS = "listing_id long, fetched_at timestamp, http_status int, price_kzt long, photo_count int, city string"


def observations(spark, *data):
    """(id, time, status, price, photos, city) with every other field null."""
    df = spark.createDataFrame([(i, ts(t), s, p, n, c) for i, t, s, p, n, c in data], OBS)
    kinds = {f.name: f.dataType for f in LISTING_CURRENT.fields}
    rest = [F.lit(None).cast(kinds[c]).alias(c) for c in [*PAYLOAD, "payload_hash"] if c not in df.columns]
    return df.select("*", *rest)


HISTORY = [
    (1, "2024-01-01 08:00", 200, 100, 1, "A"), (1, "2024-01-01 09:00", 200, 120, 2, "A"),
    (1, "2024-01-02 08:00", 200, None, 3, None), (1, "2024-01-03 08:00", 200, 130, 3, "B"),
    (2, "2024-01-01 08:00", 200, 50, 0, "A"), (2, "2024-01-02 08:00", 404, None, None, None),
    (2, "2024-01-01 20:00", 404, None, None, None),
    (3, "2024-01-01 08:00", 404, None, None, None),
    (4, "2024-01-01 08:00", 200, None, 0, "C"), (4, "2024-01-02 08:00", 200, 70, 0, "C"), (4, "2024-01-03 08:00", 200, 70, 0, "C"),
    (4, "2024-01-03 09:00", 200, 80, 0, "C"), (5, "2024-01-01 08:00", 503, None, None, None),
]


def tables(silver):
    return (
        rows(silver.current.select("listing_id", "price_kzt", "city", "is_active", "first_seen_at", "last_seen_at", "currency")),
        rows(silver.snapshots), rows(silver.price_events),
    )


def test_history(spark):
    sv = S.from_history(spark, observations(spark, *HISTORY))
    current = {r.listing_id: r for r in sv.current.collect()}
    assert set(current) == {1, 2, 4}
    assert (current[1].price_kzt, current[1].city, current[1].is_active) == (130, "B", True)
    assert current[2].is_active is False and current[2].price_kzt == 50
    snaps = {(r.listing_id, str(r.snapshot_date)): r for r in sv.snapshots.collect()}
    assert set(snaps) == {(1, "2024-01-01"), (1, "2024-01-02"), (1, "2024-01-03"), (2, "2024-01-01"),
                          (4, "2024-01-01"), (4, "2024-01-02"), (4, "2024-01-03")}
    assert snaps[1, "2024-01-01"].price_kzt == 120 and snaps[2, "2024-01-01"].is_active is False
    events = [(r.listing_id, float(r.old_price_kzt), float(r.new_price_kzt)) for r in sv.price_events.collect()]
    assert sorted(events) == [(1, 100.0, 120.0), (4, 70.0, 80.0)]  # unknown in between resets


@pytest.mark.parametrize("cut", ["2024-01-01 08:30", "2024-01-02 00:00", "2024-01-03 08:30"])
def test_batches_equal_history(spark, cut):
    whole = observations(spark, *HISTORY)
    at = F.lit(ts(cut))
    first = S.from_history(spark, whole.where(F.col("fetched_at") < at))
    both = S.apply_batch(first, whole.where(F.col("fetched_at") >= at))
    assert tables(both) == tables(S.from_history(spark, whole))


def test_replayed_batch_changes_nothing(spark):
    batch = observations(spark, *HISTORY)
    once = S.from_history(spark, batch)
    again = S.apply_batch(S.Silver(*[staged(d, "t") for d in (once.current, once.snapshots, once.price_events)]), batch)
    assert tables(again) == tables(once)


def test_empty_batch(spark):
    once = S.from_history(spark, observations(spark, *HISTORY))
    none = observations(spark, *HISTORY).where("false")
    assert tables(S.apply_batch(once, none)) == tables(once)


def test_views_survive_and_invalid_rows_leave(spark):
    sv = S.from_history(spark, observations(spark, *HISTORY))
    counts = spark.createDataFrame([(1, 9), (99, 1)], "listing_id long, views int")
    import datetime as dt
    enriched = S.set_views(sv.snapshots, counts, dt.date(2024, 1, 3))
    assert enriched.count() == sv.snapshots.count()
    merged = S.merge_snapshots(enriched, observations(spark, (1, "2024-01-03 10:00", 200, 140, 5, "B")))
    (r,) = merged.where("listing_id = 1 and snapshot_date = date'2024-01-03'").collect()
    assert (r.views, r.price_kzt, r.photo_count) == (9, 140, 5)
    bad = observations(spark, *HISTORY).withColumn("listing_id", F.when(F.col("listing_id") != 1, F.col("listing_id")))
    good, rejected = S.split_valid(bad)
    assert (good.count(), rejected.count()) == (9, 4)


@pytest.mark.parametrize("hot", [1, 3, 50, 10_000])
def test_segmented_lag_equals_plain_lag(spark, hot):
    rnd = random.Random(hot)
    data = [(rnd.choice([1, 1, 1, 2, 3]), 1_700_000_000 + rnd.randrange(400) ** 2, rnd.choice([None, 1, 2, 3])) for _ in range(600)]
    df = spark.createDataFrame(sorted(set((k, s) for k, s, _ in data)), "k long, s long").join(
        spark.createDataFrame(data, "k long, s long, v long").dropDuplicates(["k", "s"]), ["k", "s"]
    ).withColumn("at", F.timestamp_seconds("s")).select("k", "at", "v")
    got = previous_value(df, "k", "at", "v", "before", hot_key_rows=hot)
    want = df.withColumn("before", F.lag("v").over(Window.partitionBy("k").orderBy("at")))
    assert rows(got) == rows(want)


def test_tiny_segments_do_not_become_a_task_each(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(lag, "segments", lambda rows, order, count: cuts.append(count) or segments(rows, order, count))
    df = spark.range(5_000).selectExpr("id % 3 AS k", "timestamp_seconds(id) AS at", "id AS v")
    got = previous_value(df, "k", "at", "v", "before", hot_key_rows=1)
    want = df.withColumn("before", F.lag("v").over(Window.partitionBy("k").orderBy("at")))
    assert rows(got) == rows(want)
    assert cuts == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    assert lag.segment_count(df, 36_000_000, 10) == 72 and lag.segment_count(df, 36_000_000, lag.HOT_KEY_ROWS) == 8

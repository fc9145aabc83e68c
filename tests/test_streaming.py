import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL, rows, ts
from motorlake.checks import bindings as B
from motorlake.operators.lag import previous_value, segments
from motorlake.plans import silver as S
from motorlake.schemas import FACT_LISTING_DAILY, FACT_PRICE_EVENT, LAKE, PRICE_EVENT
from motorlake.session import scratch_path, staged
from motorlake.streaming import incremental as R
from motorlake.streaming.store import ERA, MOST_FOLDERS, LakeStore
from pyspark.sql.types import LongType, StructField, StructType


@pytest.fixture()
def store(spark):
    return LakeStore(spark, scratch_path(spark, "store"))


NUMBERS = StructType([StructField("id", LongType())])


def put(store, stream, batch, *ids):
    commit = store.begin(stream, batch)
    if commit is not None:
        commit.append("numbers", store.spark.createDataFrame([(i,) for i in ids], NUMBERS), (F.col("id") % 2))
        commit.close()


def test_commit_switches_all_tables_or_none(spark, store):
    put(store, "a", 0, 1, 2)
    commit = store.begin("a", 1)
    commit.replace("numbers", spark.range(10, 12), F.col("id") % 2, [0, 1])
    commit.append("others", spark.range(3))
    assert rows(commit.read("numbers", NUMBERS)) == [(10,), (11,)]
    # It fails here: nothing of the batch is visible, and the repeat starts from the state before it.
    assert rows(store.read("numbers", NUMBERS)) == [(1,), (2,)] and rows(store.read("others", NUMBERS)) == []
    again = store.begin("a", 1)
    assert rows(again.read("numbers", NUMBERS)) == [(1,), (2,)]
    again.replace("numbers", spark.range(10, 11), F.col("id") % 2, [0, 1])
    again.close()
    assert rows(store.read("numbers", NUMBERS)) == [(10,)]  # part 1 is empty now
    assert store.begin("a", 1) is None and store.begin("a", 0) is None
    put(store, "b", 0, 5)  # another checkpoint begins anew, on the newest state
    assert rows(LakeStore(spark, store.root).read("numbers", NUMBERS)) == [(10,), (5,)]


def test_log_and_folders_stay_bounded(spark, store):
    for n in range(3):
        store.begin("a", n).close()
    for n in range(ERA - 2, ERA + 3):  # over the border of an era
        commit = store.begin("a", n)
        commit.seq = n
        commit.append("numbers", spark.range(n, n + 1).select("id"))
        commit.close()
    assert rows(store.read("numbers", NUMBERS)) == [(n,) for n in range(ERA - 2, ERA + 3)]
    assert store._committed()[0] == ERA + 2


def test_counters_of_many_batches_keep_few_parts(spark, store):
    at = dt.datetime(2024, 1, 1, 5, 30, tzinfo=dt.timezone.utc)
    outcome = spark.createDataFrame([(at, "parsed", 200)] * 3, "at timestamp, outcome string, http_status int")
    from motorlake.operators.stats import run_counters
    counted = run_counters(outcome.withColumn("hour", F.date_trunc("hour", "at")), "hour").cache()
    summed = lambda parts: parts.groupBy("hour").agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in parts.columns if c != "hour"])
    for n in range(50):
        if n % 7 == 3:
            store.begin("a", n).append("counters", counted, F.to_date("hour"), summed)  # fails before its entry
        commit = store.begin("a", n)
        commit.append("counters", counted, F.to_date("hour"), summed)
        commit.close()
        assert all(len(f) <= MOST_FOLDERS for f in store.folders("counters").values())
    (total,) = summed(store.read("counters", counted.schema)).collect()
    assert total.parsed == 150 and len(store.folders("counters")) == 1


def observed(spark, *data):
    from test_silver import observations
    return observations(spark, *data)


def test_batch_rewrites_its_own_buckets_only(spark, store, monkeypatch):
    def step(n, *data):
        commit = store.begin("s", n)
        R.merge_buckets(commit, "current", S.CURRENT_STATE, S.listing_summary(observed(spark, *data)), S.upsert_current_state)
        commit.close()

    step(0, *[(i, "2024-01-05 08:00", 200, 100 + i, 1, "A") for i in range(40)], (41, "2024-01-05 09:00", 404, None, None, None))
    before = store.folders("current")
    step(1, (3, "2024-01-04 08:00", 200, 7, 1, "B"), (41, "2024-01-05 08:00", 200, 9, 1, "C"))
    after = store.folders("current")
    touched = {r.b for r in spark.createDataFrame([(3,), (41,)], "listing_id long").select(R.listing_bucket(store.buckets).cast("string").alias("b")).collect()}
    assert {k for k in after if after[k] != before.get(k)} == touched
    got = {r.listing_id: r for r in R.current(store).collect()}
    assert len(got) == 41 and got[3].price_kzt == 103 and got[3].first_seen_at == dt.datetime(2024, 1, 4, 8) and got[3].is_active
    assert got[41].price_kzt == 9 and got[41].is_active is False  # the miss came first, but was later
    # The state's own rows take no shuffle: only the batch's listings do.
    state = spark.read.schema(S.CURRENT_STATE).parquet(*[f for fs in after.values() for f in fs])
    rest = state.join(R._ids(spark.range(3, 5).withColumnRenamed("id", "listing_id")), "listing_id", "left_anti")
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("seed", range(2))
def test_prices_in_any_order_make_the_same_events(spark, store, seed):
    rng = random.Random(seed)
    points = [(k, ts("2024-01-01 00:00") + dt.timedelta(hours=rng.randrange(2000)), rng.choice([None, 1, 2, 3])) for k in (1, 1, 1, 2, 3) for _ in range(14)]
    points = list({(k, t): (k, t, p) for k, t, p in points}.values())
    rng.shuffle(points)
    money = lambda data: spark.createDataFrame(data, "listing_id long, fetched_at timestamp, p long").select(
        "listing_id", "fetched_at", F.col("p").cast("decimal(14,2)").alias("price_kzt"))
    whole = money(points)
    size = -(-len(points) // 3)
    for n in range(4):
        part = points[n * size:(n + 1) * size] if n < 3 else points[size - 3:size + 5]  # at last, a repeat of what was there
        arrived = money(part)
        commit = store.begin("s", n)
        newest = arrived.groupBy("listing_id").agg(F.max(F.struct("fetched_at", "price_kzt")).alias("p")).select("listing_id", "p.*")
        later = lambda a, b: a.unionByName(b).groupBy("listing_id").agg(F.max(F.struct("fetched_at", "price_kzt")).alias("p")).select("listing_id", "p.*")
        met, _ = R.merge_buckets(commit, "last_price", S.PRICE_POINT, newest, later)
        R.merge_price_points(commit, arrived, met)
        commit.close()
    assert rows(store.read("price_events", PRICE_EVENT)) == rows(S.price_changes(whole))
    assert rows(store.read("price_points", S.PRICE_POINT)) == rows(whole)


def test_a_batch_is_read_once_and_its_unusable_rows_kept(spark, store):
    whole = B.records(B.Tables(spark, SMALL)).limit(60).withColumn("listing_id", F.when(F.col("fetched_at").cast("long") % 2 == 0, F.col("listing_id")))
    whole, read = staged(whole, "batch"), spark.sparkContext.accumulator(0)
    usable, broken = S.split_valid(whole)
    assert usable.count() and broken.count()

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    commit = store.begin("s", 0)
    R.merge_silver(commit, whole.mapInArrow(counted, whole.schema))
    commit.close()
    assert read.value == 60
    assert rows(store.read("rejected", whole.schema)) == rows(broken)
    assert rows(R.current(store)) == rows(S.from_history(spark, whole).current)
    commit = store.begin("s", 1)
    R.merge_silver(commit, usable)  # nothing to reject: nothing is written for it
    commit.close()
    assert rows(store.read("rejected", whole.schema)) == rows(broken) and len(store.folders("rejected")["all"]) == 1


def test_failed_and_repeated_stream_batch(spark, store, monkeypatch):
    t = B.Tables(spark, SMALL)
    whole, days = B.records(t).cache(), B.calendar(t)
    late = F.pmod(F.xxhash64("listing_id", "fetched_at"), F.lit(2)) == 0

    def step(rows_, n, fail=False):
        commit = store.begin("s", n)
        if commit is not None:
            R.merge_gold(commit, days, R.merge_silver(commit, rows_))
            if not fail:
                commit.close()

    def state():
        return (rows(store.read("fact_listing_daily", FACT_LISTING_DAILY)), rows(store.read("fact_price_event", FACT_PRICE_EVENT)),
                rows(store.read("dim_vehicle", LAKE["gold"]["dim_vehicle"])), rows(R.current(store)))

    step(whole.where(~late), 0)
    first = state()
    step(whole.where(late), 1, fail=True)
    assert state() == first
    step(whole.where(late), 1)
    once = state()
    assert once != first and all(once)
    step(whole.where(late), 1)
    assert state() == once
    want = S.from_history(spark, whole)
    assert rows(R.snapshots(store)) == rows(want.snapshots) and once[3] == rows(want.current)
    assert rows(store.read("price_events", PRICE_EVENT)) == rows(want.price_events)


def test_one_key_at_three_times_is_spread(spark):
    n = 300_000
    df = spark.range(n).selectExpr("7 AS k", "timestamp_seconds(id % 3) AS at", "CAST(id % 5 AS INT) AS v", "id")
    cut = segments(df.withColumn("_row", F.col("id")), ["k", "at", "v", "_row"], 30)
    sizes = [r["count"] for r in cut.groupBy("_segment").count().collect()]
    assert len(sizes) > 20 and max(sizes) < n / 10
    got = previous_value(df.select("k", "at", "v"), "k", "at", "v", "before", hot_key_rows=20_000)
    want = df.select("k", "at", "v", F.lag("v").over(Window.partitionBy("k").orderBy("at", "v")).alias("before"))
    count = lambda x: rows(x.groupBy("at", "v", "before").count())
    assert count(got) == count(want)

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from motorlake.checks import bindings as B
from motorlake.plans import gold as G
from motorlake.plans import verify as V
from motorlake.schemas import LAKE, SELLER_COLUMNS
from motorlake.session import scratch_path, staged
from motorlake.sinks import files as W
from motorlake.sinks.publish import get_sink, publish, register_sink
from motorlake.sources import pages as P
from motorlake.sources import tables as T


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    t = B.Tables(spark, SMALL)
    silver = B.silver(t)
    return t, silver, B.build(G.empty_gold(spark), silver, B.calendar(t))


def test_sound_tables_pass_every_schema_check(lake):
    _, silver, gold = lake
    tables = {n: staged(d, n) for n, d in gold.tables().items()} | {"listing_current": silver.current, "listing_snapshot_daily": staged(silver.snapshots, "s")}
    results = V.schema_suite(tables)
    assert results.count() == 40
    failed = {(r.table_name, r.check_name) for r in results.where("not passed").collect()}
    # unknown prices and parts without a brand are in the data
    assert failed <= {("fact_listing_daily", "not_null_price_kzt"), ("listing_current", "not_null_price_kzt"), ("listing_current", "not_null_make")}


def test_star_plan_has_no_cartesian_product(lake):
    text = plan(lake[2].fact_listing_daily)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_history_merge_needs_no_join(lake):
    t, _, _ = lake
    observed = B.observations(t).select("listing_id", "fetched_at", "http_status", "price_kzt", "photo_count")
    from motorlake.plans import silver as S
    text = plan(S.merge_snapshots(S.empty_silver(t.spark).snapshots, observed))
    assert "Join" not in text and text.count("Exchange") == 1


def test_fact_scan_prunes_partitions_and_columns(spark, lake):
    path = scratch_path(spark, "facts")
    W.write_table(lake[2].fact_listing_daily, path, "fact_listing_daily")
    text = plan(T.scan_table(spark, path, 20240115).select("listing_id"))
    assert "PartitionFilters: [isnotnull(date_key" in text
    assert "ReadSchema: struct<listing_id:bigint>" in text


def test_publish_isolates_failures(spark, lake):
    class Picky:
        name = "picky"

        def load(self, df, table):
            if table == "dim_vehicle":
                raise RuntimeError("no room")
            return df.count()

    register_sink("picky", Picky)
    tables = {n: lake[2].tables()[n] for n in ("dim_vehicle", "dim_date", "dim_location")}
    results = publish(tables, get_sink("picky"), scratch_path(spark, "exports"), dt.date(2024, 1, 30))
    assert [(r[0], r[2]) for r in results] == [("dim_date", "loaded"), ("dim_location", "loaded"), ("dim_vehicle", "failed")]
    assert publish(tables, get_sink("none"), "x", dt.date(2024, 1, 30)) == []
    with pytest.raises(ValueError, match="unknown sink"):
        get_sink("nowhere")


def test_published_twice_is_one_copy(spark, lake):
    sink, root = None, scratch_path(spark, "copy")
    sink = get_sink("parquet", root=root)
    for _ in range(2):
        ((_, n, _, _),) = publish({"dim_location": lake[2].dim_location}, sink, scratch_path(spark, "exports"), dt.date(2024, 1, 30))
    assert spark.read.parquet(f"{root}/gold/dim_location").count() == n == lake[2].dim_location.count()


def test_page_objects_round_trip(spark):
    from conftest import ts
    pages = spark.createDataFrame([(7, ts("2024-01-02 03:04:05"), "<p>a\nb</p>\n"), (8, ts("2024-01-03 00:00:00"), "ы")], "listing_id long, fetched_at timestamp, html string")
    path = scratch_path(spark, "objects")
    P.write_page_objects(pages, path)
    assert rows(P.read_page_objects(spark, path)) == rows(pages)


def test_page_objects_from_dated_keys(spark, tmp_path):
    import gzip
    folder = tmp_path / "2024" / "01" / "02"
    folder.mkdir(parents=True)
    (folder / "42_030405.html.gz").write_bytes(gzip.compress("<h1>x</h1>\n".encode()))
    (r,) = P.read_page_objects(spark, str(tmp_path)).collect()
    assert (r.listing_id, r.html, r.fetched_at.replace(tzinfo=None).minute) == (42, "<h1>x</h1>\n", 4)


def test_new_surrogate_keys_leave_old_ones(lake):
    t, _, _ = lake
    old = B.dimensions(t, B.silver_at_split(t).current).dim_seller
    grown = G.grow_dimension(old, G.seller_rows(B.silver(t).current), SELLER_COLUMNS, "seller_key")
    assert old.exceptAll(grown).count() == 0 and grown.count() > old.count()


def test_hot_listing_is_counted_before_the_lookup(lake):
    facts = lake[2].fact_listing_daily.select("vehicle_key", F.lit(1).alias("one"))
    text = V.top_makes(staged(facts, "f"), lake[2].dim_vehicle)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.index("count(1)")  # the count is below the join


def test_probes_are_isolated(lake):
    def broken():
        raise RuntimeError("gone")

    results = V.probe_each({"ok": lake[2].dim_location.count, "bad": broken})
    assert results[0][1] > 0 and results[1] == ("bad", None, "gone")


def test_one_key_orphans_are_one_row(spark):
    from motorlake.operators.joins import orphan_counts
    child = spark.range(1000).selectExpr("IF(id < 900, 7, id) AS k")
    parent = spark.range(900, 1000)
    assert rows(orphan_counts(child, "k", parent, "id")) == [(7, 900)]


def test_created_database_columns_keep_their_types(spark):
    from motorlake.schemas import LAKE
    from motorlake.sinks.files import column_types

    parser = spark._jsparkSession.sessionState().sqlParser()
    for schema in LAKE["gold"].values():
        parsed = parser.parseTableSchema(column_types(schema))
        assert [f.dataType().simpleString() for f in parsed.fields()] == [f.dataType.simpleString() for f in schema.fields]


def test_failed_table_fails_the_run_at_its_end():
    import pytest

    from motorlake.sinks.publish import raise_failed

    raise_failed([("dim_date", 3, "loaded", None)])
    with pytest.raises(RuntimeError, match="dim_seller: boom"):
        raise_failed([("dim_date", 3, "loaded", None), ("dim_seller", None, "failed", "boom")])


def test_repeated_pages_are_refused(spark):
    path, at = scratch_path(spark, "bronze"), dt.datetime(2024, 1, 5, 8)
    page = lambda i, hours, html: (i, at + dt.timedelta(hours=hours), html, 200)
    make = lambda *pages: spark.createDataFrame(list(pages), "listing_id long, fetched_at timestamp, html string, http_status int")
    assert P.append_pages(make(page(1, 0, "a"), page(2, 0, "b"), page(2, 0, "b2")), path).select("listing_id", "reason").collect() == [(2, "repeated")]
    again = P.append_pages(make(page(1, 0, "new text"), page(1, 20, "c"), page(3, 0, "d"), page(3, 0, "d")), path)
    assert rows(again.select("listing_id", "reason")) == [(1, "stored"), (3, "repeated")]
    assert rows(P.read_pages(spark, path).select("listing_id", "html").where("listing_id <> 2")) == [(1, "a"), (1, "c"), (3, "d")]
    assert rows(P.stored_page(spark, path, 1, at).select("html")) == [("a",)] and P.stored_page(spark, path, 1).count() == 2
    text = plan(P.stored_page(spark, path, 1, at))
    assert "PartitionFilters: [isnotnull(fetch_date" in text and "EqualTo(listing_id,1)" in text


def test_days_get_few_files(spark, lake):
    import glob
    path = scratch_path(spark, "facts")
    facts = lake[2].fact_listing_daily.repartition(8)
    W.write_table(facts, path, "fact_listing_daily")
    days = glob.glob(f"{path.removeprefix('file:')}/date_key=*")
    assert len(days) > 20 and all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in days)


def test_star_lookup_joins_on_one_key_and_checks_the_columns(spark):
    from motorlake.operators import joins
    columns = ["a", "b", "c"]
    schema = "a string, b string, c int"
    values = [("x", None, 1), (None, "x", 1), ("x", "y", None), (None, None, None), ("", "x", 1)]
    dim = spark.createDataFrame([(*v, i) for i, v in enumerate(values)], schema + ", k int")
    sent = spark.createDataFrame([(*v, f"r{i}") for i, v in enumerate([*values, ("x", "y", 1)])], schema + ", name string")
    found = joins.lookup_key(sent, dim, columns, "k")
    assert rows(found.select("name", "k")) == [(f"r{i}", i) for i in range(5)]
    assert plan(found).split("Join")[1].count("=") < 10 and "Cartesian" not in plan(found)


def test_calendar_grows_to_the_snapshots(spark, lake):
    t, silver, gold = lake
    early = silver.snapshots.limit(5).withColumn("snapshot_date", F.lit(dt.date(2001, 2, 3)))
    days = G.grow_calendar(gold.dim_date, G.snapshot_days(early))
    assert days.where("date_key = 20010203 AND day_of_week = 6 AND quarter = 1").count() == 1
    dropped = lambda d: {r.reason: r.n for r in G.dropped_snapshots(early, silver.current, d).collect()}
    with_, without = dropped(days), dropped(gold.dim_date)
    assert "day outside the calendar" not in with_
    assert sum(without.values()) == 5 and without.get("day outside the calendar", 0) == 5 - sum(with_.values())


def test_page_objects_are_written_by_all_tasks(spark):
    path = scratch_path(spark, "objects")
    pages = spark.range(40).coalesce(1).selectExpr("id AS listing_id", "timestamp_seconds(1706572800 + id) AS fetched_at", "concat('<p>', id, '\n') AS html")
    P.write_page_objects(pages, path)
    names = [r[0] for r in spark.read.text(path, recursiveFileLookup=True).select("_metadata.file_name").distinct().collect()]
    assert len({n.split("-")[1] for n in names}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows(P.read_page_objects(spark, path)) == rows(pages)


def test_page_objects_are_files_that_tasks_write_and_read(spark, monkeypatch):
    import os
    from conftest import ts
    at = ts("2024-01-02 03:04:05")
    pages = spark.createDataFrame(
        [(7, at, "<p>a\nb</p>\n"), (7, at, "<p>a\nb</p>\n"), (-8, at, "ы"), (9, at, None), (10, at, ""), (None, at, "x"), (None, at, "x"), (11, None, "y"), (None, None, None),
         (12, ts("2024-01-03 00:00:00"), "\n")], "listing_id long, fetched_at timestamp, html string")
    path, other, empty = (scratch_path(spark, "objects") for _ in range(3))
    P.write_page_objects(pages, path)
    names = [n for _, _, files in os.walk(path.removeprefix("file:")) for n in files if "_SUCCESS" not in n]
    assert len(names) >= 7 and all(n.startswith("part-") and n.endswith(".txt.gz") for n in names)  # no checksum beside each
    got = P.read_page_objects(spark, path)
    assert "FileScan text" not in plan(got) and "MapInArrow" in plan(got)
    P.write_page_objects(pages.limit(0), empty)
    assert P.read_page_objects(spark, empty).count() == 0 and P.read_page_objects(spark, path, empty).count() == len(names)
    monkeypatch.setattr(P, "local_folder", lambda spark, path: None)  # a store that only Spark reaches
    P.write_page_objects(pages, other)
    want = P.read_page_objects(spark, other)
    assert "FileScan text" in plan(want) and rows(want) == rows(got) == rows(P.read_page_objects(spark, path))
    assert {(7, "<p>a\nb</p>\n\n<p>a\nb</p>\n"), (9, ""), (10, ""), (12, "\n")} < {(r.listing_id, r.html) for r in got.collect()}


def test_page_objects_packed_in_other_ways(spark, tmp_path):
    import bz2
    folder = tmp_path / "2024" / "01" / "02"
    folder.mkdir(parents=True)
    (folder / "42_030405.html").write_text("plain")
    (folder / "_43_030405.html").write_text("hidden")
    (folder / "44_030405.html").write_text("")
    assert rows(P.read_page_objects(spark, str(tmp_path)).select("listing_id", "html")) == [(42, "plain")]
    (folder / "45_030405.html.bz2").write_bytes(bz2.compress(b"packed"))
    assert rows(P.read_page_objects(spark, str(tmp_path)).select("listing_id", "html")) == [(42, "plain"), (45, "packed")]
    assert P.read_page_objects(spark, f"{tmp_path}/2024/*").count() == 2

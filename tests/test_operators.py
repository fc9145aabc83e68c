import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from motorlake.operators import merge as M
from motorlake.operators import numbering as N
from motorlake.operators.joins import not_in, orphans
from motorlake.operators.latest import require_unique
from motorlake.operators import quality as Q
from motorlake.operators.stats import recent_errors, run_counters
from motorlake.plans import discover as D
from motorlake.plans import frontier
from motorlake.sources.calendar import calendar_around, index_page_range
from motorlake.sources.views_payload import payload_shapes, read_entries, view_counts
from motorlake.functions.text import redact_secrets
from motorlake.schemas import QUEUE


def test_upsert_policies(spark):
    target = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 2)], "id long, o string, k string, c int")
    batch = spark.createDataFrame([(2, None, "z", 9), (3, "n", "w", 9)], "id long, o string, k string, c int")
    got = M.upsert(target, batch, ["id"], overwrite=["o"], keep=["k"], computed={"c": "7"})
    assert rows(got) == [(1, "a", "x", 1), (2, None, "y", 7), (3, "n", "w", 7)]
    assert rows(M.upsert(got, batch, ["id"], ["o"], ["k"], {"c": "7"})) == rows(got)


def test_null_safe_insert(spark):
    have = spark.createDataFrame([("r", "c"), (None, "c")], "region string, city string")
    new = spark.createDataFrame([(None, "c"), (None, None), ("r", "d")], "region string, city string")
    assert rows(not_in(new, have, ["region", "city"])) == [("r", "d"), (None, None)] or len(rows(not_in(new, have, ["region", "city"]))) == 2
    assert M.insert_if_absent(have, new, ["region", "city"]).count() == 4


def test_surrogate_keys_are_dense_and_stable(spark):
    df = spark.range(5000).select((F.col("id") % 997).cast("string").alias("a"), F.when(F.col("id") % 3 > 0, "b").alias("b")).distinct()
    first = N.dense_index(df, ["a", "b"], "key")
    keys = [r.key for r in first.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    assert rows(first) == rows(N.dense_index(df.repartition(13), ["a", "b"], "key"))
    more = spark.createDataFrame([("new", None), ("new", "x")], "a string, b string")
    added = N.assign_surrogate_keys(more, first, ["a", "b"], "key")
    assert sorted(r.key for r in added.collect()) == [len(keys) + 1, len(keys) + 2]


def test_chunks_have_fixed_size(spark):
    chunks = N.id_chunks(spark.range(123).withColumnRenamed("id", "listing_id"), "listing_id", 50).collect()
    assert sorted(c.n_ids for c in chunks) == [23, 50, 50]
    assert sorted(int(i) for c in chunks for i in c.ids.split(",")) == list(range(123))


def test_duplicate_merge_key_fails(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    with pytest.raises(Exception, match="duplicate merge key"):
        require_unique(df, ["id"]).collect()


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    assert rows(orphans(child, "k", spark.createDataFrame([(1,)], "id long"), "id")) == [(2,)]


def test_quality_levels(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id long, price int")
    soft = Q.run_thresholds(df, [Q.Threshold("ratio", "t", Q.null_ratio("price"), 0.1, "max", "warning")])
    assert Q.enforce(soft) == {"dq_checks_passed": True, "warnings": 1, "errors": 0}
    with pytest.raises(Q.QualityError, match="not_null_price"):
        Q.enforce(Q.run_thresholds(df, [Q.not_null("t", "price")]))
    assert Q.run_thresholds(df.where("false"), [Q.Threshold("r", "t", Q.null_ratio("price"), 0.0)]).collect()[0].value == 0.0


def test_payload_values(spark):
    body = (
        '{"data": {"1": 7, "2": 7.9, "3": " 12 ", "4": {"views": 0, "count": 3}, "5": {"views": 0}, "6": {"b": "x", "z": 4, "a": 1},'
        ' "7": {"views": "", "count": null, "value": "8"}, "8": "7.5", "9": null, "x1": 3, "10": {"views": {}}, "11": true, "12": {"n": "q"}}}'
    )
    df = spark.createDataFrame([(body,), ('{"data": [1]}',), ('{"data": null}',), ("{}",), ("oops",)], "body string")
    assert rows(view_counts(df)) == sorted([(1, 7), (2, 7), (3, 12), (4, 3), (5, 0), (6, 4), (7, 8), (11, 1)], key=repr)
    assert [r.shape for r in payload_shapes(df).collect()] == ["ok", "not_an_object", "not_an_object", "empty", "unreadable"]


def test_payload_is_one_whole_value(spark):
    good = '{"data":{"1":5}}'
    tails = ["", " \n", "] x", "]", "][", ", 1", ", 1]", ' {"data": 1}', "}", ',"x"]', " x", "\\", '"']
    df = spark.createDataFrame([(i, good + t) for i, t in enumerate(tails)] + [(90, good[:-1]), (91, '["a'), (92, ""), (93, None), (94, good + good)], "n int, body string")
    shapes = {r.n: r.shape for r in payload_shapes(df).collect()}
    assert {n for n, s in shapes.items() if s != "unreadable"} == {0, 1} and len(shapes) == len(tails) + 5
    assert rows(read_entries(df, carry=["n"]).select("n", "id_text")) == [(0, "1"), (1, "1")]
    plan = view_counts(df, carry=["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1


def test_discovery_stops(spark):
    page = lambda n: f"<a href='/a/show/{n}'></a>listing.grid.push({{ id: {n + 1}" + "x" * 6000
    pages = spark.createDataFrame([(1, page(10)), (2, page(11)), (3, "x" * 6000), (4, page(50))], "page_no long, html string")
    assert rows(D.discovered_ids(D.ids_per_page(pages))) == [(10,), (11,), (12,)]
    blocked = spark.createDataFrame([(1, page(10)), (2, "captcha"), (3, page(50))], "page_no long, html string")
    assert rows(D.discovered_ids(D.ids_per_page(blocked))) == [(10,), (11,)]


def test_index_pages(spark):
    urls = [r.page_url for r in index_page_range(spark, 1, 3, "https://c.example").orderBy("page_no").collect()]
    assert urls == ["https://c.example/cars/", "https://c.example/cars/?page=2", "https://c.example/cars/?page=3"]


def test_queue_life(spark):
    now = F.lit(ts("2024-01-10 00:00"))
    queue = frontier.new_queue_rows(spark.createDataFrame([(i, f"u{i}") for i in range(5)], "listing_id long, url string"), now)
    assert queue.schema.names == QUEUE.names and rows(queue.select("state", "attempts").distinct()) == [("NEW", 0)]
    done = spark.createDataFrame([(0, "parsed", None), (1, "gone", None), (2, "blocked", None), (3, "error", "boom")], "listing_id long, outcome string, error string")
    after = {r.listing_id: r for r in frontier.apply_outcomes(queue, done, now).collect()}
    assert [after[i].state for i in range(5)] == ["FETCHED", "INACTIVE", "RETRY", "RETRY", "NEW"]
    assert [after[i].attempts for i in range(5)] == [1, 1, 1, 1, 0]
    assert after[2].last_error == "Blocking detected" and after[3].last_error == "boom" and after[3].last_http_status == 0
    later = frontier.apply_outcomes(queue, done, now)
    assert rows(frontier.claim(later, now).select("listing_id")) == [(4,)]
    in_two_minutes = F.lit(ts("2024-01-10 00:02"))
    assert rows(frontier.claim(later, in_two_minutes).select("listing_id")) == [(2,), (3,), (4,)]


def test_run_statistics(spark):
    data = [("r", 1, ts("2024-01-01 00:00"), "parsed", 200, None), ("r", 2, ts("2024-01-01 00:01"), "failed", 500, "e"), ("r", 3, ts("2024-01-01 00:02"), "blocked", None, None)]
    df = spark.createDataFrame(data + [("r", i, ts("2024-01-02 00:00"), "failed", None, f"e{i}") for i in range(20)], "run string, listing_id long, at timestamp, outcome string, http_status int, error string")
    assert rows(run_counters(df, "run")) == [("r", 0, 2, 1, 21, 1, 0)]
    tail = recent_errors(df, "run").collect()
    assert len(tail) == 10 and tail[0].error_count == 21 and {r.error for r in tail} == {f"e{i}" for i in range(10, 20)}


def test_calendar(spark):
    days = calendar_around(spark, dt.date(2024, 1, 30))
    assert days.count() == 731
    (r,) = days.where("d = date'2024-02-04'").collect()
    assert (r.date_key, r.year, r.quarter, r.month, r.day_of_week) == (20240204, 2024, 1, 2, 7)


def test_redaction(spark):
    df = spark.createDataFrame([("postgresql://me:s3cret@h/db TOKEN: 'abc' x",), ("",), (None,)], "m string")
    got = [r[0] for r in df.select(redact_secrets(F.col("m"))).collect()]
    assert got == ['postgresql://me:***@h/db TOKEN="***"\' x', "", None]


def test_a_staged_table_leaves_no_shuffle_files(spark):
    import time

    from motorlake.session import staged

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {n for n in disk.getAllFiles().mkString("\n").split() if "/shuffle_" in n}
    before, setting = held(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    kept = spark.range(1000).repartition(3, "id")
    table = staged(kept.groupBy("id").count(), "counts")
    until = time.time() + 5
    while held() - before and time.time() < until:
        time.sleep(0.1)
    assert not held() - before and table.count() == kept.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting

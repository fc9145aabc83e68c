"""Date, number, list and JSON value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.oracle import BASE
from motorlake.checks.registry import query
from motorlake.functions import dates as D
from motorlake.functions import values as V
from motorlake.functions.html import is_photo_url
from motorlake.functions.text import absolute_url, export_object_key, page_object_key
from motorlake.sources import views_payload
from motorlake.sources.views_payload import read_entries, view_counts


@query("D1", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def order_date_keys(t):
    return t.orders.select("o_orderkey", D.date_key(F.col("o_orderdate")).alias("date_key"))


@query("D2", """
  SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter,
         month(o_orderdate)::INTEGER AS month, isodow(o_orderdate)::INTEGER AS day_of_week FROM orders""")
def order_calendar_parts(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in D.calendar_parts(F.col("o_orderdate")).items()])


@query("D4 D5", """
  SELECT event_id, CAST(ts AS DATE)::VARCHAR AS day, (CAST(ts AS DATE) - 365)::VARCHAR AS year_before, (CAST(ts AS DATE) + 365)::VARCHAR AS year_after FROM events""")
def shifted_days(t):
    day = F.to_date("ts")
    return t.events.select("event_id", day.alias("day"), F.date_sub(day, 365).alias("year_before"), F.date_add(day, 365).alias("year_after"))


@query("D7 A2", """
  SELECT user_id, CASE WHEN count(*) FILTER (value > 300) = 0 THEN 0.0
         ELSE CAST(count(*) FILTER (event_type = 'signup' AND value > 300) AS DOUBLE) / count(*) FILTER (value > 300) END AS ratio FROM events GROUP BY 1""")
def guarded_ratios(t):
    high = F.col("value") > 300
    ratio = D.safe_ratio(F.count_if((F.col("event_type") == "signup") & high), F.count_if(high))
    return t.events.groupBy("user_id").agg(ratio.alias("ratio"))


@query("T2", """
  SELECT event_id, CAST(TRY_CAST(value AS DECIMAL(3,1)) AS DOUBLE) AS volume, CAST(CAST(value AS DECIMAL(14,2)) AS DOUBLE) AS price FROM events""")
def fitted_decimals(t):
    v = F.col("value")
    return t.events.select("event_id", V.fit_decimal(v, 3, 1, strict=False).alias("volume"), V.fit_decimal(v, 14, 2).alias("price"))


@query("T3 T4 T8", """
  SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '[]' ELSE '["' || replace(p_name, ' ', '","') || '"]' END AS photos,
         CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 2 END AS photo_count,
         CASE WHEN p_partkey % 5 <> 0 THEN replace(p_name, ' ', '; ') END AS flat FROM part""")
def photo_lists(t):
    words = F.when(F.col("p_partkey") % 5 != 0, F.split("p_name", " "))
    return t.part.select("p_partkey", V.photos_json(words).alias("photos"), V.photo_count(words).alias("photo_count"), V.flatten_list(words).alias("flat"))


@query("W5", """
  SELECT doc_id, count(*) AS n_lines, md5(string_agg(line, chr(10) ORDER BY first_at)) AS digest FROM (
    SELECT doc_id, line, min(i) AS first_at FROM (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) a
    GROUP BY 1, 2) q GROUP BY 1""")
def distinct_document_lines(t):
    """Order-preserving de-duplication of a list."""
    lines = F.array_distinct(F.split("text", "\n"))
    rows = t.documents.select("doc_id", lines.alias("l"))
    return rows.select("doc_id", F.size("l").cast("bigint").alias("n_lines"), F.md5(F.array_join("l", "\n")).alias("digest"))


@query("P12 F19", f"""
  SELECT page_id, url LIKE 'http%' AS is_photo, FALSE AS ftp_is_photo, '{BASE}/x/' || page_id AS absolute FROM pages""")
def photo_url_predicate(t):
    relative = F.concat(F.lit("/x/"), F.col("page_id").cast("string"))
    return t.pages.select(
        "page_id", is_photo_url(F.col("url")).alias("is_photo"), is_photo_url(F.concat(F.lit("ftp:"), relative)).alias("ftp_is_photo"),
        absolute_url(B.BASE_URL, relative).alias("absolute"),
    )


@query("F22", """
  SELECT event_id, strftime(ts, '%Y/%m/%d/') || user_id || strftime(ts, '_%H%M%S') || '.html.gz' AS page_key,
         strftime(ts, '%Y/%m/%d/') || event_type || strftime(ts, '_%Y%m%d') || '.parquet' AS export_key FROM events""")
def object_keys(t):
    ts = F.col("ts").cast("timestamp")
    return t.events.select("event_id", page_object_key(F.col("user_id"), ts).alias("page_key"), export_object_key(F.col("event_type"), ts).alias("export_key"))


@query("S4 T6", """
  SELECT event_id, CASE WHEN event_id % 15 = 6 THEN 'x' ELSE '' END || user_id AS id_text FROM events WHERE event_id % 15 < 8""")
def payload_entries(t):
    return read_entries(B.view_payloads(t), carry=["event_id"]).select("event_id", "id_text")


@query("T5 T6 T9", "SELECT event_id, listing_id, views FROM vcounts", "vcounts")
def payload_view_counts(t):
    return view_counts(B.view_payloads(t), carry=["event_id"])


@query("T7", """
  SELECT CASE WHEN event_id % 15 < 8 THEN 'ok' WHEN event_id % 15 = 8 THEN 'not_an_object' WHEN event_id % 15 = 9 THEN 'empty' ELSE 'unreadable' END AS shape,
         count(*) AS n FROM events GROUP BY 1""")
def payload_shapes(t):
    return views_payload.payload_shapes(B.view_payloads(t)).groupBy("shape").agg(F.count(F.lit(1)).alias("n"))


@query("T1", """
  SELECT event_id AS listing_id, CASE WHEN event_id % 3 <> 0 THEN CAST(trunc(value) AS BIGINT) END AS views, value FROM events""")
def repaired_integers(t):
    rows = t.events.select(
        F.col("event_id").cast("double").alias("listing_id"),
        F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("views"), "value",
    )
    return V.repair_integers(rows)

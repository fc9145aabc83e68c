"""File sources and sinks: everything is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.registry import query
from motorlake.functions.text import sha256_hex
from motorlake.plans.parse import parse_pages
from motorlake.schemas import LAKE, PARSED
from motorlake.session import scratch_path
from motorlake.sinks import files as W
from motorlake.sinks.publish import get_sink, publish, publish_summary
from motorlake.sources import pages as P
from motorlake.sources import tables as T


@query("S1 K1", "SELECT listing_id, fetched_at, sha256(html) AS sha256 FROM fetched", "fetched")
def raw_page_objects(t):
    """Pages as one gzipped object each; id and time come back from the path."""
    path = scratch_path(t.spark, "objects")
    P.write_page_objects(B.fetched_pages(t), path)
    return P.read_page_objects(t.spark, path).select("listing_id", "fetched_at", sha256_hex(F.col("html")).alias("sha256"))


@query("K1 F20 F22", """
  SELECT listing_id, fetched_at, 'raw-html' AS bucket, strftime(fetched_at, '%Y/%m/%d/') || listing_id || strftime(fetched_at, '_%H%M%S') || '.html.gz' AS object_key,
         sha256(html) AS sha256, http_status FROM fetched""", "fetched")
def bronze_page_metadata(t):
    return P.page_metadata(B.fetched_pages(t), "raw-html")


@query("K1", "SELECT listing_id, fetched_at, sha256(html) AS sha256, http_status, CAST(fetched_at AS DATE)::VARCHAR AS fetch_date FROM fetched", "fetched")
def bronze_append(t):
    path = scratch_path(t.spark, "bronze")
    pages = B.fetched_pages(t)
    P.append_pages(pages.where("listing_id % 2 = 0"), path)
    P.append_pages(pages, path)  # half of them are there already
    return P.read_pages(t.spark, path).select("listing_id", "fetched_at", "sha256", "http_status", "fetch_date")


@query("K1 Q4", """
  SELECT listing_id, fetched_at, sha256(html) AS sha256, 'stored' AS reason FROM fetched WHERE listing_id % 2 = 0
  UNION ALL SELECT listing_id, fetched_at, sha256(html), 'repeated' FROM fetched WHERE listing_id % 6 = 3""", "fetched")
def bronze_duplicates(t):
    """Pages of a second append that the table has already, or that come twice in it."""
    path = scratch_path(t.spark, "bronze")
    pages = B.fetched_pages(t)
    P.append_pages(pages.where("listing_id % 2 = 0"), path)
    return P.append_pages(pages.unionByName(pages.where("listing_id % 6 = 3")), path)


@query("P13 K1", "SELECT listing_id, fetched_at, sha256(html) AS sha256 FROM fetched WHERE listing_id = (SELECT max(page_id) // 2 FROM pages)", "fetched")
def stored_page_lookup(t):
    path = scratch_path(t.spark, "bronze")
    P.append_pages(B.fetched_pages(t), path)
    wanted = t.pages.agg(F.max("page_id")).first()[0] // 2
    return P.stored_page(t.spark, path, wanted).select("listing_id", "fetched_at", "sha256")


@query("S2 K3", "SELECT date_key, listing_id, location_key, CAST(price_kzt AS DOUBLE) AS price_kzt FROM facts WHERE date_key = 20240115", "facts")
def fact_scan_by_date_key(t):
    path = scratch_path(t.spark, "facts")
    W.write_table(B.gold(t).fact_listing_daily, path, "fact_listing_daily")
    return T.scan_table(t.spark, path, 20240115).select("date_key", "listing_id", "location_key", "price_kzt")


@query("S3 T1", "SELECT event_id AS listing_id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS views, value FROM events")
def integer_repair_scan(t):
    path = scratch_path(t.spark, "floats")
    views = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("user_id").cast("double"))
    t.events.select(F.col("event_id").cast("double").alias("listing_id"), views.alias("views"), "value").write.parquet(path)
    return T.scan_repaired(t.spark, path)


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "embeddings", "benchmark",
           "labels", "conversations"]


@query("S7 A1", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _TABLES))
def catalog_row_counts(t):
    """Registered tables found in the catalog, each counted."""
    prefix = "lake_" + scratch_path(t.spark, "x").rsplit("-", 1)[1] + "_"
    t.spark.sql(f"CREATE DATABASE {prefix}given LOCATION '{scratch_path(t.spark, 'db')}'")
    for name in _TABLES:
        T.register_files(t.spark, f"{prefix}given", name, f"{t.folder}/{name}.parquet")
    found = T.catalog_tables(t.spark, prefix)
    counts = T.row_counts({n: t.spark.table(f"{prefix}given.{n}") for n in _TABLES})
    return counts.join(found, "table_name", "left_semi")


@query("K2", "SELECT date_key, listing_id, CAST(price_kzt AS DOUBLE) AS price_kzt FROM facts", "facts")
def dated_snapshot_export(t):
    path = W.export_table(B.gold(t).fact_listing_daily, scratch_path(t.spark, "exports"), "fact_listing_daily", B.AS_OF)
    assert path.endswith("/2024/01/30/fact_listing_daily_20240130.parquet")
    return t.spark.read.parquet(path).select("date_key", "listing_id", "price_kzt")


@query("K3", "SELECT 'fact_listing_daily' AS table_name, count(*) AS written, count(*) AS readable FROM facts", "facts")
def published_table_count(t):
    """Publishing twice leaves one copy; the count comes from the write itself."""
    path, facts = scratch_path(t.spark, "published"), B.gold(t).fact_listing_daily
    W.write_table(facts, path, "fact_listing_daily")
    written = W.write_table(facts, path, "fact_listing_daily")
    back = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("readable"))
    return back.select(F.lit("fact_listing_daily").alias("table_name"), F.lit(written).cast("bigint").alias("written"), "readable")


@query("K4", "SELECT location_key, region, city FROM loc", "loc")
def lake_tables_created(t):
    """Create the lake (twice), insert a dimension, read it by table name."""
    prefix = "lake_" + scratch_path(t.spark, "x").rsplit("-", 1)[1] + "_"
    root = scratch_path(t.spark, "lake")
    T.create_lake(t.spark, root, prefix)
    T.create_lake(t.spark, root, prefix)
    B.dimensions(t, B.silver(t).current).dim_location.write.insertInto(f"{prefix}gold.dim_location")
    return t.spark.table(f"{prefix}gold.dim_location")


_LINEITEM = {
    "l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "BIGINT", "l_quantity": "NUMERIC",
    "l_extendedprice": "NUMERIC", "l_discount": "NUMERIC", "l_tax": "NUMERIC", "l_returnflag": "TEXT", "l_linestatus": "TEXT", "l_shipdate": "TIMESTAMPTZ",
}


@query("K5", " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{k}' AS target_type, count({c}) AS filled_rows FROM lineitem" for c, k in _LINEITEM.items()))
def target_column_profile(t):
    return W.target_profile(t.lineitem)


@query("K6", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, 'loaded' AS status, CAST(NULL AS VARCHAR) AS error FROM {v}"
    for n, v in [("dim_date", "cal"), ("dim_location", "loc"), ("dim_vehicle", "veh"), ("dim_seller", "sel"), ("fact_listing_daily", "facts"), ("fact_price_event", "pfacts")]
), "facts pfacts")
def ordered_publish(t):
    sink = get_sink("parquet", root=scratch_path(t.spark, "copy"))
    results = publish(B.gold(t).tables(), sink, scratch_path(t.spark, "exports"), B.AS_OF)
    return publish_summary(t.spark, results)


@query("K6 K3", "SELECT date_key, listing_id, vehicle_key, CAST(price_kzt AS DOUBLE) AS price_kzt, is_active, days_on_site FROM facts", "facts")
def published_facts(t):
    root = scratch_path(t.spark, "copy")
    publish({"fact_listing_daily": B.gold(t).fact_listing_daily}, get_sink("parquet", root=root), scratch_path(t.spark, "exports"), B.AS_OF)
    back = t.spark.read.parquet(f"{root}/gold/fact_listing_daily")
    return W.conform(back, LAKE["gold"]["fact_listing_daily"]).select("date_key", "listing_id", "vehicle_key", "price_kzt", "is_active", "days_on_site")


_PHOTOS = "'https://cars.example/p/' || p_partkey || '?a=1&b=2' || {sep} || 'https://img.example/1.jpg'"


@query("K7 T8", "SELECT p_partkey AS listing_id, p_brand AS make, " + _PHOTOS.format(sep="'; '") + " AS photos, p_size + 1990 AS car_year FROM part")
def listing_csv_export(t):
    path = scratch_path(t.spark, "csv")
    W.write_csv(parse_pages(B.listing_pages(t), B.BASE_URL), path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString() if f.dataType.typeName() != 'array' else 'string'}" for f in PARSED.fields)
    return t.spark.read.schema(kinds).option("header", True).option("escape", '"').csv(path).select("listing_id", "make", "photos", "car_year")


@query("K7", "SELECT p_partkey AS listing_id, p_brand AS make, " + _PHOTOS.format(sep="'|'") + " AS photos, p_size + 1990 AS car_year FROM part")
def listing_json_export(t):
    path = scratch_path(t.spark, "json")
    W.write_json_lines(parse_pages(B.listing_pages(t), B.BASE_URL), path)
    return t.spark.read.schema(PARSED).json(path).select("listing_id", "make", "photos", "car_year")


@query("K8", """
  SELECT p_partkey, CASE WHEN p_partkey % 4 > 1 THEN p_name || ', "' || p_brand || '"' END AS note, p_size FROM part""")
def bulk_csv_nulls(t):
    """Nulls and empty texts both load as null; quotes and commas survive."""
    n = F.col("p_partkey")
    note = F.when(n % 4 == 0, "").when(n % 4 > 1, F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')))
    path, rows = scratch_path(t.spark, "bulk"), t.part.select("p_partkey", note.alias("note"), "p_size")
    W.write_bulk_csv(rows, path)
    return W.read_bulk_csv(t.spark, path, rows.schema)

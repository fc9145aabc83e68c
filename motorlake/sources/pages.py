"""Bronze: raw listing pages and their metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.functions.text import capture, page_object_key, sha256_hex
from motorlake.session import staged, table_exists
from motorlake.sources.objects import is_folder, local_folder, read_objects, write_objects

#: Listings that the Bloom filter of a file is laid out for (about 1 MB; files hold whole pages, so few reach it).
BLOOM_LISTINGS = 100_000


def page_metadata(pages: DataFrame, bucket: str) -> DataFrame:
    """One metadata row per page (listing_id, fetched_at, html, http_status)."""
    return pages.select(
        "listing_id", "fetched_at", F.lit(bucket).alias("bucket"),
        page_object_key(F.col("listing_id"), F.col("fetched_at")).alias("object_key"),
        sha256_hex(F.col("html")).alias("sha256"), F.col("http_status").cast("int").alias("http_status"),
    )


_PAGE_KEY = ["listing_id", "fetched_at"]


def append_pages(pages: DataFrame, path: str) -> DataFrame:
    """Append pages to the bronze table, one partition per fetch day; returns the refused ones.

    A (listing_id, fetched_at) that the table holds already, or that the batch
    holds before, is not written again: ``listing_id, fetched_at, sha256, reason``
    ('stored' or 'repeated') of such pages come back. Only the key columns of the
    days that the batch touches are read for it. Files carry Bloom filters on the
    listing, so looking a page up opens few of them.
    """
    spark = pages.sparkSession
    batch = pages.withColumn("sha256", sha256_hex(F.col("html"))).withColumn("fetch_date", F.to_date("fetched_at"))
    batch = staged(batch.withColumn("_row", F.monotonically_increasing_id()), "pages")
    days = [r["fetch_date"] for r in batch.select("fetch_date").distinct().collect()]  # a few hundred a year
    keys = batch.select(*_PAGE_KEY, "fetch_date", "sha256", "_row")
    first = keys.groupBy(*_PAGE_KEY).agg(F.min("_row").alias("_first"))
    marked = keys.join(first, _PAGE_KEY).withColumn("reason", F.when(F.col("_row") != F.col("_first"), "repeated"))
    if table_exists(spark, path):
        held = read_pages(spark, path).where(F.col("fetch_date").isin(days)).select(*_PAGE_KEY).distinct().withColumn("_held", F.lit(True))
        marked = marked.join(held, _PAGE_KEY, "left").withColumn("reason", F.when(F.col("_held"), "stored").otherwise(F.col("reason")))
    refused = staged(marked.where(F.col("reason").isNotNull()).select(*_PAGE_KEY, "sha256", "reason", "_row"), "refused")
    fresh = batch.join(refused.select("_row"), "_row", "left_anti").drop("_row")
    (
        fresh.write.partitionBy("fetch_date").mode("append")
        .option("parquet.bloom.filter.enabled#listing_id", "true")
        .option("parquet.bloom.filter.expected.ndv#listing_id", BLOOM_LISTINGS).parquet(path)
    )
    return refused.drop("_row")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stored_page(spark: SparkSession, path: str, listing_id: int, fetched_at=None) -> DataFrame:
    """The stored pages of a listing, or the one of a fetch time: its day's partition only."""
    found = read_pages(spark, path).where(F.col("listing_id") == listing_id)
    if fetched_at is None:
        return found
    at = F.lit(fetched_at).cast("timestamp")
    return found.where((F.col("fetch_date") == F.to_date(at)) & (F.col("fetched_at") == at))


def write_page_objects(pages: DataFrame, path: str) -> None:
    """One gzipped text file per page, keyed ``YYYY/MM/DD/{id}_{HHMMSS}``.

    The partition columns carry the key, and pages are dealt to all tasks first.
    Creating an object costs far more than moving its page: in a folder that
    tasks can open as files they write them so; in any other store the text
    writer does, each task putting its objects in place itself (committer
    version 2) instead of leaving all of them to the driver at the end. An
    object's name follows from its key and task, so a repeated task writes over
    its own; a failed run may leave objects, as any object store does.
    """
    spark = pages.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.repartition(tasks, "listing_id", "fetched_at").select(
        F.date_format("fetched_at", "yyyy-MM-dd").alias("day"),
        F.concat(F.col("listing_id").cast("string"), F.date_format("fetched_at", "_HHmmss")).alias("object"),
        F.col("html").alias("value"),
    )
    if folder := local_folder(spark, path):
        return write_objects(rows, path, folder)
    (
        rows.write.partitionBy("day", "object").mode("append").option("compression", "gzip")
        .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
    )


def read_page_objects(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw page objects with the id and fetch time taken from their path.

    Accepts both ``YYYY/MM/DD/{id}_{HHMMSS}.html.gz`` keys and the partition
    layout of ``write_page_objects``; gzip is transparent to the reader. The
    objects are those there at the call. Folders that tasks can open as files
    are listed and read by tasks, any other store by Spark's reader.
    """
    folders, files = [local_folder(spark, p) for p in paths], None
    if all(folders) and all(is_folder(spark, p) for p in paths):
        files = read_objects(spark, folders)
    if files is None:
        files = spark.read.text(list(paths), wholetext=True, recursiveFileLookup=True).select(
            F.col("value"), F.col("_metadata.file_path").alias("path")
        )
    # The text writer ends each of its files with a line feed that is not the page's.
    written = F.col("path").contains("object=")
    page = F.when(written, F.regexp_replace("value", r"\n\z", "")).otherwise(F.col("value"))
    key = r"(\d{4})[-/](\d{2})[-/](\d{2})/(?:object=)?(\d+)_(\d{6})"
    part = lambda group: capture(F.col("path"), key, group)
    stamp = F.concat(part(1), part(2), part(3), part(5))
    return files.select(
        part(4).cast("bigint").alias("listing_id"), F.to_timestamp(stamp, "yyyyMMddHHmmss").alias("fetched_at"), page.alias("html")
    )

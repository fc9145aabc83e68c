"""Discovery, queue and run statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.oracle import BASE, NOW
from motorlake.checks.registry import query
from motorlake.functions import fixed
from motorlake.functions.dates import backoff_minutes, next_retry_at
from motorlake.operators.numbering import batch_numbers, id_chunks
from motorlake.operators.stats import recent_errors, run_counters, status_histogram, status_map
from motorlake.plans import discover as D
from motorlake.plans import frontier as Q
from motorlake.plans import silver as S
from motorlake.sources.calendar import index_pages

_ALL_IDS = "SELECT DISTINCT unnest(ids) AS listing_id FROM ix"


def _pages(t):
    return D.ids_per_page(B.index_pages(t))


def _all_ids(t):
    return _pages(t).select(F.explode("listing_ids").alias("listing_id")).distinct()


@query("S6", f"""
  SELECT page_id + 1 AS page_no, CASE WHEN page_id = 0 THEN '{BASE}/cars/' ELSE '{BASE}/cars/?page=' || (page_id + 1) END AS page_url FROM pages""")
def index_page_urls(t):
    return index_pages(B.index_pages(t).select("page_no"), "page_no", B.BASE_URL)


@query("U1 F16 T9", "SELECT DISTINCT page_no, unnest(ids) AS listing_id FROM ix", "ix")
def ids_found_per_page(t):
    return _pages(t).select("page_no", F.explode("listing_ids").alias("listing_id"))


@query("U2", _ALL_IDS, "ix")
def ids_found_on_all_pages(t):
    return _all_ids(t)


@query("L7", "SELECT page_no, len(list_distinct(ids)) AS n_ids FROM ix WHERE page_no < coalesce((SELECT min(page_no) FROM ix WHERE is_empty), 9223372036854775807)", "ix")
def pages_before_first_empty(t):
    return D.before_first_empty(_pages(t)).select("page_no", F.col("n_ids").cast("bigint").alias("n_ids"))


@query("U3", f"SELECT count(*) AS inserted FROM ({_ALL_IDS}) i WHERE listing_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 = 0)", "ix")
def newly_queued_count(t):
    known = B.queue(t).where(F.col("listing_id") % 3 == 0)
    return Q.newly_queued(known, D.with_urls(_all_ids(t), B.BASE_URL)).agg(F.count(F.lit(1)).alias("inserted"))


@query("M5 F19", f"""
  SELECT listing_id, url, discovered_at, state, attempts, next_retry_at, last_http_status, last_error FROM que
  UNION ALL
  SELECT listing_id, '{BASE}/a/show/' || listing_id, {NOW}, 'NEW', 0, NULL, NULL, NULL FROM ({_ALL_IDS}) i
  WHERE listing_id NOT IN (SELECT p_partkey FROM part)""", "que ix")
def queue_insert_if_absent(t):
    return Q.enqueue(B.queue(t), D.with_urls(_all_ids(t), B.BASE_URL), B.now()).drop("last_attempt_at")


@query("L4", f"{_ALL_IDS} ORDER BY listing_id LIMIT 3", "ix")
def smallest_ids(t):
    return _all_ids(t).orderBy("listing_id").limit(3)


@query("P3", f"SELECT listing_id, state FROM que WHERE state IN ('NEW', 'RETRY') AND (next_retry_at IS NULL OR next_retry_at <= {NOW})", "que")
def ready_to_fetch(t):
    return B.queue(t).where(Q.is_ready(B.now())).select("listing_id", "state")


@query("P4", "SELECT count(*) AS pending FROM que WHERE state IN ('NEW', 'RETRY')", "que")
def pending_count(t):
    return B.queue(t).where(Q.is_pending()).agg(F.count(F.lit(1)).alias("pending"))


@query("L3", f"""
  SELECT listing_id, url, attempts FROM que WHERE state IN ('NEW', 'RETRY') AND (next_retry_at IS NULL OR next_retry_at <= {NOW})
  ORDER BY coalesce(next_retry_at, discovered_at), listing_id LIMIT 200""", "que")
def claimed_batch(t):
    return Q.claim(B.queue(t), B.now(), fixed.CLAIM_BATCH)


_QUEUE_AFTER = f"""
  SELECT q.listing_id, q.url,
    CASE WHEN r.outcome IS NULL THEN q.state WHEN r.outcome = 'parsed' THEN 'FETCHED' WHEN r.outcome = 'gone' THEN 'INACTIVE' ELSE 'RETRY' END AS state,
    q.attempts + CASE WHEN r.outcome IS NULL THEN 0 ELSE 1 END AS attempts,
    CASE WHEN r.outcome IS NOT NULL THEN {NOW} END AS last_attempt_at,
    CASE WHEN r.outcome IS NULL THEN q.next_retry_at WHEN r.outcome IN ('blocked', 'error')
      THEN {NOW} + to_minutes(CAST(least(power(2, q.attempts + 1), 1440) AS INTEGER)) END AS next_retry_at,
    CASE WHEN r.outcome IS NULL THEN q.last_http_status WHEN r.outcome = 'parsed' THEN 200 WHEN r.outcome = 'gone' THEN 404 ELSE 0 END AS last_http_status,
    CASE WHEN r.outcome IS NULL THEN q.last_error WHEN r.outcome = 'blocked' THEN 'Blocking detected' ELSE r.error END AS last_error
  FROM que q LEFT JOIN runs r USING (listing_id)"""


@query("M6 M7 M8", _QUEUE_AFTER, "que runs")
def queue_after_outcomes(t):
    return Q.apply_outcomes(B.queue(t), B.run_outcomes(t), B.now()).drop("discovered_at")


@query("M7 D6", f"""
  SELECT event_id, CAST(least(power(2, event_id % 40), 1440) AS INTEGER) AS minutes,
         {NOW} + to_minutes(CAST(least(power(2, event_id % 40), 1440) AS INTEGER)) AS next_retry_at FROM events""")
def retry_backoff(t):
    attempts = (F.col("event_id") % 40).cast("int")
    return t.events.select("event_id", backoff_minutes(attempts).alias("minutes"), next_retry_at(attempts, B.now()).alias("next_retry_at"))


@query("P11", """
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'blocked' WHEN user_id % 5 = 0 THEN 'gone' WHEN user_id % 5 = 1 THEN 'error' ELSE 'parsed' END AS outcome FROM events""")
def fetch_outcome_routing(t):
    status = F.when(F.col("user_id") % 5 == 0, 404).when(F.col("user_id") % 5 == 1, 503).otherwise(200)
    reason = F.when(F.col("event_id") % 7 == 0, "CAPTCHA challenge page")
    return t.events.select("event_id", D.fetch_outcome(status, reason).alias("outcome"))


@query("P14", """
  SELECT p_partkey AS listing_id, p_partkey IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS duplicate FROM part""")
def already_seen_skip(t):
    seen = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("listing_id")).distinct()
    fresh, duplicate = D.skip_seen(t.part.select(F.col("p_partkey").alias("listing_id")), seen)
    return fresh.withColumn("duplicate", F.lit(False)).unionByName(duplicate.withColumn("duplicate", F.lit(True)))


@query("L5", """
  SELECT (i - 1) // 50 AS chunk_no, count(*)::INTEGER AS n_ids, string_agg(CAST(listing_id AS VARCHAR), ',' ORDER BY listing_id) AS ids
  FROM (SELECT listing_id, row_number() OVER (ORDER BY md5('+' || listing_id)) AS i FROM snap WHERE snapshot_date = DATE '2024-01-30') q GROUP BY 1""", "snap")
def view_request_chunks(t):
    ids = S.missing_views(B.silver(t).snapshots, B.AS_OF).select("listing_id")
    return id_chunks(ids, "listing_id", fixed.VIEWS_CHUNK)


@query("L6", f"""
  SELECT (i - 1) // 5 + 1 AS batch_no, count(*) AS n, min(listing_id) AS first_id, max(listing_id) AS last_id
  FROM (SELECT listing_id, row_number() OVER (ORDER BY md5('+' || listing_id)) AS i FROM que WHERE state IN ('NEW', 'RETRY')) q GROUP BY 1""", "que")
def fetch_batches(t):
    pending = B.queue(t).where(Q.is_pending()).select("listing_id")
    return batch_numbers(pending, "listing_id", fixed.FETCH_BATCH).groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("listing_id").alias("first_id"), F.max("listing_id").alias("last_id")
    )


@query("A7", """
  SELECT run::VARCHAR AS run, count(*) FILTER (outcome = 'discovered') AS discovered, count(http_status) AS fetched,
         count(*) FILTER (outcome = 'parsed') AS parsed, count(*) FILTER (outcome = 'failed') AS failed,
         count(*) FILTER (outcome = 'blocked') AS blocked, count(*) FILTER (outcome = 'duplicate') AS duplicates
  FROM outs GROUP BY 1""", "outs")
def run_counters_per_day(t):
    return run_counters(B.outcomes(t), "run")


@query("A8", "SELECT run::VARCHAR AS run, http_status, count(*) AS n FROM outs WHERE http_status IS NOT NULL GROUP BY 1, 2", "outs")
def http_status_histogram(t):
    return status_histogram(B.outcomes(t), "run")


@query("A8", """
  SELECT run::VARCHAR AS run, '{' || string_agg('"' || http_status || '":' || n, ',' ORDER BY http_status) || '}' AS status_codes
  FROM (SELECT run, http_status, count(*) AS n FROM outs WHERE http_status IS NOT NULL GROUP BY 1, 2) q GROUP BY 1""", "outs")
def http_status_maps(t):
    return status_map(B.outcomes(t), "run").select("run", F.to_json("status_codes").alias("status_codes"))


@query("A9", """
  SELECT run::VARCHAR AS run, error_count, recency, "at", listing_id, error FROM (
    SELECT *, count(*) OVER (PARTITION BY run) AS error_count, row_number() OVER (PARTITION BY run ORDER BY "at" DESC, listing_id DESC) AS recency
    FROM outs WHERE error IS NOT NULL) q WHERE recency <= 10""", "outs")
def recent_errors_per_run(t):
    return recent_errors(B.outcomes(t), "run").withColumn("recency", F.col("recency").cast("bigint"))


@query("A11 P6", """
  SELECT CAST(fetched_at AS DATE)::VARCHAR AS day, count(*) AS fetches FROM obs GROUP BY 1""", "obs")
def fetches_per_day(t):
    return B.observations(t).groupBy(F.to_date("fetched_at").alias("day")).agg(F.count(F.lit(1)).alias("fetches"))


@query("P6 A11", "SELECT count(*) AS fetches FROM obs WHERE CAST(fetched_at AS DATE) = DATE '2024-01-30'", "obs")
def fetches_on_day(t):
    from motorlake.functions.dates import on_day
    return B.observations(t).where(on_day(F.col("fetched_at"), F.lit(B.AS_OF))).agg(F.count(F.lit(1)).alias("fetches"))

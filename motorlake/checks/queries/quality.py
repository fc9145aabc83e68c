"""Quality checks, on sound tables and on deliberately damaged ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.oracle import LOCATION, SELLER, VEHICLE, view
from motorlake.checks.registry import query
from motorlake.operators import quality as Q
from motorlake.operators.joins import orphans
from motorlake.plans import gold as G
from motorlake.plans import silver as S
from motorlake.plans import verify as V
from motorlake.sources.pages import page_metadata

# -- damaged copies, twice -------------------------------------------------------

view("bad_facts", "facts", """
  SELECT CASE WHEN photo_count % 17 = 0 THEN 20991231 ELSE date_key END AS date_key,
         CASE WHEN photo_count % 13 = 0 THEN NULL ELSE listing_id END AS listing_id,
         CASE WHEN photo_count % 11 = 0 THEN -1 ELSE location_key END AS location_key, vehicle_key,
         CASE WHEN photo_count % 19 = 0 THEN NULL ELSE seller_key END AS seller_key, price_kzt, is_active FROM facts""")
view("bad_loc", "loc", """
  SELECT location_key, CASE WHEN location_key % 4 = 0 THEN NULL ELSE region END AS region,
         CASE WHEN location_key % 2 = 0 THEN 'city' ELSE city END AS city FROM loc""")
view("bad_veh", "veh", """
  SELECT vehicle_key % 50 AS vehicle_key, make, CASE WHEN car_year > 2030 THEN NULL ELSE model END AS model, generation, trim,
         2000 AS car_year, body_type, CAST(NULL AS VARCHAR) AS engine_type, engine_volume_l, transmission, drivetrain, steering, color FROM veh""")


def _damaged(t):
    sv = B.silver(t)
    g = B.build(G.empty_gold(t.spark), sv, B.calendar(t)).written()
    n = F.col("photo_count")
    facts = g.fact_listing_daily.select(
        F.when(n % 17 == 0, 20991231).otherwise(F.col("date_key")).alias("date_key"),
        F.when(n % 13 != 0, F.col("listing_id")).alias("listing_id"),
        F.when(n % 11 == 0, -1).otherwise(F.col("location_key")).alias("location_key"), "vehicle_key",
        F.when(n % 19 != 0, F.col("seller_key")).alias("seller_key"), "price_kzt", "is_active",
    )
    loc = g.dim_location.select(
        "location_key", F.when(F.col("location_key") % 4 != 0, F.col("region")).alias("region"),
        F.when(F.col("location_key") % 2 == 0, "city").otherwise(F.col("city")).alias("city"),
    )
    veh = (
        g.dim_vehicle.withColumn("vehicle_key", F.col("vehicle_key") % 50)
        .withColumn("model", F.when(F.col("car_year") <= 2030, F.col("model")))
        .withColumn("car_year", F.lit(2000)).withColumn("engine_type", F.lit(None).cast("string"))
    )
    return g.tables() | {
        "fact_listing_daily": facts, "dim_location": loc, "dim_vehicle": veh,
        "listing_current": sv.current, "listing_snapshot_daily": sv.snapshots,
    }


_NAMES = {
    "fact_listing_daily": "bad_facts", "fact_price_event": "pfacts", "dim_date": "cal", "dim_vehicle": "bad_veh",
    "dim_location": "bad_loc", "dim_seller": "sel", "listing_current": "cur", "listing_snapshot_daily": "snap",
}
_ALL = " ".join(_NAMES.values())


def _row(check: str, table: str, count: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, CAST(n AS DOUBLE) AS value, 0.0::DOUBLE AS threshold, "
        f"'max' AS direction, 'error' AS level, n = 0 AS passed FROM (SELECT count(*) AS n FROM {count}) q"
    )


def _not_null_sql() -> str:
    plain = {
        "fact_listing_daily": "date_key listing_id location_key vehicle_key seller_key is_active", "fact_price_event": "listing_id event_ts date_key",
        "dim_date": "date_key d", "dim_vehicle": "vehicle_key make model", "dim_location": "location_key city", "dim_seller": "seller_key",
        "listing_current": "listing_id is_active", "listing_snapshot_daily": "listing_id snapshot_date is_active",
    }
    active = {"fact_listing_daily": "price_kzt", "listing_current": "price_kzt make model"}
    rows = [_row(f"not_null_{c}", n, f"{_NAMES[n]} WHERE {c} IS NULL") for n, cs in plain.items() for c in cs.split()]
    rows += [_row(f"not_null_{c}", n, f"{_NAMES[n]} WHERE {c} IS NULL AND is_active") for n, cs in active.items() for c in cs.split()]
    return " UNION ALL ".join(rows)


def _unique_row(table: str, columns: list[str], where: str = "TRUE") -> str:
    names = ", ".join(columns)
    return _row("unique_" + "_".join(columns), table, f"(SELECT 1 FROM {_NAMES[table]} WHERE {where} GROUP BY {names} HAVING count(*) > 1) g")


def _orphan_row(child: str, column: str, parent: str, parent_column: str) -> str:
    a, b = _NAMES[child], _NAMES[parent]
    return _row(f"relationship_{column}", child, f"{a} c WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {b} p WHERE p.{parent_column} = c.{column})")


_RELATIONSHIPS_SQL = " UNION ALL ".join([
    _orphan_row("fact_listing_daily", "date_key", "dim_date", "date_key"),
    _orphan_row("fact_listing_daily", "location_key", "dim_location", "location_key"),
    _orphan_row("fact_listing_daily", "vehicle_key", "dim_vehicle", "vehicle_key"),
    _orphan_row("fact_listing_daily", "seller_key", "dim_seller", "seller_key"),
    _orphan_row("fact_price_event", "date_key", "dim_date", "date_key"),
])


@query("Q3", _not_null_sql(), _ALL)
def quality_not_null(t):
    return V.not_null_results(_damaged(t))


@query("Q4 A12", " UNION ALL ".join([
    _unique_row("dim_date", ["date_key"]), _unique_row("dim_date", ["d"]), _unique_row("dim_vehicle", ["vehicle_key"]),
    _unique_row("dim_location", ["location_key"]), _unique_row("dim_seller", ["seller_key"]), _unique_row("listing_current", ["listing_id"]),
]), _ALL)
def quality_unique(t):
    return V.unique_results(_damaged(t))


@query("Q4 K1", " UNION ALL ".join([
    _unique_row("fact_listing_daily", ["date_key", "listing_id"]), _unique_row("fact_price_event", ["listing_id", "event_ts"]),
    _unique_row("listing_snapshot_daily", ["listing_id", "snapshot_date"]),
    _row("unique_listing_id_fetched_at", "raw_listing_html", "(SELECT 1 FROM pages WHERE page_id % 10 = 4) g"),
]), _ALL)
def quality_primary_keys(t):
    """Raw pages too: every tenth of them is there twice."""
    tables, pages = _damaged(t), B.fetched_pages(t)
    raw = page_metadata(pages.unionByName(pages.where("listing_id % 10 = 4")), "raw-html")
    names = ("fact_listing_daily", "fact_price_event", "listing_snapshot_daily")
    return V.primary_key_results({n: tables[n] for n in names} | {"raw_listing_html": raw})


@query("Q5", " UNION ALL ".join([_unique_row("dim_location", LOCATION), _unique_row("dim_vehicle", VEHICLE), _unique_row("dim_seller", SELLER)]), _ALL)
def quality_business_keys(t):
    return V.business_key_results(_damaged(t))


@query("A12", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_key_groups(t):
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("Q6 J9", _RELATIONSHIPS_SQL, _ALL)
def quality_relationships(t):
    return V.relationship_results(_damaged(t))


@query("J9", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def orphan_rows(t):
    parents = t.customer.where("c_acctbal > 0")
    return orphans(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


@query("Q7", "SELECT 'accepted_values_event_type' AS check_name, 'events' AS table_name, CAST(count(*) FILTER (event_type NOT IN ('click', 'view')) AS DOUBLE) AS value, 0.0::DOUBLE AS threshold, 'max' AS direction, 'error' AS level, count(*) FILTER (event_type NOT IN ('click', 'view')) = 0 AS passed FROM events")
def quality_accepted_event_types(t):
    return Q.run_thresholds(t.events, [Q.accepted_values("events", "event_type", ["click", "view"])])


@query("Q7", " UNION ALL ".join(_row("accepted_values_is_active", n, f"{_NAMES[n]} WHERE is_active NOT IN (TRUE, FALSE)") for n in ("fact_listing_daily", "listing_current", "listing_snapshot_daily")), _ALL)
def quality_accepted_values(t):
    return V.accepted_value_results(_damaged(t))


def _suite_sql(level: str) -> str:
    low = "'min' AS direction, 'warning' AS level, TRUE AS passed"
    return f"""
      SELECT 'Bronze rows today' AS check_name, 'raw_listing_html' AS table_name, CAST(count(*) AS DOUBLE) AS value, 0.0::DOUBLE AS threshold, {low}
      FROM obs WHERE CAST(fetched_at AS DATE) = DATE '2024-01-30'
      UNION ALL SELECT 'Silver snapshots today', 'listing_snapshot_daily', count(*), 0.0, 'min', 'warning', TRUE FROM snap WHERE snapshot_date = DATE '2024-01-30'
      UNION ALL SELECT 'Gold facts today', 'fact_listing_daily', count(*), 0.0, 'min', 'warning', TRUE FROM facts WHERE date_key = 20240130
      UNION ALL SELECT 'Price Null Ratio (Max)', 'listing_current', r, 0.5, 'max', '{level}', r <= 0.5 FROM (
        SELECT CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST(count(*) FILTER (price_kzt IS NULL) AS DOUBLE) / count(*) END AS r FROM cur WHERE is_active) q
      UNION ALL SELECT 'Missing make/model (should be 0)', 'listing_current', count(*), 0.0, 'max', '{level}', count(*) = 0 FROM cur WHERE make IS NULL OR model IS NULL"""


def _suite(t, level):
    sv = B.silver(t)
    facts = B.build(G.empty_gold(t.spark), sv, B.calendar(t)).fact_listing_daily
    return V.run_suite(B.observations(t), sv, facts, B.AS_OF, level)


@query("Q1 P6 P7 P8 A2 A11", _suite_sql("error"), "obs snap facts cur")
def quality_run_suite(t):
    return _suite(t, "error")


@query("Q2", _suite_sql("warning"), "obs snap facts cur")
def quality_relaxed_suite(t):
    return _suite(t, "warning")


@query("A2", "SELECT CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST(count(*) FILTER (price_kzt IS NULL) AS DOUBLE) / count(*) END AS ratio FROM cur WHERE is_active", "cur")
def price_null_ratio(t):
    return B.silver(t).current.agg(Q.null_ratio("price_kzt", F.col("is_active")).alias("ratio"))


@query("Q8 A1 A4 A5 L1", """
  SELECT 'rows' AS probe, 'dim_date' AS label, count(*) AS value FROM cal UNION ALL SELECT 'rows', 'dim_location', count(*) FROM loc
  UNION ALL SELECT 'rows', 'dim_vehicle', count(*) FROM veh UNION ALL SELECT 'rows', 'dim_seller', count(*) FROM sel
  UNION ALL SELECT 'rows', 'fact_listing_daily', count(*) FROM facts UNION ALL SELECT 'rows', 'fact_price_event', count(*) FROM pfacts
  UNION ALL SELECT 'unique_listings', 'fact_listing_daily', count(DISTINCT listing_id) FROM facts
  UNION ALL SELECT 'latest_date_key', 'fact_listing_daily', max(date_key) FROM facts
  UNION ALL (SELECT 'top_make', v.make, count(*) AS n FROM facts f JOIN veh v USING (vehicle_key) GROUP BY v.make ORDER BY n DESC, v.make LIMIT 5)""", "facts pfacts")
def published_copy_report(t):
    return V.publish_report(B.gold(t).written())


@query("Q9", "SELECT event_id, event_type = 'signup' AS no_id, event_type = 'error' AS no_time FROM events WHERE event_type IN ('signup', 'error')")
def rejected_records(t):
    kind = F.col("event_type")
    rows = t.events.select(
        "event_id", F.when(kind != "signup", F.col("user_id")).alias("listing_id"), F.when(kind != "error", F.col("ts")).alias("fetched_at")
    )
    _, rejected = S.split_valid(rows)
    return rejected.select("event_id", F.col("listing_id").isNull().alias("no_id"), F.col("fetched_at").isNull().alias("no_time"))

"""Gold tables: dimensions, keys, facts, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.oracle import AS_OF, LOCATION, SELLER, VEHICLE, star
from motorlake.checks.registry import query
from motorlake.functions.dates import date_key
from motorlake.operators.joins import keys_match, lookup_key
from motorlake.operators.latest import first_in_order
from motorlake.plans import gold as G
from motorlake.plans.silver import Silver
from motorlake.plans.verify import top_makes
from motorlake.sources.calendar import calendar_around
from motorlake.session import staged
from motorlake.sources.tables import row_counts

_FACT = "date_key, listing_id, location_key, vehicle_key, seller_key, CAST(price_kzt AS DOUBLE) AS price_kzt, is_active, days_on_site, views, photo_count"
_VEHICLE_SQL = ", ".join(c if c != "engine_volume_l" else "CAST(engine_volume_l AS DOUBLE) AS engine_volume_l" for c in VEHICLE)


def _current(t, where=None):
    return B.SilverLake(t, where).current


def _first_dimensions(t):
    """Dimensions of the state at SPLIT."""
    return B.dimensions(t, _current(t, B.before_split()))


@query("S5", """
  SELECT c.date_key, c.d::VARCHAR AS d, c.year::INTEGER AS year, c.quarter::INTEGER AS quarter, c.month::INTEGER AS month,
         c.day_of_week::INTEGER AS day_of_week, count(o.event_id) AS observations
  FROM cal c LEFT JOIN obs o ON CAST(o.fetched_at AS DATE) = c.d GROUP BY ALL""", "cal obs")
def calendar_days(t):
    """The generated calendar with the observations of each day."""
    per_day = B.observations(t).groupBy(F.to_date("fetched_at").alias("d")).agg(F.count(F.lit(1)).alias("observations"))
    joined = calendar_around(t.spark, B.AS_OF).join(per_day, "d", "left")
    return joined.withColumn("observations", F.coalesce("observations", F.lit(0)))


@query("M9", """
  SELECT date_key, d::VARCHAR AS d, day_of_week::INTEGER AS day_of_week FROM cal
  UNION ALL
  SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER), CAST(o_orderdate AS DATE)::VARCHAR, CAST(isodow(o_orderdate) AS INTEGER)
  FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM cal)""", "cal")
def calendar_insert_if_absent(t):
    """A calendar that already holds the order days grows by the new days."""
    day = F.to_date("o_orderdate")
    order_days = t.orders.select(day.alias("d")).distinct()
    from motorlake.functions.dates import calendar_parts
    known = order_days.select(date_key(F.col("d")).alias("date_key"), "d", *[c.alias(n) for n, c in calendar_parts(F.col("d")).items()])
    return G.grow_calendar(known, B.calendar(t)).select("date_key", "d", "day_of_week")


@query("P1 A3", "SELECT DISTINCT region, city FROM cur WHERE city IS NOT NULL", "cur")
def location_source_rows(t):
    return G.location_rows(_current(t))


@query("P2 A3", f"SELECT DISTINCT {_VEHICLE_SQL} FROM cur WHERE make IS NOT NULL AND model IS NOT NULL", "cur")
def vehicle_source_rows(t):
    return G.vehicle_rows(_current(t))


@query("A3", "SELECT DISTINCT seller_type, seller_name, seller_user_id, city FROM cur", "cur")
def seller_source_rows(t):
    return G.seller_rows(_current(t))


@query("M10 W6", "SELECT location_key, region, city FROM loc_b", "loc_b")
def location_insert_if_absent(t):
    first = _first_dimensions(t).dim_location
    return G.grow_dimension(first, G.location_rows(_current(t)), LOCATION, "location_key")


@query("M11 W6", f"SELECT vehicle_key, {_VEHICLE_SQL} FROM veh_b", "veh_b")
def vehicle_insert_if_absent(t):
    first = _first_dimensions(t).dim_vehicle
    return G.grow_dimension(first, G.vehicle_rows(_current(t)), VEHICLE, "vehicle_key")


@query("M12 W6", "SELECT seller_key, seller_type, seller_name, seller_user_id, city FROM sel_b", "sel_b")
def seller_insert_if_absent(t):
    first = _first_dimensions(t).dim_seller
    return G.grow_dimension(first, G.seller_rows(_current(t)), SELLER, "seller_key")


@query("W6", """
  SELECT row_number() OVER (ORDER BY md5(concat_ws(chr(31), '+' || p_brand, '+' || p_name, '+' || p_type, '+' || CAST(p_size AS VARCHAR)))) AS part_type_key,
         p_brand, p_name, p_type, p_size FROM (SELECT DISTINCT p_brand, p_name, p_type, p_size FROM part) q""")
def surrogate_keys(t):
    from motorlake.operators.numbering import dense_index
    columns = ["p_brand", "p_name", "p_type", "p_size"]
    return dense_index(t.part.select(*columns).distinct(), columns, "part_type_key")


@query("J2", "SELECT s.listing_id, c.date_key, c.day_of_week::INTEGER AS day_of_week FROM snap s JOIN cal c ON c.d = s.snapshot_date", "snap cal")
def snapshots_with_calendar(t):
    days = B.calendar(t).select("date_key", F.col("d").alias("snapshot_date"), "day_of_week")
    return B.silver(t).snapshots.join(F.broadcast(days), "snapshot_date").select("listing_id", "date_key", "day_of_week")


@query("J3 P9", "SELECT s.listing_id, l.location_key FROM cur s JOIN loc l ON l.city = s.city AND l.region IS NOT DISTINCT FROM s.region", "cur loc")
def location_key_lookup(t):
    current = _current(t)
    dim = B.dimensions(t, current).dim_location
    return lookup_key(current.where("city IS NOT NULL"), dim, LOCATION, "location_key").select("listing_id", "location_key")


@query("J4 P9", "SELECT s.listing_id, v.vehicle_key FROM cur s JOIN veh v ON " + " AND ".join(f"v.{c} IS NOT DISTINCT FROM s.{c}" for c in VEHICLE), "cur veh")
def vehicle_key_lookup(t):
    current = _current(t)
    dim = B.dimensions(t, current).dim_vehicle
    return lookup_key(current, dim, VEHICLE, "vehicle_key").select("listing_id", "vehicle_key")


@query("J5 P9", "SELECT s.listing_id, v.seller_key FROM cur s JOIN sel v ON " + " AND ".join(f"v.{c} IS NOT DISTINCT FROM s.{c}" for c in SELLER), "cur sel")
def seller_key_lookup(t):
    current = _current(t)
    dim = B.dimensions(t, current).dim_seller
    return current.alias("s").join(dim.alias("d"), keys_match("s", "d", [], SELLER)).select("listing_id", "seller_key")


@query("J11", f"SELECT {_FACT} FROM facts", "facts")
def star_resolve(t):
    sv = B.silver(t)
    dims = B.dimensions(t, sv.current)
    keys = G.listing_keys(sv.current, dims.dim_location, dims.dim_vehicle, dims.dim_seller)
    return G.resolve_star(sv.snapshots, keys, dims.dim_date)


@query("W1 X13", """
  SELECT DISTINCT ON (listing_id, snapshot_date) listing_id, snapshot_date::VARCHAR AS snapshot_date,
         CAST(price_kzt AS DOUBLE) AS price_kzt, is_active, photo_count
  FROM wide ORDER BY listing_id, snapshot_date, price_kzt DESC NULLS LAST, photo_count DESC NULLS LAST, is_active DESC""", "wide")
def first_snapshot_per_day(t):
    order = [F.desc_nulls_last("price_kzt"), F.desc_nulls_last("photo_count"), F.desc("is_active")]
    return first_in_order(B.wide_snapshots(t), ["listing_id", "snapshot_date"], order).drop("views")


@query("J11 W1", f"""
  SELECT DISTINCT ON (date_key, listing_id) {_FACT} FROM ({star("wide", "cur", "", "calw")}) q
  ORDER BY date_key, listing_id, q.price_kzt DESC NULLS LAST, photo_count DESC NULLS LAST, is_active DESC""",
  "calw cur loc veh sel")
def star_resolve_unkeyed_snapshots(t):
    """Snapshots with several rows a day, on days far outside the calendar, which grows by them."""
    current, wide = _current(t), B.wide_snapshots(t)
    dims = B.dimensions(t, current)
    days = G.grow_calendar(dims.dim_date, G.snapshot_days(wide))
    keys = G.listing_keys(current, dims.dim_location, dims.dim_vehicle, dims.dim_seller)
    return G.resolve_star(wide, keys, days, distinct_on=True)


@query("J11", """
  SELECT CASE WHEN s.listing_id IS NULL THEN 'unknown listing' WHEN s.city IS NULL THEN 'no city'
              WHEN s.make IS NULL OR s.model IS NULL THEN 'no make or model' ELSE 'day outside the calendar' END AS reason, count(*) AS n
  FROM wide w LEFT JOIN cur s ON s.listing_id = w.listing_id
  WHERE s.listing_id IS NULL OR s.city IS NULL OR s.make IS NULL OR s.model IS NULL OR w.snapshot_date NOT IN (SELECT d FROM cal) GROUP BY 1""", "wide cur cal")
def wide_snapshots_without_facts(t):
    """What the star joins leave out under the plain calendar, by reason."""
    return G.dropped_snapshots(B.wide_snapshots(t), _current(t), B.calendar(t))


@query("M13", f"SELECT {_FACT} FROM facts_b", "facts_b")
def fact_upsert_with_sticky_keys(t):
    """Facts of the first build keep their dimension keys in the second."""
    first = B.build(G.empty_gold(t.spark), B.silver_at_split(t), B.calendar(t))
    return B.build(first, B.silver(t), B.calendar(t)).fact_listing_daily


@query("M14 D1", "SELECT event_ts, date_key, listing_id, CAST(old_price_kzt AS DOUBLE) AS old_price_kzt, CAST(new_price_kzt AS DOUBLE) AS new_price_kzt FROM pfacts", "pfacts")
def price_fact_insert(t):
    events = B.silver(t).price_events
    first = G.price_event_facts(events.where(F.col("event_ts") < F.lit(B.SPLIT).cast("timestamp")))
    return G.insert_price_facts(first, events)


@query("M17", f"SELECT {_FACT} FROM facts", "facts")
def gold_full_refresh(t):
    """A second full build on its own result changes nothing."""
    sv, days = B.silver(t), B.calendar(t)
    silver = Silver(sv.current, staged(sv.snapshots, "snapshots"), staged(sv.price_events, "events"))
    once = G.build_gold(G.empty_gold(t.spark), silver, days)
    stored = G.Gold(**{name: staged(df, name) for name, df in once.tables().items()})
    return G.build_gold(stored, silver, days).fact_listing_daily


@query("P10", "SELECT date_key, listing_id, vehicle_key, location_key, seller_key, CAST(price_kzt AS DOUBLE) AS price_kzt, days_on_site, views, photo_count, CAST(NULL AS INTEGER) AS y_sold_30d_proxy FROM facts", "facts")
def ml_feature_rows(t):
    G.create_feature_view(B.gold(t).fact_listing_daily)
    return t.spark.table("ml_features_listing_day")


@query("P7", f"SELECT listing_id, CAST(price_kzt AS DOUBLE) AS price_kzt FROM facts WHERE date_key = 20240130", "facts")
def facts_on_day(t):
    facts = B.gold(t).fact_listing_daily
    return facts.where(F.col("date_key") == date_key(F.lit(B.AS_OF))).select("listing_id", "price_kzt")


@query("P8", "SELECT listing_id, make, model FROM cur WHERE make IS NULL OR model IS NULL", "cur")
def missing_make_or_model(t):
    return _current(t).where(F.col("make").isNull() | F.col("model").isNull()).select("listing_id", "make", "model")


@query("A1", """
  SELECT 'dim_date' AS table_name, count(*) AS row_count FROM cal UNION ALL SELECT 'dim_location', count(*) FROM loc
  UNION ALL SELECT 'dim_vehicle', count(*) FROM veh UNION ALL SELECT 'dim_seller', count(*) FROM sel
  UNION ALL SELECT 'fact_listing_daily', count(*) FROM facts UNION ALL SELECT 'fact_price_event', count(*) FROM pfacts""", "facts pfacts")
def gold_row_counts(t):
    return row_counts(B.gold(t).tables())


@query("A4", "SELECT count(DISTINCT listing_id) AS unique_listings FROM facts", "facts")
def distinct_fact_listings(t):
    return B.gold(t).fact_listing_daily.agg(F.count_distinct("listing_id").alias("unique_listings"))


@query("A4", "SELECT year(l_shipdate)::INTEGER AS ship_year, count(DISTINCT l_partkey) AS unique_listings FROM lineitem GROUP BY 1")
def distinct_listings_per_year(t):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("ship_year")).agg(F.count_distinct("l_partkey").alias("unique_listings"))


@query("A5", "SELECT max(date_key) AS latest_date_key FROM facts", "facts")
def latest_date_key(t):
    return B.gold(t).fact_listing_daily.agg(F.max("date_key").alias("latest_date_key"))


@query("A6 J10", "SELECT v.make, count(*) AS n FROM facts f JOIN veh v USING (vehicle_key) GROUP BY 1", "facts veh")
def facts_per_make(t):
    g = B.gold(t)
    return g.fact_listing_daily.join(g.dim_vehicle.select("vehicle_key", "make"), "vehicle_key").groupBy("make").agg(F.count(F.lit(1)).alias("n"))


@query("L1 J10", "SELECT v.make, count(*) AS n FROM facts f JOIN veh v USING (vehicle_key) GROUP BY 1 ORDER BY n DESC, make LIMIT 5", "facts veh")
def top_makes_by_facts(t):
    g = B.gold(t)
    return top_makes(g.fact_listing_daily, g.dim_vehicle)


@query("L1", "SELECT p_brand AS make, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, make LIMIT 5")
def top_makes_by_wide_snapshots(t):
    dim = t.part.select(F.col("p_partkey").alias("vehicle_key"), F.col("p_brand").alias("make"))
    return top_makes(t.lineitem.select(F.col("l_partkey").alias("vehicle_key")), dim)


@query("L2", f"SELECT {_FACT} FROM facts ORDER BY date_key, listing_id LIMIT 3", "facts")
def fact_sample(t):
    return B.gold(t).fact_listing_daily.orderBy("date_key", "listing_id").limit(3)


@query("D3", "SELECT listing_id, d::VARCHAR AS d, days_on_site FROM (SELECT f.listing_id, c.d, f.days_on_site FROM facts f JOIN cal c USING (date_key)) q", "facts cal")
def days_on_site(t):
    from motorlake.functions.dates import days_on_site as days
    sv = B.silver(t)
    g = B.build(G.empty_gold(t.spark), sv, B.calendar(t))
    listed = g.fact_listing_daily.select("date_key", "listing_id").join(F.broadcast(g.dim_date.select("date_key", "d")), "date_key")
    return listed.join(sv.current.select("listing_id", "first_seen_at"), "listing_id").select(
        "listing_id", "d", days(F.col("d"), F.col("first_seen_at")).alias("days_on_site")
    )


@query("X11", "SELECT count(*) AS dropped FROM snap s JOIN cur c USING (listing_id) WHERE c.city IS NULL OR c.make IS NULL OR c.model IS NULL", "snap cur")
def snapshots_without_facts(t):
    """Snapshots dropped by the star joins, counted."""
    sv = B.silver(t)
    g = B.build(G.empty_gold(t.spark), sv, B.calendar(t))
    lost = sv.snapshots.withColumn("date_key", date_key(F.col("snapshot_date"))).join(
        g.fact_listing_daily.select("date_key", "listing_id"), ["date_key", "listing_id"], "left_anti"
    )
    return lost.agg(F.count(F.lit(1)).alias("dropped"))

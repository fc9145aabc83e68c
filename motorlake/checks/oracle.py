"""SQL twins of the domain views, for an independent check in another engine.

``with_views(sql, 'facts')`` prefixes the CTEs a query needs, in order.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-30'"
SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"
NOW = "TIMESTAMP '2024-01-30 00:00:00'"
BASE = "https://cars.example"

# White space as the text functions see it.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: str, sql: str) -> None:
    _VIEWS[name] = (tuple(deps.split()), sql)


def with_views(sql: str, views: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in _VIEWS[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in views.split():
        visit(name)
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name][1]})" for name in order)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def digest(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce('+' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"md5(concat_ws(chr(31), {parts}))"


LOCATION = ["region", "city"]
VEHICLE = [
    "make", "model", "generation", "trim", "car_year", "body_type", "engine_type", "engine_volume_l",
    "transmission", "drivetrain", "steering", "color",
]
SELLER = ["seller_type", "seller_name", "seller_user_id", "city"]

view("obs", "", """
  SELECT event_id, user_id AS listing_id, ts AS fetched_at,
         CASE WHEN event_type <> 'signup' THEN CAST(value AS DECIMAL(14,2)) END AS price_kzt,
         CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS http_status,
         CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS photo_count,
         event_type AS kind
  FROM events""")

view("attrs", "", """
  SELECT p_partkey AS listing_id,
         CASE WHEN p_partkey % 31 <> 5 THEN p_brand END AS make,
         split_part(p_name, ' ', 2) AS model, split_part(p_name, ' ', 1) AS trim,
         p_size + 1990 AS car_year,
         CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS body_type,
         CAST(CAST(p_size AS DECIMAL(10,1)) / 10 AS DECIMAL(3,1)) AS engine_volume_l,
         CASE p_size % 3 WHEN 1 THEN 'petrol' WHEN 2 THEN 'diesel' END AS engine_type,
         CASE WHEN p_size % 2 = 0 THEN 'auto' ELSE 'manual' END AS transmission,
         'left' AS steering,
         CAST(p_partkey * 10 % 300000 AS INTEGER) AS mileage_km,
         CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS customs_cleared,
         lower(c_mktsegment) AS seller_type,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_name END AS seller_name
  FROM part LEFT JOIN customer ON c_custkey = p_partkey""")

view("places", "", """
  SELECT n_nationkey AS place, n_name AS city, CASE WHEN r_regionkey <> 0 THEN r_name END AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey""")

view("records", "obs attrs places", f"""
  SELECT o.listing_id, o.fetched_at, o.http_status,
         '{BASE}/a/show/' || o.listing_id AS url,
         concat_ws(' ', a.make, a.model, a.trim) AS title,
         o.price_kzt,
         CASE WHEN o.listing_id % 29 <> 7 THEN p.city END AS city, p.region,
         a.make, a.model, CAST(NULL AS VARCHAR) AS generation, a.trim, a.car_year, a.mileage_km, a.body_type,
         a.engine_volume_l, a.engine_type, a.transmission, CAST(NULL AS VARCHAR) AS drivetrain, a.steering,
         CAST(NULL AS VARCHAR) AS color, a.customs_cleared, a.seller_name, a.seller_type,
         CAST(NULL AS BIGINT) AS seller_user_id, o.photo_count
  FROM obs o JOIN attrs a USING (listing_id)
  JOIN places p ON p.place =
    (o.listing_id + CASE WHEN o.listing_id % 5 = 0 AND o.fetched_at >= {SPLIT} THEN 1 ELSE 0 END) % 25""")


def _silver(suffix: str, where: str) -> None:
    view(f"seen{suffix}", "records", f"SELECT * FROM records WHERE {where}")
    view(f"cur{suffix}", f"seen{suffix}", f"""
      SELECT g.* EXCLUDE (rn, http_status, fetched_at, photo_count), g.first_at AS first_seen_at,
             g.fetched_at AS last_seen_at,
             NOT EXISTS (SELECT 1 FROM seen{suffix} x WHERE x.listing_id = g.listing_id
                         AND x.http_status = 404 AND x.fetched_at > g.fetched_at) AS is_active
      FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY fetched_at DESC) AS rn,
                   min(fetched_at) OVER (PARTITION BY listing_id) AS first_at
            FROM seen{suffix} WHERE http_status < 400) g
      WHERE rn = 1""")
    view(f"snap{suffix}", f"seen{suffix}", f"""
      SELECT g.listing_id, g.day AS snapshot_date, g.price_kzt,
             NOT EXISTS (SELECT 1 FROM seen{suffix} x WHERE x.listing_id = g.listing_id
                         AND x.http_status = 404 AND x.fetched_at > g.fetched_at
                         AND CAST(x.fetched_at AS DATE) = g.day) AS is_active,
             CAST(NULL AS BIGINT) AS views, g.photo_count
      FROM (SELECT *, CAST(fetched_at AS DATE) AS day,
                   row_number() OVER (PARTITION BY listing_id, CAST(fetched_at AS DATE) ORDER BY fetched_at DESC) AS rn
            FROM seen{suffix} WHERE http_status < 400) g
      WHERE rn = 1""")
    view(f"pevents{suffix}", f"seen{suffix}", f"""
      SELECT listing_id, fetched_at AS event_ts, old_price_kzt, price_kzt AS new_price_kzt
      FROM (SELECT *, lag(price_kzt) OVER (PARTITION BY listing_id ORDER BY fetched_at) AS old_price_kzt
            FROM seen{suffix} WHERE http_status < 400) q
      WHERE old_price_kzt <> price_kzt""")


_silver("", "TRUE")
_silver("_a", f"fetched_at < {SPLIT}")

view("cal", "", f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS d, year(d) AS year,
         quarter(d) AS quarter, month(d) AS month, isodow(d) AS day_of_week
  FROM generate_series(CAST({AS_OF} - 365 AS TIMESTAMP), CAST({AS_OF} + 365 AS TIMESTAMP), INTERVAL 1 DAY) g(d)""")


def _dims(suffix: str) -> None:
    for name, key, cols, where in [
        ("loc", "location_key", LOCATION, "city IS NOT NULL"),
        ("veh", "vehicle_key", VEHICLE, "make IS NOT NULL AND model IS NOT NULL"),
        ("sel", "seller_key", SELLER, "TRUE"),
    ]:
        names = ", ".join(cols)
        view(f"{name}{suffix}", f"cur{suffix}", f"""
          SELECT row_number() OVER (ORDER BY {digest(cols)}) AS {key}, {names}
          FROM (SELECT DISTINCT {names} FROM cur{suffix} WHERE {where}) q""")


_dims("")
_dims("_a")

# Dimensions after the second step: old keys stay, new rows are numbered above them.
for _name, _key, _cols, _where in [
    ("loc", "location_key", LOCATION, "city IS NOT NULL"),
    ("veh", "vehicle_key", VEHICLE, "make IS NOT NULL AND model IS NOT NULL"),
    ("sel", "seller_key", SELLER, "TRUE"),
]:
    _list = ", ".join(_cols)
    _same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in _cols)
    view(f"{_name}_b", f"cur {_name}_a", f"""
      SELECT {_key}, {_list} FROM {_name}_a
      UNION ALL
      SELECT (SELECT max({_key}) FROM {_name}_a) + row_number() OVER (ORDER BY {digest(_cols)}), {_list}
      FROM (SELECT DISTINCT {_list} FROM cur WHERE {_where}) n
      WHERE NOT EXISTS (SELECT 1 FROM {_name}_a o WHERE {_same})""")


def star(snap: str, cur: str, suffix: str, cal: str = "cal") -> str:
    vehicle = " AND ".join(f"dv.{c} IS NOT DISTINCT FROM s.{c}" for c in VEHICLE[2:])
    seller = " AND ".join(f"ds.{c} IS NOT DISTINCT FROM s.{c}" for c in SELLER)
    return f"""
      SELECT dd.date_key, s.listing_id, dl.location_key, dv.vehicle_key, ds.seller_key, n.price_kzt, n.is_active,
             CAST(dd.d - CAST(s.first_seen_at AS DATE) AS INTEGER) AS days_on_site, n.views, n.photo_count
      FROM {snap} n JOIN {cur} s ON s.listing_id = n.listing_id
      JOIN {cal} dd ON dd.d = n.snapshot_date
      JOIN loc{suffix} dl ON dl.city = s.city AND dl.region IS NOT DISTINCT FROM s.region
      JOIN veh{suffix} dv ON dv.make = s.make AND dv.model = s.model AND {vehicle}
      JOIN sel{suffix} ds ON {seller}"""


view("facts", "snap cur cal loc veh sel", star("snap", "cur", ""))
view("facts_a", "snap_a cur_a cal loc_a veh_a sel_a", star("snap_a", "cur_a", "_a"))
view("facts_new", "snap cur cal loc_b veh_b sel_b", star("snap", "cur", "_b"))
# Second step: measures from the new rows, keys from the old ones where a row exists.
view("facts_b", "facts_a facts_new", """
  SELECT n.date_key, n.listing_id, coalesce(o.location_key, n.location_key) AS location_key,
         coalesce(o.vehicle_key, n.vehicle_key) AS vehicle_key, coalesce(o.seller_key, n.seller_key) AS seller_key,
         n.price_kzt, n.is_active, n.days_on_site, n.views, n.photo_count
  FROM facts_new n LEFT JOIN facts_a o USING (date_key, listing_id)""")
view("pfacts", "pevents", """
  SELECT event_ts, CAST(strftime(event_ts, '%Y%m%d') AS INTEGER) AS date_key, listing_id, old_price_kzt, new_price_kzt
  FROM pevents""")

view("ix", "", """
  SELECT page_id + 1 AS page_no, page_id % 97 = 96 AS is_empty,
         CASE WHEN page_id % 97 <> 96 THEN [page_id, page_id + 1, page_id * 3, page_id + 5] ELSE [] END AS ids
  FROM pages""")

view("fetched", "", """
  SELECT page_id AS listing_id, TIMESTAMP '2024-01-30 00:00:00' + to_seconds(page_id) AS fetched_at, url, html,
         CASE WHEN page_id % 11 = 10 THEN 404 ELSE 200 END AS http_status
  FROM pages""")

# What each payload shape means; the JSON itself is not parsed here.
view("vcounts", "", """
  SELECT event_id, user_id AS listing_id, CAST(event_id + CASE WHEN event_id % 7 = 0 THEN 3000000000 ELSE 0 END AS BIGINT) AS views
  FROM events WHERE event_id % 15 IN (0, 1, 2, 3, 4, 5)""")

view("outs", "obs", """
  SELECT CAST(fetched_at AS DATE) AS run, listing_id, fetched_at AS "at",
         CASE kind WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'blocked'
                   WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'discovered' ELSE 'duplicate' END ELSE 'parsed' END AS outcome,
         CASE WHEN kind IN ('click', 'purchase') THEN 200 WHEN kind = 'error' THEN 404 END AS http_status,
         CASE WHEN kind = 'error' THEN 'HTTP 404 for event ' || event_id END AS error
  FROM obs""")

view("que", "", f"""
  SELECT p_partkey AS listing_id, '{BASE}/a/show/' || p_partkey AS url,
         TIMESTAMP '2024-01-29 00:00:00' + to_minutes(p_size) AS discovered_at,
         CASE p_partkey % 4 WHEN 0 THEN 'NEW' WHEN 1 THEN 'RETRY' WHEN 2 THEN 'FETCHED' ELSE 'INACTIVE' END AS state,
         CAST(p_partkey % 15 AS INTEGER) AS attempts,
         CAST(NULL AS TIMESTAMP) AS last_attempt_at,
         CASE WHEN p_partkey % 4 = 1 THEN TIMESTAMP '2024-01-29 00:00:00' + to_hours(p_size) END AS next_retry_at,
         CASE p_partkey % 4 WHEN 2 THEN 200 WHEN 3 THEN 404 END AS last_http_status,
         CASE WHEN p_partkey % 4 = 1 THEN 'timeout' END AS last_error
  FROM part""")

view("runs", "obs", """
  SELECT listing_id,
         CASE kind WHEN 'error' THEN 'gone' WHEN 'signup' THEN 'blocked' WHEN 'view' THEN 'error' ELSE 'parsed' END AS outcome,
         CASE WHEN kind = 'view' THEN 'HTTP 503' END AS error
  FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY fetched_at DESC) AS rn FROM obs) q WHERE rn = 1""")

view("wide", "", """
  SELECT l_partkey AS listing_id, CAST(l_shipdate AS DATE) AS snapshot_date,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS price_kzt, l_linestatus = 'O' AS is_active,
         CAST(l_quantity AS BIGINT) AS views, l_linenumber AS photo_count
  FROM lineitem""")

# The calendar, grown by the days of those snapshots.
view("calw", "cal wide", """
  SELECT date_key, d FROM cal UNION SELECT CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER), snapshot_date FROM wide""")

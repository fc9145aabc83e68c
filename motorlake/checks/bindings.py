"""Listing-domain views over the given tables.

``events`` act as fetches of listings, ``part`` with ``nation``, ``region`` and
``customer`` give the listing attributes. Every view exists twice: as a
DataFrame here and as a SQL text in ``oracle_views``, written independently.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.functions import fixed
from motorlake.functions.text import listing_url
from motorlake.plans import gold as G
from motorlake.plans import silver as S
from motorlake.schemas import GOLD_ORDER, LOCATION_COLUMNS, PARSED, SELLER_COLUMNS, VEHICLE_COLUMNS
from motorlake.session import configure, staged
from motorlake.sources.calendar import calendar_around

AS_OF = dt.date(2024, 1, 30)
SPLIT = dt.datetime(2024, 1, 15)
BASE_URL = "https://cars.example"


class Tables:
    """The given tables of one folder; each is opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def observations(t: Tables) -> DataFrame:
    """Fetches: price unknown on 'signup', page gone on 'error'."""
    kind = F.col("event_type")
    return t.events.select(
        "event_id",
        F.col("user_id").alias("listing_id"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.when(kind != "signup", F.col("value").cast("decimal(14,2)")).alias("price_kzt"),
        F.when(kind == "error", 404).otherwise(200).alias("http_status"),
        F.get_json_object("props", "$.k").cast("int").alias("photo_count"),
        kind.alias("kind"),
    )


def attributes(t: Tables) -> DataFrame:
    """Listing attributes that do not change over time."""
    p, key = t.part, F.col("p_partkey")
    words = F.split("p_name", " ")
    listing = p.select(
        key.alias("listing_id"),
        F.when(key % 31 != 5, F.col("p_brand")).alias("make"),
        F.get(words, F.lit(1)).alias("model"),
        F.get(words, F.lit(0)).alias("trim"),
        (F.col("p_size") + 1990).alias("car_year"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("body_type"),
        (F.col("p_size").cast("decimal(10,1)") / 10).cast("decimal(3,1)").alias("engine_volume_l"),
        F.when(F.col("p_size") % 3 == 1, "petrol").when(F.col("p_size") % 3 == 2, "diesel").alias("engine_type"),
        F.when(F.col("p_size") % 2 == 0, "auto").otherwise("manual").alias("transmission"),
        F.lit("left").alias("steering"),
        (key * 10 % 300000).cast("int").alias("mileage_km"),
        F.when(key % 3 == 0, True).when(key % 3 == 1, False).alias("customs_cleared"),
    )
    seller = t.customer.select(
        F.col("c_custkey").alias("listing_id"),
        F.lower("c_mktsegment").alias("seller_type"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_name")).alias("seller_name"),
    )
    return listing.join(seller, "listing_id", "left")


def places(t: Tables) -> DataFrame:
    """Cities by nation key; one region has no name."""
    region = t.region.select(
        F.col("r_regionkey").alias("n_regionkey"), F.when(F.col("r_regionkey") != 0, F.col("r_name")).alias("region")
    )
    return t.nation.join(region, "n_regionkey").select(F.col("n_nationkey").alias("place"), F.col("n_name").alias("city"), "region")


def records(t: Tables) -> DataFrame:
    """Observations with the full listing record; every fifth listing moves at SPLIT."""
    split = f"TIMESTAMP '{SPLIT}'"
    placed = observations(t).selectExpr(
        "*", f"CAST((listing_id + IF(listing_id % 5 = 0 AND fetched_at >= {split}, 1, 0)) % 25 AS INT) AS place"
    )
    rows = placed.join(attributes(t), "listing_id").join(places(t), "place")
    own = {
        "url": f"concat('{BASE_URL}/a/show/', listing_id)",
        "title": "concat_ws(' ', make, model, trim)",
        "city": "IF(listing_id % 29 != 7, city, NULL)",
        "options_list": "CAST(array() AS ARRAY<STRING>)",
        "photos": "CAST(array() AS ARRAY<STRING>)",
    } | dict.fromkeys(["generation", "drivetrain", "color", "options_text"], "CAST(NULL AS STRING)")
    record = [f"IF(http_status < 400, {own.get(name, name)}, NULL) AS {name}" for name in PARSED.names[1:]]
    return rows.selectExpr("listing_id", "fetched_at", "http_status", *record, "CAST(NULL AS STRING) AS payload_hash")


def before_split() -> Column:
    return F.col("fetched_at") < F.lit(SPLIT).cast("timestamp")


class SilverLake:
    """Silver tables of the fetches selected by ``where``, each built on first use.

    As in a real run, a table that others build on is written once and read back.
    """

    def __init__(self, t: Tables, where: Column | None = None):
        self._rows = records(t) if where is None else records(t).where(where)
        self._none = S.empty_silver(t.spark)

    @cached_property
    def current(self) -> DataFrame:
        return staged(S.merge_current(self._none.current, self._rows), "current")

    @cached_property
    def snapshots(self) -> DataFrame:
        return S.merge_snapshots(self._none.snapshots, self._rows)

    @cached_property
    def price_events(self) -> DataFrame:
        return S.batch_price_events(self._none.current, self._rows)


def silver(t: Tables) -> SilverLake:
    """All silver tables, from the whole history."""
    return SilverLake(t)


def silver_at_split(t: Tables) -> SilverLake:
    return SilverLake(t, before_split())


def silver_two_steps(t: Tables) -> S.Silver:
    """State at SPLIT, then the rest as one batch."""
    return S.apply_batch(silver_at_split(t), records(t).where(~before_split()))


def calendar(t: Tables) -> DataFrame:
    return calendar_around(t.spark, AS_OF)


class GoldLake:
    """Gold tables after merging silver tables into ``before``, each built on first use."""

    def __init__(self, before, silver_tables, days: DataFrame):
        self._before, self._silver, self._days = before, silver_tables, days

    @cached_property
    def dim_date(self) -> DataFrame:
        return G.grow_calendar(self._before.dim_date, self._days)

    def _grown(self, name: str, rows: DataFrame, keys: list[str], key: str) -> DataFrame:
        return staged(G.grow_dimension(getattr(self._before, name), rows, keys, key), name)

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._grown("dim_location", G.location_rows(self._silver.current), LOCATION_COLUMNS, "location_key")

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return self._grown("dim_vehicle", G.vehicle_rows(self._silver.current), VEHICLE_COLUMNS, "vehicle_key")

    @cached_property
    def dim_seller(self) -> DataFrame:
        return self._grown("dim_seller", G.seller_rows(self._silver.current), SELLER_COLUMNS, "seller_key")

    @cached_property
    def fact_listing_daily(self) -> DataFrame:
        keys = G.listing_keys(self._silver.current, self.dim_location, self.dim_vehicle, self.dim_seller)
        return G.upsert_facts(self._before.fact_listing_daily, G.resolve_star(self._silver.snapshots, keys, self.dim_date))

    @cached_property
    def fact_price_event(self) -> DataFrame:
        return G.insert_price_facts(self._before.fact_price_event, self._silver.price_events)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in GOLD_ORDER}

    def written(self) -> GoldLake:
        """With the facts written too, for readers that scan them several times."""
        self.fact_listing_daily = staged(self.fact_listing_daily, "fact_listing_daily")
        return self


class StateAt:
    """Silver tables that only need a given current state."""

    def __init__(self, current: DataFrame):
        self.current = current


def dimensions(t: Tables, current: DataFrame) -> GoldLake:
    """The dimensions of a current state, written before facts point at them."""
    return GoldLake(G.empty_gold(t.spark), StateAt(current), calendar(t))


def build(before, silver_tables, days: DataFrame) -> GoldLake:
    return GoldLake(before, silver_tables, days)


def gold(t: Tables) -> GoldLake:
    return GoldLake(G.empty_gold(t.spark), silver(t), calendar(t))


def wide_snapshots(t: Tables) -> DataFrame:
    """Snapshots from ``lineitem``: much larger, not unique per day, on days far outside the calendar around today."""
    return t.lineitem.select(
        F.col("l_partkey").alias("listing_id"), F.to_date("l_shipdate").alias("snapshot_date"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("price_kzt"),
        (F.col("l_linestatus") == "O").alias("is_active"),
        F.col("l_quantity").cast("bigint").alias("views"), F.col("l_linenumber").alias("photo_count"),
    )


# -- index pages, listing pages, payloads ---------------------------------------


def index_pages(t: Tables) -> DataFrame:
    """Given pages as listing indexes: each names four ids, one per id pattern,
    except every 97th, which names none."""
    n = F.col("page_id")
    links = F.concat(
        F.lit("<script>listing.grid.push({ id: "), n.cast("string"), F.lit("});</script><a href='/a/show/"),
        (n + 1).cast("string"), F.lit("'>x</a><div DATA-LISTING-ID=\""), (n * 3).cast("string"),
        F.lit("\"></div><a HREF=\"/a/show/"), (n + 5).cast("string"), F.lit("\">y</a>"),
    )
    html = F.when(n % 97 == 96, F.col("html")).otherwise(F.concat("html", links))
    return t.pages.select((n + 1).alias("page_no"), html.alias("html"))


def fetched_pages(t: Tables) -> DataFrame:
    """Given pages as fetched listing pages, one per second."""
    return t.pages.select(
        F.col("page_id").alias("listing_id"),
        F.timestamp_add("SECOND", F.col("page_id"), F.lit(dt.datetime(2024, 1, 30)).cast("timestamp")).alias("fetched_at"),
        "url", "html", F.when(F.col("page_id") % 11 == 10, 404).otherwise(200).alias("http_status"),
    )


def listing_sources(t: Tables) -> DataFrame:
    """Fields a listing page is written from."""
    place = F.pmod(F.col("listing_id"), F.lit(25)).cast("int")
    # Writing and parsing pages is CPU work: spread the few input rows over all
    # tasks, as the files of a bronze table would be.
    return (
        attributes(t).join(t.part.select(F.col("p_partkey").alias("listing_id"), "p_brand", "p_retailprice"), "listing_id")
        .repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "listing_id")
        .withColumn("place", place).join(places(t), "place")
        .withColumn("price", (F.col("p_retailprice").cast("decimal(14,2)") * 1000).cast("bigint"))
    )


def _pair(label: str, value: Column) -> Column:
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"<dt>{label}</dt>\n  <dd> "), value, F.lit(" </dd>")))


def listing_pages(t: Tables) -> DataFrame:
    """Listing pages written from table fields, to be parsed back."""
    nbsp = F.lit("\u00a0")
    grouped = lambda n: F.replace(F.format_number(n, 0), F.lit(","), nbsp)
    c = F.col
    photo = F.concat(F.lit("<img src='/p/"), c("listing_id").cast("string"), F.lit("?a=1&amp;b=2'>"))
    html = F.concat(
        F.lit("<html><head><title>t</title><style>p{}</style></head><body><!-- <h1>no</h1> --><h1>"),
        c("p_brand"), F.lit("  <b>"), c("model"), F.lit("</b> "), c("trim"), F.lit(" "), c("car_year").cast("string"),
        F.lit(" г.</h1><div>"), grouped(c("price")), F.lit(" ₸</div><dl>"),
        _pair(fixed.LABEL_CITY, c("city")), _pair(fixed.LABEL_AREA, c("region")), _pair(fixed.LABEL_BODY, c("body_type")),
        _pair(fixed.LABEL_MILEAGE, F.concat(grouped(c("mileage_km")), F.lit(" км"))),
        _pair(fixed.LABEL_ENGINE, F.concat(c("engine_volume_l").cast("string"), F.coalesce(F.concat(F.lit(" ("), c("engine_type"), F.lit(")")), F.lit("")))),
        _pair(fixed.LABEL_GEARBOX, c("transmission")), _pair(fixed.LABEL_STEERING, c("steering")),
        _pair(fixed.LABEL_CUSTOMS, F.when(c("customs_cleared"), fixed.YES).when(~c("customs_cleared"), fixed.NO)),
        F.lit("</dl>"), F.coalesce(F.concat(F.lit(f"<p>{fixed.LABEL_SELLER}</p><p>"), c("seller_name"), F.lit("</p>")), F.lit("")),
        F.lit(f"<h2>{fixed.LABEL_OPTIONS}</h2><li>ABS brakes</li><li>"), c("p_brand"), F.lit(" &amp; "), c("model"),
        F.lit("</li><li>PHOTOS</li><li>not an option</li>"),
        photo, F.lit('<img data-src="https://img.example/1.jpg" src="data:x">'), photo, F.lit("</body></html>"),
    )
    return listing_sources(t).select("listing_id", listing_url(BASE_URL, c("listing_id")).alias("url"), html.alias("html"))


def view_payloads(t: Tables) -> DataFrame:
    """One response per event, in every shape a response may have; every seventh count is above 32 bits."""
    user = F.col("user_id").cast("string")
    whole = (F.col("event_id") + F.when(F.col("event_id") % 7 == 0, 3_000_000_000).otherwise(0)).cast("string")
    shapes = [
        F.concat(F.lit('{"data": {"'), user, F.lit('": '), whole, F.lit("}}")),
        F.concat(F.lit('{"data": {"'), user, F.lit('": '), whole, F.lit(".9}}")),
        F.concat(F.lit('{"data": {"'), user, F.lit('": "'), whole, F.lit('"}}')),
        F.concat(F.lit('{"data": {"'), user, F.lit('": {"views": '), whole, F.lit(', "count": 3}}}')),
        F.concat(F.lit('{"data": {"'), user, F.lit('": {"views": 0, "count": "'), whole, F.lit('"}}}')),
        F.concat(F.lit('{"data": {"'), user, F.lit('": {"z": "q", "n": '), whole, F.lit(', "a": 1}}}')),
        F.concat(F.lit('{"data": {"x'), user, F.lit('": '), whole, F.lit("}}")),
        F.concat(F.lit('{"data": {"'), user, F.lit('": "'), whole, F.lit('.5"}}')),
        F.concat(F.lit('{"data": ['), whole, F.lit("]}")),
        F.lit('{"status": "empty"}'),
        F.lit("<html>busy</html>"),
        F.concat(F.lit('{"data": {"'), user, F.lit('": '), whole, F.lit('}} {"data": 1}')),
        F.concat(F.lit('{"data": {"'), user, F.lit('": '), whole, F.lit("}}] x")),
        F.concat(F.lit('{"data": {"'), user, F.lit('": '), whole, F.lit("}}]")),
        F.concat(F.lit('{"data": {"'), user, F.lit('": '), whole, F.lit("}}][")),
    ]
    n = F.pmod(F.col("event_id"), F.lit(len(shapes)))
    body = F.when(n == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], 1):
        body = body.when(n == i, shape)
    return t.events.select("event_id", body.alias("body"))


# -- fetch runs and the queue ---------------------------------------------------


def outcomes(t: Tables) -> DataFrame:
    """Events as fetch outcomes, one run per day."""
    kind = F.col("kind")
    outcome = (
        F.when(kind == "error", "failed").when(kind == "signup", "blocked")
        .when((kind == "view") & (F.col("event_id") % 3 == 0), "discovered").when(kind == "view", "duplicate").otherwise("parsed")
    )
    return observations(t).select(
        F.to_date("fetched_at").alias("run"), "listing_id", F.col("fetched_at").alias("at"), outcome.alias("outcome"),
        F.when(kind.isin("click", "purchase"), 200).when(kind == "error", 404).alias("http_status"),
        F.when(kind == "error", F.concat(F.lit("HTTP 404 for event "), F.col("event_id").cast("string"))).alias("error"),
    )


def queue(t: Tables) -> DataFrame:
    """A queue over all parts, in mixed states."""
    n = F.col("p_partkey")
    stamp = F.lit(dt.datetime(2024, 1, 29)).cast("timestamp")
    return t.part.select(
        n.alias("listing_id"), listing_url(BASE_URL, n).alias("url"),
        F.timestamp_add("MINUTE", F.col("p_size"), stamp).alias("discovered_at"),
        F.when(n % 4 == 0, "NEW").when(n % 4 == 1, "RETRY").when(n % 4 == 2, "FETCHED").otherwise("INACTIVE").alias("state"),
        (n % 15).cast("int").alias("attempts"),
        F.lit(None).cast("timestamp").alias("last_attempt_at"),
        F.when(n % 4 == 1, F.timestamp_add("HOUR", F.col("p_size"), stamp)).alias("next_retry_at"),
        F.when(n % 4 == 2, 200).when(n % 4 == 3, 404).cast("int").alias("last_http_status"),
        F.when(n % 4 == 1, "timeout").alias("last_error"),
    )


def now() -> Column:
    return F.lit(dt.datetime(2024, 1, 30)).cast("timestamp")


def run_outcomes(t: Tables) -> DataFrame:
    """The last fetch of each listing as this run's outcome."""
    kind = F.col("last.kind")
    outcome = F.when(kind == "error", "gone").when(kind == "signup", "blocked").when(kind == "view", "error").otherwise("parsed")
    last = observations(t).groupBy("listing_id").agg(F.max(F.struct("fetched_at", "kind")).alias("last"))
    return last.select("listing_id", outcome.alias("outcome"), F.when(kind == "view", "HTTP 503").alias("error"))

"""Raw pages to listing records, in one distributed projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.functions import fixed, html as H
from motorlake.functions.text import payload_fingerprint
from motorlake.functions.values import photo_count
from motorlake.schemas import PARSED


def parse_pages(pages: DataFrame, base_url: str, carry: list[str] = ()) -> DataFrame:
    """(listing_id, url, html) to the 26-column listing record.

    Four projections, each using the arrays made by the one before it, so the
    page text is scanned once per pattern and the line array is built once. No
    shuffle and no Python worker is involved.
    """
    page = F.col("visible")
    split = pages.select("listing_id", "url", *carry, H.without_hidden(F.col("html")).alias("visible")).select(
        "listing_id", "url", *carry,
        H.text_lines(page).alias("lines"), H.title(page).alias("title"), H.photos(page, base_url).alias("photos"),
    )
    lines = F.col("lines")
    parts = split.select(
        "listing_id", "url", *carry, "title", "photos", "lines",
        F.array_join(lines, "\n").alias("text"),
        H.title_tokens(F.col("title")).alias("tokens"),
        H.value_after(lines, fixed.LABEL_ENGINE).alias("engine"),
        H.value_after(lines, fixed.LABEL_SELLER).alias("seller_name"),
        H.value_after(lines, fixed.LABEL_CUSTOMS).alias("customs"),
        H.options(lines).alias("options_list"),
    )
    after = lambda label: H.value_after(lines, label)
    fields = {
        "listing_id": F.col("listing_id"),
        "url": F.col("url"),
        "title": F.col("title"),
        "price_kzt": H.price(F.col("text")),
        "city": after(fixed.LABEL_CITY),
        "region": F.coalesce(after(fixed.LABEL_REGION), after(fixed.LABEL_AREA)),
        "make": H.title_make(F.col("tokens")),
        "model": H.title_model(F.col("tokens")),
        "generation": after(fixed.LABEL_GENERATION),
        "trim": H.title_trim(F.col("tokens")),
        "car_year": H.title_year(F.col("title")),
        "mileage_km": H.mileage(F.col("text"), lines).try_cast("int"),
        "body_type": after(fixed.LABEL_BODY),
        "engine_volume_l": H.engine_volume(F.col("engine")),
        "engine_type": H.engine_type(F.col("engine")),
        "transmission": after(fixed.LABEL_GEARBOX),
        "drivetrain": after(fixed.LABEL_DRIVE),
        "steering": after(fixed.LABEL_STEERING),
        "color": after(fixed.LABEL_COLOR),
        "customs_cleared": H.tri_state(F.col("customs")),
        "seller_name": F.col("seller_name"),
        "seller_type": H.seller_type(F.col("seller_name")),
        "options_text": H.options_text(F.col("options_list")),
        "options_list": F.col("options_list"),
        "photos": F.col("photos"),
        "photo_count": photo_count(F.col("photos")),
    }
    return parts.select(*carry, *[fields[name].alias(name) for name in PARSED.names])


def with_fingerprint(listings: DataFrame) -> DataFrame:
    return listings.withColumn("payload_hash", payload_fingerprint(listings, PARSED.names))

"""Listing discovery on index pages and the routing of fetch outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.functions import html as H
from motorlake.functions.text import listing_url
from motorlake.functions.values import digits_id
from motorlake.session import staged


def ids_per_page(pages: DataFrame, ids: Column | None = None) -> DataFrame:
    """(page_no, listing_ids, n_ids, blocked) for index pages (page_no, html)."""
    found = H.listing_ids(F.col("html")) if ids is None else ids
    numbers = F.array_distinct(F.filter(F.transform(found, digits_id), lambda n: n.isNotNull()))
    return (
        pages.select("page_no", numbers.alias("listing_ids"), H.block_reason(F.col("html")).isNotNull().alias("blocked"))
        .select("page_no", "listing_ids", F.size("listing_ids").alias("n_ids"), "blocked")
    )


def before_first_empty(pages: DataFrame) -> DataFrame:
    """Pages before the first empty or blocked one: discovery stops there.

    The page summaries are written once; the stop and the rows are read from them.
    """
    pages = staged(pages, "page-summaries")
    ends = (F.col("n_ids") == 0) | F.col("blocked")
    stop = pages.where(ends).agg(F.min("page_no").alias("stop"))
    end = F.coalesce(stop.scalar(), F.lit(2**63 - 1))
    return pages.where(F.col("page_no") < end)


def discovered_ids(pages: DataFrame) -> DataFrame:
    """Distinct ids over all usable pages."""
    return before_first_empty(pages).select(F.explode("listing_ids").alias("listing_id")).distinct()


def with_urls(ids: DataFrame, base_url: str) -> DataFrame:
    return ids.select("listing_id", listing_url(base_url, F.col("listing_id")).alias("url"))


def fetch_outcome(http_status: Column, reason: Column) -> Column:
    """blocked, gone (404), error (other 4xx and 5xx) or parsed, in this order."""
    return (
        F.when(reason.isNotNull(), "blocked").when(http_status == 404, "gone")
        .when(http_status >= 400, "error").otherwise("parsed")
    )


def skip_seen(ids: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ids still to fetch, ids skipped as duplicates)."""
    return ids.join(seen, "listing_id", "left_anti"), ids.join(seen, "listing_id", "left_semi")

"""View-count payloads: ``{"data": {"<listing id>": <number, text or object>}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.functions.values import digits_id, needs_member_order, view_count


def _with_document(payloads: DataFrame, body: str) -> DataFrame:
    """The rows with ``_document``: the body as a variant, null unless it is one complete JSON value and nothing more.

    The body is parsed once, as the first of two elements; the second is its own
    digest, which no body can hold. Whatever ends the list early, adds elements
    to it or leaves something open keeps the digest from the second place. The
    list comes out of a generator, past which no filter or column is computed
    again.
    """
    text = F.col(body)
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.sha2(text, 256), F.lit('"]')))
    once = payloads.select("*", F.explode_outer(F.array(listed)).alias("_listed"))
    whole = F.try_variant_get("_listed", "$[1]", "string") == F.sha2(text, 256)
    return once.withColumn("_document", F.when(whole, F.try_variant_get("_listed", "$[0]", "variant"))).drop("_listed")


def payload_shapes(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The rows with ``shape``: 'ok', 'empty' (no ``data``), 'not_an_object' or 'unreadable'."""
    data = F.try_variant_get("_document", "$.data", "variant")
    shape = (
        F.when(F.col("_document").isNull(), "unreadable")
        .when(data.isNull(), "empty")
        .when(F.schema_of_variant(data).startswith("OBJECT"), "ok")
        .otherwise("not_an_object")
    )
    return _with_document(payloads, body).withColumn("shape", shape).drop("_document")


def read_entries(payloads: DataFrame, body: str = "body", carry: list[str] = ()) -> DataFrame:
    """One row per map entry: (id_text, value, raw). Bad shapes yield no rows.

    ``raw``, an entry's JSON text, is only read for payloads with an object that
    has to be searched in member order; elsewhere it is null.
    """
    values = F.try_variant_get("_document", "$.data", "map<string,variant>")
    texts = F.from_json(F.col(body), "struct<data:map<string,string>>")["data"]
    parsed = _with_document(payloads.select(*dict.fromkeys([*carry, body])), body).select(
        *carry, body, F.explode_outer(F.array(values)).alias("_values"))
    ordered = F.exists(F.map_values("_values"), needs_member_order)
    with_text = parsed.select(*carry, "_values", F.when(ordered, texts).alias("_raw"))
    return with_text.select(*carry, F.explode("_values").alias("id_text", "value"), "_raw").select(
        *carry, "id_text", "value", F.try_element_at("_raw", F.col("id_text")).alias("raw")
    )


def view_counts(payloads: DataFrame, body: str = "body", carry: list[str] = ()) -> DataFrame:
    """(listing_id, views); entries without a usable id or count are skipped."""
    entries = read_entries(payloads, body, carry)
    return entries.select(
        *carry,
        digits_id(F.col("id_text")).alias("listing_id"), view_count(F.col("value"), F.col("raw")).alias("views"),
    ).where(F.col("listing_id").isNotNull() & F.col("views").isNotNull())

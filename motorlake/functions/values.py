"""Type repair, list and JSON value functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.functions import fixed
from motorlake.functions.text import strip


def repair_integers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Whole-number columns stored as floating point become nullable bigint."""
    names = set(columns or fixed.INTEGER_COLUMNS)
    return df.select([
        F.col(f.name).try_cast("bigint").alias(f.name)
        if f.name in names and f.dataType.typeName() in ("float", "double")
        else F.col(f.name)
        for f in df.schema.fields
    ])


def fit_decimal(value: Column, precision: int, scale: int, strict: bool = True) -> Column:
    """Round half up to the scale; overflow raises, or is null when not strict."""
    target = f"decimal({precision},{scale})"
    return value.cast(target) if strict else value.try_cast(target)


def price_changed(old: Column, new: Column) -> Column:
    """Both known and different (compared as money, not as floats)."""
    return F.coalesce(fit_decimal(old, 14, 2) != fit_decimal(new, 14, 2), F.lit(False))


def photos_json(photos: Column) -> Column:
    """The list as JSON text; a missing list is '[]'."""
    return F.to_json(F.coalesce(photos, F.array().cast("array<string>")))


def photo_count(photos: Column) -> Column:
    return F.size(F.coalesce(photos, F.array().cast("array<string>")))


def flatten_list(items: Column) -> Column:
    return F.array_join(items, fixed.LIST_SEPARATOR)


def digits_id(text: Column) -> Column:
    """A digits-only id as bigint, anything else null."""
    return F.when(text.rlike(r"^\d+$"), text.try_cast("bigint"))


_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN")


def variant_kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, VOID, BOOLEAN, BIGINT, DECIMAL or DOUBLE."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def _as_count(value: Column) -> Column:
    """Numbers truncate, digit strings convert, all else is null."""
    kind, text = variant_kind(value), strip(F.try_variant_get(value, "$", "string"))
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    return F.when(kind.isin(*_NUMBERS), F.try_variant_get(value, "$", "bigint")).when(kind == "STRING", whole)


def _member(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _filled(value: Column) -> Column:
    """Neither absent, null, zero, false, '' nor an empty container."""
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(~text.isin("", "false", "{}", "[]") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0)
                      | (variant_kind(value) == "STRING") & (text != ""), F.lit(False))


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def needs_member_order(value: Column) -> Column:
    """An object whose count is not under one of the usual names."""
    usual = _filled(_member(value, "views")) | _filled(_member(value, "count")) | _present(_member(value, "value"))
    return (variant_kind(value) == "OBJECT") & ~usual


def first_number(raw: Column) -> Column:
    """The first numeric member of an object, in the order of its JSON text.

    The variant type sorts members by name, the text keeps the payload's order.
    """
    members = F.map_values(F.from_json(raw, "map<string,variant>"))
    return F.get(F.filter(members, lambda m: _present(m) & variant_kind(m).isin(*_NUMBERS)), F.lit(0))


def view_count(value: Column, raw: Column) -> Column:
    """A view count from an integer, a number, a digit string or an object.

    In an object the first filled one of ``views`` and ``count`` wins, then
    ``value`` as it is, then the first numeric member of its text ``raw``.
    """
    views, count, other = (_member(value, name) for name in ("views", "count", "value"))
    chosen = (
        F.when(variant_kind(value) != "OBJECT", value)
        .when(_filled(views), views).when(_filled(count), count).when(_present(other), other)
        .otherwise(first_number(raw))
    )
    return F.get(F.transform(F.array(chosen), _as_count), F.lit(0))

"""Scalar string functions as native column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorlake.functions import fixed

# Unicode white space plus the four separators that text APIs also strip.
SPACE = r"[\s\x1c-\x1f]"


def capture(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``; null (not '') when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def clean(text: Column) -> Column:
    """Collapse white space, strip, and turn an empty result into null."""
    collapsed = F.regexp_replace(text, rf"(?U){SPACE}+", " ")
    return F.nullif(F.trim(collapsed), F.lit(""))


def is_upper(text: Column) -> Column:
    """At least one cased letter and none in lower or title case."""
    return text.rlike(r"\p{Lu}") & ~text.rlike(r"[\p{Ll}\p{Lt}]")


def contains_any(text: Column, words: list[str]) -> Column:
    hit = text.contains(words[0])
    for word in words[1:]:
        hit = hit | text.contains(word)
    return hit


# 128 to 159 mean Windows-1252 characters in a page; five of them are not assigned.
_WINDOWS = {b: bytes([b]).decode("cp1252", "replace") for b in range(128, 160)}


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD for one that is no character."""
    is_valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    safe = F.when(is_valid, code).otherwise(F.lit(0xFFFD).cast("bigint"))
    windows = F.try_element_at(F.expr("map(" + ", ".join(f"{b}L, '{c}'" for b, c in _WINDOWS.items()) + ")"), safe)
    return F.coalesce(windows, F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32"))


def _number(digits: Column, base: int, longest: int) -> Column:
    """A code point from its digits; too many of them are out of every range."""
    kept = F.regexp_replace(digits, "^0+(?=.)", "")
    read = F.conv(F.when(F.length(kept) <= longest, kept), base, 10).cast("bigint")
    return F.when(digits != "", F.coalesce(read, F.lit(0).cast("bigint")))


def unescape_entities(text: Column) -> Column:
    """Decode named and numeric character references in one left-to-right pass.

    The text is cut at every '&', so '&amp;lt;' yields '&lt;' and is not decoded
    twice. A number needs no ';'; a name without ';' stays as it is. No text can
    raise: a number that is no character becomes U+FFFD.
    """
    known = {**name2codepoint, "apos": 39}
    names = F.expr("map(" + ", ".join(f'"{name}", "{chr(code)}"' if code == 39 else f"'{name}', '{chr(code)}'" for name, code in known.items()) + ")")

    def decode(piece: Column, index: Column) -> Column:
        name = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        decimal = F.regexp_extract(piece, r"^#([0-9]+)", 1)
        hexa = F.regexp_extract(piece, r"^#[xX]([0-9A-Fa-f]+)", 1)
        number = F.coalesce(_number(decimal, 10, 7), _number(hexa, 16, 6))
        value = F.coalesce(F.try_element_at(names, name), F.when(number.isNotNull(), _character(number)))
        rest = F.regexp_replace(piece, r"^(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;)", "")
        decoded = F.coalesce(F.concat(value, rest), F.concat(F.lit("&"), piece))
        return F.when(index == 0, piece).otherwise(decoded)

    return F.array_join(F.transform(F.split(text, "&"), decode), "")


def redact_secrets(message: Column) -> Column:
    """Hide URL credentials and key=value secrets in a log text.

    The patterns run only on texts that hold one of the words they need, which
    a plain substring search settles much faster.
    """
    hidden = message
    for pattern, replacement in fixed.REDACTIONS:
        hidden = F.regexp_replace(hidden, "(?iU)" + pattern, replacement)
    named = F.exists(F.array(F.lower(message)), lambda text: contains_any(text, fixed.REDACTION_WORDS))
    suspect = message.contains("://") | named
    return F.when(suspect, hidden).otherwise(message)


def sha256_hex(text: Column) -> Column:
    """Lower-case hex digest of the UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def listing_url(base_url: str, listing_id: Column) -> Column:
    return F.concat(F.lit(base_url + "/a/show/"), listing_id.cast("string"))


def index_page_url(base_url: str, page_no: Column) -> Column:
    first = F.lit(base_url + "/cars/")
    return F.when(page_no == 1, first).otherwise(F.concat(first, F.lit("?page="), page_no.cast("string")))


def absolute_url(base_url: str, url: Column) -> Column:
    return F.when(url.startswith("/"), F.concat(F.lit(base_url), url)).otherwise(url)


def page_object_key(listing_id: Column, fetched_at: Column) -> Column:
    """``YYYY/MM/DD/{id}_{HHMMSS}.html.gz``"""
    return F.concat(
        F.date_format(fetched_at, "yyyy/MM/dd/"), listing_id.cast("string"),
        F.date_format(fetched_at, "_HHmmss"), F.lit(".html.gz"),
    )


def export_object_key(table: Column, as_of: Column) -> Column:
    """``YYYY/MM/DD/{table}_{YYYYMMDD}.parquet``"""
    return F.concat(
        F.date_format(as_of, "yyyy/MM/dd/"), table, F.date_format(as_of, "_yyyyMMdd"), F.lit(".parquet")
    )


def _json_string(text: Column) -> Column:
    """A JSON string literal, through the JSON writer's own escaping."""
    quoted = F.to_json(F.array(text))
    return F.substr(quoted, F.lit(2), F.length(quoted) - 2)


def _json_value(df, name: str) -> Column:
    kind, value = df.schema[name].dataType.typeName(), F.col(name)
    if kind == "string":
        text = _json_string(value)
    elif kind == "array":
        items = F.transform(value, _json_string)
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null"))


def payload_fingerprint(df, columns: list[str]) -> Column:
    """sha256 of the record as key-sorted JSON with ', ' and ': ' separators."""
    members = [F.concat(F.lit(f'"{name}": '), _json_value(df, name)) for name in sorted(columns)]
    return sha256_hex(F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}")))

"""Listing page fields as native column expressions.

Every function takes the page text, or the ``lines`` array made from it, and
returns a column, so a whole page is parsed inside one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorlake.functions import fixed
from motorlake.functions.text import (
    SPACE, absolute_url, capture, clean, contains_any, is_upper, strip, unescape_entities,
)
from motorlake.functions.values import flatten_list

_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b.*?(?:</\1\s*>|\z)"
# The inside of a tag: a quoted value may hold '>'. Possessive, so that no input backtracks or recurses.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
_TAG = rf"<[A-Za-z/!?]{_INSIDE}>?"


def without_hidden(html: Column) -> Column:
    """Drop comments and the content of script, style and template elements."""
    return F.regexp_replace(html, _HIDDEN, "")


def text_lines(visible: Column) -> Column:
    """Every text node on a line of its own: stripped, empty lines dropped.

    This, ``title`` and ``photos`` take a page ``without_hidden`` parts.
    """
    flat = unescape_entities(F.regexp_replace(visible, _TAG, "\n"))
    return F.filter(F.transform(F.split(flat, "\n"), strip), lambda line: line != "")


def title(visible: Column) -> Column:
    """Text of the first h1."""
    inner = F.regexp_extract(visible, rf"(?is)<h1\b{_INSIDE}>(.*?)(?:</h1\s*>|\z)", 1)
    return clean(unescape_entities(F.regexp_replace(inner, _TAG, " ")))


def _whole_number(run: Column, kind: str) -> Column:
    """Digits with plain or no-break spaces; any other inner space is no number."""
    joined = F.translate(run, " \u00a0", "")
    return strip(joined).try_cast(kind)


def price(text: Column) -> Column:
    """The first run of digits and spaces before the currency sign."""
    run = F.regexp_extract(text, rf"(?U)([\d\s\x1c-\x1f]+){SPACE}*₸", 1)
    return F.when(text.contains("₸"), _whole_number(run, "bigint"))


def value_after(lines: Column, label: str) -> Column:
    """The cleaned line after the first line equal to ``label``."""
    position = F.nullif(F.array_position(lines, label), F.lit(0))
    return clean(F.get(lines, position.cast("int")))


def tri_state(text: Column) -> Column:
    return F.when(text == fixed.YES, True).when(text == fixed.NO, False)


def mileage_in(text: Column) -> Column:
    """The first number before a kilometre unit.

    The pattern takes the same runs as repeated digit groups would, without
    their exponential backtracking on long digit runs.
    """
    run = F.regexp_extract(text, rf"(?iU)(\d(?:[\d\s\x1c-\x1f]*\d)?){SPACE}*(?:км|km)", 1)
    return _whole_number(run, "bigint")


def mileage(text: Column, lines: Column) -> Column:
    label = F.coalesce(value_after(lines, fixed.LABEL_MILEAGE), value_after(lines, fixed.LABEL_MILEAGE_KM))
    return F.coalesce(mileage_in(text), mileage_in(label))


def engine_volume(raw: Column) -> Column:
    return capture(raw, r"(\d+(?:\.\d+)?)").try_cast("double")


def engine_type(raw: Column) -> Column:
    return clean(capture(raw, r"\(([^)]+)\)"))


def seller_type(seller_name: Column) -> Column:
    return F.when(seller_name.isNotNull(), "dealer").otherwise("private")


def options(lines: Column, most: int | None = None) -> Column:
    """The lines under the options header, up to the next section; at most ``most`` if given."""
    position = F.array_position(lines, fixed.LABEL_OPTIONS).cast("int")
    window = F.slice(lines, position + 1, F.size(lines) if most is None else F.lit(most))
    is_stop = F.transform(window, lambda line: is_upper(line) | line.isin(fixed.OPTIONS_STOP_LABELS))
    stop = F.array_position(is_stop, True).cast("int")
    kept = F.when(stop > 0, F.slice(window, F.lit(1), stop - 1)).otherwise(window)
    return F.when(position > 0, kept).otherwise(F.array().cast("array<string>"))


def options_text(items: Column) -> Column:
    return clean(flatten_list(items))


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"""(?is)(?<![\w-]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])
    return F.nullif(unescape_entities(value), F.lit(""))


def photos(visible: Column, base_url: str) -> Column:
    """Absolute image URLs, in page order, each once."""
    tags = F.regexp_extract_all(visible, F.lit(rf"(?is)<img\b{_INSIDE}>"), F.lit(0))
    sources = F.transform(
        tags, lambda tag: F.coalesce(*[_attribute(tag, a) for a in ("data-src", "src", "data-lazy-src")])
    )
    usable = F.filter(sources, is_photo_url)
    return F.array_distinct(F.transform(usable, lambda url: absolute_url(base_url, url)))


def is_photo_url(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://") | url.startswith("/")


def title_tokens(title_text: Column) -> Column:
    return F.split(title_text, " ")


def title_make(tokens: Column) -> Column:
    return F.when(F.size(tokens) >= 2, F.get(tokens, F.lit(0)))


def title_model(tokens: Column) -> Column:
    return F.when(F.size(tokens) >= 2, F.get(tokens, F.lit(1)))


def title_trim(tokens: Column) -> Column:
    """First token after make and model that is no year and no filler word."""
    rest = F.slice(tokens, F.lit(3), F.greatest(F.size(tokens), F.lit(1)))
    usable = F.filter(
        rest, lambda t: ~F.lower(t).isin(fixed.TITLE_SKIP_WORDS) & ~t.rlike(r"(?U)^\d{4}")
    )
    return F.get(usable, F.lit(0))


def title_year(title_text: Column) -> Column:
    return capture(title_text, r"(?U)\b(19\d{2}|20\d{2})\b").try_cast("int")


def listing_ids(html: Column) -> Column:
    """Distinct digit strings found by any of the id patterns on an index page."""
    found = [F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in fixed.ID_PATTERNS]
    ids = found[0]
    for more in found[1:]:
        ids = F.array_union(ids, more)
    return ids


def block_reason(html: Column, short_page: int = fixed.SHORT_PAGE_CHARS, cf_ray_page: int = fixed.CF_RAY_CHARS) -> Column:
    """Why a page is a block page, null for a usable page. The first rule wins.

    Two rules hold for pages under ``short_page`` and ``cf_ray_page`` characters.
    """
    lowered, size = F.lower(html), F.length(html)
    page_title = F.regexp_extract(lowered, r"<title[^>]*>([^<]+)</title>", 1)
    reason = F.when(
        (size < short_page) & contains_any(lowered, fixed.SHORT_PAGE_WORDS), fixed.SHORT_PAGE_REASON
    )
    for pattern, name in fixed.BLOCK_PATTERNS:
        # (?d): only a line feed ends a line for '.'
        first_word = pattern.split(".")[0]
        reason = reason.when(lowered.contains(first_word) & lowered.rlike("(?d)" + pattern), name)
    reason = reason.when(
        contains_any(page_title, fixed.BLOCK_TITLE_WORDS),
        F.concat(F.lit(fixed.BLOCK_TITLE_REASON), F.substring(page_title, 1, fixed.BLOCK_TITLE_CHARS)),
    )
    return reason.when(
        lowered.contains("cf-ray") & (size < cf_ray_page) & contains_any(lowered, fixed.CF_RAY_WORDS),
        fixed.CF_RAY_REASON,
    )

"""Page parsing: text lines, titles, listing fields, block pages, fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorlake.checks import bindings as B
from motorlake.checks.oracle import BASE, WS
from motorlake.checks.registry import query
from motorlake.functions import fixed
from motorlake.functions import html as H
from motorlake.functions.text import clean, sha256_hex
from motorlake.plans.parse import parse_pages, with_fingerprint

_VISIBLE = (
    r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?(-->|\z)', '', 'g'), "
    r"'(?is)<script\b.*?(</script\s*>|\z)', '', 'g'), '(?is)<style\b.*?(</style\s*>|\z)', '', 'g')"
)


_INSIDE = r"""(?:[^>=]|=\s*(?:"[^"]*"|''[^'']*'')|=)*"""


def _plain(markup: str, gap: str) -> str:
    text = f"regexp_replace({markup}, '<[A-Za-z/!?]{_INSIDE}>?', {gap}, 'g')"
    for name, char in [("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]:
        text = f"replace({text}, '{name}', '{char}')"
    return text


def _clean(text: str) -> str:
    return f"nullif(trim(regexp_replace({text}, '{WS}+', ' ', 'g')), '')"


_LINES = (
    f"list_filter(list_transform(string_split({_plain(_VISIBLE, 'chr(10)')}, chr(10)), "
    f"lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda y: y <> '')"
)
_TITLE = _clean(_plain(r"regexp_extract(" + _VISIBLE + rf", '(?is)<h1\b{_INSIDE}>(.*?)(?:</h1\s*>|\z)', 1)", "' '"))


# Every third page gets attributes with '>' in its headings.
_QUOTED = """(SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(html, '<h1', '<h1 title="a>b" lang=''x>y''') ELSE html END AS html FROM pages)"""


def _quoted(t):
    html = F.replace("html", F.lit("<h1"), F.lit("<h1 title=\"a>b\" lang='x>y'"))
    return t.pages.select("page_id", F.when(F.col("page_id") % 3 == 0, html).otherwise(F.col("html")).alias("html"))


@query("F2", f"SELECT page_id, len(l) AS n_lines, md5(array_to_string(l, chr(10))) AS digest FROM (SELECT page_id, {_LINES} AS l FROM {_QUOTED} p) q")
def page_text_lines(t):
    lines = _quoted(t).select("page_id", H.text_lines(H.without_hidden(F.col("html"))).alias("l"))
    return lines.select("page_id", F.size("l").cast("bigint").alias("n_lines"), F.md5(F.array_join("l", "\n")).alias("digest"))


@query("F3", f"SELECT page_id, {_TITLE} AS title FROM {_QUOTED} p")
def page_titles(t):
    return _quoted(t).select("page_id", H.title(H.without_hidden(F.col("html"))).alias("title"))


@query("F13 F14 F15", f"""
  SELECT page_id, CASE WHEN len(k) >= 2 THEN k[1] END AS make, CASE WHEN len(k) >= 2 THEN k[2] END AS model,
         list_filter(k[3:], lambda w: lower(w) NOT IN ('г.', 'год', 'year') AND NOT regexp_matches(w, '^[0-9]{{4}}'))[1] AS trim,
         CAST(nullif(regexp_extract(s, '\\b(19[0-9]{{2}}|20[0-9]{{2}})\\b', 1), '') AS INTEGER) AS car_year
  FROM (SELECT page_id, s, string_split(s, ' ') AS k FROM (SELECT page_id, ({_TITLE}) || ' ' || (1900 + page_id % 150) || ' г.' AS s FROM pages) a) q""")
def title_parts(t):
    year = F.concat(F.lit(" "), (F.col("page_id") % 150 + 1900).cast("string"), F.lit(" г."))
    titles = t.pages.select("page_id", F.concat(H.title(H.without_hidden(F.col("html"))), year).alias("s"))
    tokens = titles.select("page_id", "s", H.title_tokens(F.col("s")).alias("k"))
    k = F.col("k")
    return tokens.select(
        "page_id", H.title_make(k).alias("make"), H.title_model(k).alias("model"), H.title_trim(k).alias("trim"),
        H.title_year(F.col("s")).alias("car_year"),
    )


_PARSED = f"""
  SELECT a.listing_id, '{BASE}/a/show/' || a.listing_id AS url,
         p_brand || ' ' || a.model || ' ' || a.trim || ' ' || a.car_year || ' г.' AS title,
         CAST(CAST(p_retailprice AS DECIMAL(14,2)) * 1000 AS BIGINT) AS price_kzt, g.city, g.region,
         p_brand AS make, a.model, CAST(NULL AS VARCHAR) AS generation, a.trim, a.car_year, a.mileage_km, a.body_type,
         CAST(a.engine_volume_l AS DOUBLE) AS engine_volume_l, a.engine_type, a.transmission,
         CAST(NULL AS VARCHAR) AS drivetrain, a.steering, CAST(NULL AS VARCHAR) AS color, a.customs_cleared, a.seller_name,
         CASE WHEN a.seller_name IS NULL THEN 'private' ELSE 'dealer' END AS seller_type,
         'ABS brakes; ' || p_brand || ' & ' || a.model AS options_text,
         'ABS brakes|' || p_brand || ' & ' || a.model AS options_list,
         '{BASE}/p/' || a.listing_id || '?a=1&b=2|https://img.example/1.jpg' AS photos, 2 AS photo_count
  FROM attrs a JOIN part ON p_partkey = a.listing_id JOIN places g ON g.place = a.listing_id % 25"""


@query("F2 F3 F4 F5 F6 F7 F8 F9 F10 F11 F12 F13 F14 F15 P12 T4 T8", _PARSED, "attrs places")
def listing_pages_parsed(t):
    """Pages written from table fields are parsed back to those fields."""
    return parse_pages(B.listing_pages(t), B.BASE_URL)


def _json(column: str, text: bool = True) -> str:
    value = f"'\"' || {column} || '\"'" if text else f"CAST({column} AS VARCHAR)"
    return f"""'"{column}": ' || coalesce({value}, 'null')"""


_FIELDS = [
    ("body_type", True), ("car_year", False), ("city", True), ("color", True), ("customs_cleared", False), ("drivetrain", True),
    ("engine_type", True), ("engine_volume_l", False), ("generation", True), ("listing_id", False), ("make", True),
    ("mileage_km", False), ("model", True), ("options_list", None), ("options_text", True), ("photo_count", False),
    ("photos", None), ("price_kzt", False), ("region", True), ("seller_name", True), ("seller_type", True), ("steering", True),
    ("title", True), ("transmission", True), ("trim", True), ("url", True),
]
_MEMBERS = " || ', ' || ".join(
    f"""'"{name}": ["' || replace({name}, '|', '", "') || '"]'""" if text is None else _json(name, text) for name, text in _FIELDS
)


@query("F21", f"SELECT listing_id, sha256('{{' || {_MEMBERS} || '}}') AS payload_hash FROM ({_PARSED}) p", "attrs places")
def listing_fingerprints(t):
    return with_fingerprint(parse_pages(B.listing_pages(t), B.BASE_URL)).select("listing_id", "payload_hash")


@query("F4", """
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_id * 1000 + 500 WHEN 1 THEN event_id * 1000 + 500 WHEN 2 THEN NULL
         WHEN 3 THEN NULL WHEN 4 THEN event_id + 1 ELSE NULL END AS price FROM events""")
def price_texts(t):
    n = F.col("event_id")
    number = (n * 1000 + 500).cast("string")
    thousands, units = F.substring(number, F.lit(1), F.length(number) - 3), F.substring(number, F.length(number) - 2, F.lit(3))
    shapes = [
        F.concat(F.lit("Car\n"), thousands, F.lit(" "), units, F.lit(" ₸")),
        F.concat(F.lit("Car\n"), thousands, F.lit(" "), units, F.lit(" ₸\n9 ₸")),
        F.concat(F.lit("Car 2020\n"), number, F.lit(" ₸")),
        F.lit("price on request ₸"),
        F.concat((n + 1).cast("string"), F.lit("₸")),
        F.concat(F.lit("no sign "), number),
    ]
    text = F.when(n % 6 == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], 1):
        text = text.when(n % 6 == i, shape)
    return t.events.select("event_id", H.price(text).alias("price"))


@query("F8", """
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id * 1000 WHEN 1 THEN event_id WHEN 2 THEN event_id WHEN 3 THEN NULL ELSE NULL END AS mileage FROM events""")
def mileage_texts(t):
    n, digits = F.col("event_id"), F.col("event_id").cast("string")
    text = (
        F.when(n % 5 == 0, F.concat(F.lit("Пробег: "), digits, F.lit(" 000 км")))
        .when(n % 5 == 1, F.concat(F.lit("x\nMileage "), digits, F.lit("KM")))
        .when(n % 5 == 2, F.concat(F.lit("y 5\n7 км\nПробег, км\n"), digits, F.lit(" km")))
        .when(n % 5 == 3, F.concat(F.lit("Пробег\n"), digits))
        .otherwise(F.lit("1 2 3"))
    )
    rows = t.events.select("event_id", text.alias("text")).withColumn("lines", F.split("text", "\n"))
    return rows.select("event_id", H.mileage(F.col("text"), F.col("lines")).cast("bigint").alias("mileage"))


@query("F5 F6 F7", """
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'v ' || event_id WHEN 1 THEN 'second' WHEN 2 THEN NULL ELSE NULL END AS region,
         CASE event_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS cleared FROM events""")
def label_values(t):
    n = F.col("event_id")
    text = (
        F.when(n % 4 == 0, F.concat(F.lit("Регион|v   "), n.cast("string"), F.lit("|Регион|later|Растаможен в Казахстане|Да")))
        .when(n % 4 == 1, F.lit("Область|second|Растаможен в Казахстане|Нет"))
        .when(n % 4 == 2, F.lit("Растаможен в Казахстане|да|Регион"))
        .otherwise(F.lit("nothing"))
    )
    rows = t.events.select("event_id", F.split(text, r"\|").alias("l"))
    region = F.coalesce(H.value_after(F.col("l"), "Регион"), H.value_after(F.col("l"), "Область"))
    cleared = H.tri_state(H.value_after(F.col("l"), "Растаможен в Казахстане"))
    return rows.select("event_id", region.alias("region"), cleared.alias("cleared"))


@query("F9 F10", """
  SELECT p_partkey, CAST(CASE p_partkey % 3 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size END AS DOUBLE) AS volume,
         CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 2 THEN 'hybrid' END AS fuel,
         CASE WHEN p_partkey % 2 = 0 THEN 'dealer' ELSE 'private' END AS seller_type FROM part""")
def engine_texts(t):
    n, size = F.col("p_partkey"), F.col("p_size").cast("string")
    raw = (
        F.when(n % 3 == 0, F.concat(size, F.lit(".5 ( "), F.lower("p_type"), F.lit(" ) (x)")))
        .when(n % 3 == 1, F.concat(F.lit("about "), size, F.lit(" l"))).otherwise(F.lit("(hybrid)"))
    )
    seller = F.when(n % 2 == 0, F.col("p_name"))
    return t.part.select("p_partkey", H.engine_volume(raw).alias("volume"), H.engine_type(raw).alias("fuel"), H.seller_type(seller).alias("seller_type"))


_BLOCK_HTML = """CASE page_id % 12 WHEN 0 THEN '<html>Captcha ' || page_id || '</html>' WHEN 1 THEN 'Cloudflare Ray ID' || html
  WHEN 2 THEN 'Checking your browser before accessing' || html WHEN 3 THEN 'Please complete the security check' || html
  WHEN 4 THEN 'Unusual traffic detected' || html WHEN 5 THEN 'Access denied, robot' || html WHEN 6 THEN 'Verify you are human' || html
  WHEN 7 THEN 'Captcha or challenge' || html WHEN 8 THEN replace(html, '<title>', '<title>Blocked: ') WHEN 9 THEN 'CF-RAY checking' || html
  WHEN 10 THEN 'cloudflare' || chr(10) || 'ray id' || html ELSE html END"""
def _any(words: list[str]) -> str:
    return "|".join(words)


@query("F17", f"""
  SELECT page_id, CASE
    WHEN length(h) < {fixed.SHORT_PAGE_CHARS} AND regexp_matches(h, '{_any(fixed.SHORT_PAGE_WORDS)}') THEN '{fixed.SHORT_PAGE_REASON}'
    {" ".join(f"WHEN regexp_matches(h, '{p}') THEN '{r}'" for p, r in fixed.BLOCK_PATTERNS)}
    WHEN regexp_matches(s, '{_any(fixed.BLOCK_TITLE_WORDS)}') THEN '{fixed.BLOCK_TITLE_REASON}' || s[:{fixed.BLOCK_TITLE_CHARS}]
    WHEN h LIKE '%cf-ray%' AND length(h) < {fixed.CF_RAY_CHARS} AND regexp_matches(h, '{_any(fixed.CF_RAY_WORDS)}') THEN '{fixed.CF_RAY_REASON}' END AS reason
  FROM (SELECT page_id, h, regexp_extract(h, '<title[^>]*>([^<]+)</title>', 1) AS s FROM (SELECT page_id, lower({_BLOCK_HTML}) AS h FROM pages) a) q""")
def block_reasons(t):
    html = F.expr(_BLOCK_HTML.replace("chr(10)", "char(10)"))
    return t.pages.select("page_id", H.block_reason(html).alias("reason"))


@query("F12 P12 W5 F19", f"""
  SELECT page_id, url || '|{BASE}/rel/' || page_id || '|{BASE}/quoted' AS photos FROM pages""")
def photo_urls(t):
    html = F.concat(
        F.lit('<img data-src="" src="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("\"><IMG alt='src=' data-lazy-src=/rel/"),
        F.col("page_id").cast("string"), F.lit(">"), F.lit("<img alt=\"1>0\" src='/quoted'><img src='ftp://no'><!-- <img src='/hidden'> --><img alt=none><img src=\""),
        F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('">'),
    )
    return t.pages.select("page_id", H.photos(H.without_hidden(html), B.BASE_URL).alias("photos"))


@query("F11", """
  SELECT event_id, CASE WHEN event_id % 3 = 2 THEN '' ELSE array_to_string(list_transform(range(event_id % 25), lambda i: 'option ' || i), '|') END AS options FROM events""")
def option_blocks(t):
    """Up to 24 lines, cut by a heading or absent."""
    n = F.col("event_id")
    many = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.concat(F.lit("option "), i.cast("string")))
    body = F.concat(F.slice(many, F.lit(1), (n % 25).cast("int")), F.array(F.when(n % 2 == 0, "Кузов").otherwise("PHOTOS 12")), F.array(F.lit("after")))
    head = F.when(n % 3 == 2, F.array(F.lit("no header"))).otherwise(F.array(F.lit("x"), F.lit("Опции и характеристики")))
    return t.events.select("event_id", H.options(F.concat(head, body)).alias("options"))


@query("F1", f"SELECT doc_id, md5({_clean('text')}) AS digest, length({_clean('text')}) AS n FROM documents")
def cleaned_documents(t):
    text = clean(F.col("text"))
    return t.documents.select("doc_id", F.md5(text).alias("digest"), F.length(text).cast("bigint").alias("n"))


def _redact(text: str) -> str:
    """The fixed redactions as SQL, with white space as the text functions see it."""
    out = text
    for pattern, replacement in fixed.REDACTIONS:
        spaced = pattern.replace('''[^"'\\s]+''', f'''[^"'{WS[1:-1]}]+''').replace("\\s", WS).replace("'", "''")
        out = f"regexp_replace({out}, '{spaced}', '{replacement.replace('$', chr(92))}', 'gi')"
    return out


@query("F18", f"SELECT doc_id, md5({_redact('text')}) AS digest, {_redact('text')} <> text AS changed FROM documents")
def redacted_documents(t):
    from motorlake.functions.text import redact_secrets
    safe = redact_secrets(F.col("text"))
    return t.documents.select("doc_id", F.md5(safe).alias("digest"), (safe != F.col("text")).alias("changed"))


@query("F18", f"""
  SELECT event_id, {_redact("s")} AS message FROM (SELECT event_id,
    'postgresql://u' || user_id || ':p' || event_id || '@db/x Password = "k' || event_id || '" MINIO_SECRET_KEY: ''z''' AS s FROM events) q""")
def redacted_messages(t):
    from motorlake.functions.text import redact_secrets
    message = F.concat(
        F.lit("postgresql://u"), F.col("user_id").cast("string"), F.lit(":p"), F.col("event_id").cast("string"),
        F.lit('@db/x Password = "k'), F.col("event_id").cast("string"), F.lit("\" MINIO_SECRET_KEY: 'z'"),
    )
    return t.events.select("event_id", redact_secrets(message).alias("message"))


@query("F20", "SELECT page_id, sha256(html) AS sha256 FROM pages")
def page_hashes(t):
    return t.pages.select("page_id", sha256_hex(F.col("html")).alias("sha256"))

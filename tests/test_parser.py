from pyspark.sql import functions as F

from motorlake.functions import html as H
from motorlake.plans.parse import parse_pages, with_fingerprint
from motorlake.schemas import PAGE, PARSED

BASE = "https://cars.example"

PRIVATE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<h1>no</h1>";</script></head><body>
<h1 data-note="7>5">Zebro Lumina Quartz 2011 г.</h1><div class="price">
   3 217 450 ₸
</div><dl><dt>Город</dt><dd>Верхний Порт</dd><dt>Кузов</dt><dd>фургон</dd>
<dt>Объем двигателя, л</dt><dd>1.3 (газ)</dd><dt>Растаможен в Казахстане</dt><dd>Да</dd></dl>
<img alt="a>b" src="https://img.example/q/7.png"/><img src="https://img.example/q/8.png" /></body></html>"""

DEALER = """<html><body><h1>Orbita K-9 Sport Line 2004 г.</h1><p>918 004 ₸</p>
<dl><dt>Город</dt><dd>Нижний Порт</dd><dt>Регион</dt><dd>Озёрный край</dd><dt>Пробег</dt><dd>204 318 км</dd>
<dt>Объем двигателя, л</dt><dd>4 (дизель)</dd><dt>Растаможен в Казахстане</dt><dd>Нет</dd></dl>
<div>Проверенный продавец</div><div>Гараж №5</div>
<h2>Опции и характеристики</h2><p>Фаркоп</p><p>Лебёдка 12В</p><p>КОНТАКТЫ</p><p>после</p>
<img src="/r/1.webp"><img data-src="https://img.example/r/2.webp" src="blank.gif"><img src="/r/1.webp"><img src="data:image">
</body></html>"""


def parse(spark, *pages):
    df = spark.createDataFrame([(i, f"{BASE}/a/show/{i}", html) for i, html in enumerate(pages)], PAGE)
    return [r.asDict() for r in parse_pages(df, BASE).orderBy("listing_id").collect()]


def test_schema_matches(spark):
    df = parse_pages(spark.createDataFrame([(1, "u", "<h1>A B</h1>")], PAGE), BASE)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in PARSED]


def test_private_listing(spark):
    (r,) = parse(spark, PRIVATE)
    assert (r["price_kzt"], r["make"], r["model"], r["trim"], r["car_year"]) == (3217450, "Zebro", "Lumina", "Quartz", 2011)
    assert (r["city"], r["engine_volume_l"], r["engine_type"], r["customs_cleared"]) == ("Верхний Порт", 1.3, "газ", True)
    assert r["photos"] == ["https://img.example/q/7.png", "https://img.example/q/8.png"] and r["photo_count"] == 2
    assert r["seller_type"] == "private" and r["options_list"] == [] and r["options_text"] is None


def test_dealer_listing(spark):
    (r,) = parse(spark, DEALER)
    assert (r["price_kzt"], r["make"], r["model"], r["trim"], r["car_year"]) == (918004, "Orbita", "K-9", "Sport", 2004)
    assert (r["city"], r["region"], r["mileage_km"]) == ("Нижний Порт", "Озёрный край", 204318)
    assert (r["seller_type"], r["seller_name"], r["customs_cleared"]) == ("dealer", "Гараж №5", False)
    assert r["options_text"] == "Фаркоп; Лебёдка 12В"
    assert r["photos"] == [f"{BASE}/r/1.webp", "https://img.example/r/2.webp"]


MANY = "".join(f"<p>option {i}</p>" for i in range(30))
EDGES = [
    ("<h1>Снято с показа</h1>", "price_kzt", None),
    ("<h1>Pluto X</h1><p>7 ₸</p>", "price_kzt", 7),
    ("<h1>Pluto X</h1><div>x: 61 002 км</div>", "mileage_km", 61002),
    ("<h1>Pluto X 1999</h1>", "trim", None),
    ("<h1>Solo</h1>", "make", None),
    ("<p>1987<br>31 400 ₸</p>", "price_kzt", None),
    ("<h1>A &amp;lt; B&nbsp;&#8376; &#x20B8; &bogus; &copy;</h1>", "title", "A &lt; B ₸ ₸ &bogus; ©"),
    ("<h1>A<!-- x --> <b>B</b></h1>", "title", "A B"),
    ("<p>Город</p>", "city", None),
    ("<p>Область</p><p> Дальний   берег </p>", "region", "Дальний берег"),
    # Numbers that are no character, Windows-1252 numbers, numbers without ';', the apostrophe's name.
    ("<h1>&#9999999; &#xFFFFFF; &#xD800; &#0; &#99999999999999999999; &#x;</h1>", "title", "\ufffd \ufffd \ufffd \ufffd \ufffd &#x;"),
    ("<h1>a&#150;b &#x92; &#129;</h1>", "title", "a\u2013b \u2019 \ufffd"),
    ("<h1>&#8376 x &#x20B8y &apos;q&apos;</h1>", "title", "₸ x ₸y 'q'"),
    # '>' inside attribute values, unclosed quotes, a tag that never ends.
    ("<h1 data-x=\"q>r\">Zebro <b title='a>b'>Vega</b></h1>", "title", "Zebro Vega"),
    ("<h1 it's>Zebro Vega</h1>", "title", "Zebro Vega"),
    ("<h1 x=\"y>Zebro Vega</h1>", "title", "Zebro Vega"),
    ("<img alt='1>0' src=\"/z.jpg\">", "photos", [f"{BASE}/z.jpg"]),
    ("<h1>Zebro Vega</h1><a " + "b=c " * 20000, "title", "Zebro Vega"),
    (f"<p>Опции и характеристики</p>{MANY}<p>Кузов</p>", "options_list", [f"option {i}" for i in range(30)]),
]


def test_edges(spark):
    parsed = parse(spark, *[html for html, _, _ in EDGES])
    assert [r[field] for r, (_, field, _) in zip(parsed, EDGES)] == [value for _, _, value in EDGES]


def test_long_digit_run_is_cheap(spark):
    (r,) = parse(spark, "<p>" + "7" * 5000 + "</p>")
    assert r["mileage_km"] is None


def test_mileage_beyond_32_bits(spark):
    text = "Пробег: 4000000 000 км\nПробег\n5 км"
    lines = F.split(F.lit(text), "\n")
    assert spark.range(1).select(H.mileage(F.lit(text), lines)).first()[0] == 4_000_000_000
    (r,) = parse(spark, "<p>4000000 000 км</p><p>Пробег</p><p>5 км</p>")
    assert r["mileage_km"] is None  # the column has 32 bits; the label speaks only where the text has no number


def test_fingerprint_is_key_sorted_json(spark):
    import hashlib
    import json

    (r,) = parse(spark, DEALER)
    df = spark.createDataFrame([(0, f"{BASE}/a/show/0", DEALER)], PAGE)
    (got,) = with_fingerprint(parse_pages(df, BASE)).select("payload_hash").collect()
    want = json.dumps(r, ensure_ascii=False, sort_keys=True).encode("utf-8")
    assert got[0] == hashlib.sha256(want).hexdigest()


def test_no_python_worker_and_one_line_array(spark):
    df = parse_pages(spark.createDataFrame([(1, "u", PRIVATE)], PAGE), BASE)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("(script|style|template)") == 1 and plan.count("filter(") <= 6

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as dt
from tidemark.functions import numbers as n
from tidemark.functions import text as t


def values(spark, fn, *inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i long, x string")
    return [row.v for row in df.select("i", fn(F.col("x")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("fn, pairs", [
    (n.abbreviated_count, {"1.5K+": 1500, "2M": 2_000_000, "300+ bought in past month": 300, "1,2k": 1200, "50 month": 50, "none": 0, "": 0, None: 0}),
    (n.bought_in_html, {"<b>1K+ bought": 1000, "x>50+  Bought<": 50, ">1,234 bought": 1, "bought 7": 0}),
    (n.best_rank, {"#45 in Pens (See Top 100 in Office)": 45, "Nr. 1.234 in Foo": 1234, "141 in Bar, #7": 7, "#0": 0, "#99999999": 0, "": 0}),
    (n.loose_number, {"12,5 kr": 12.5, "1 234,50 SEK": 1234.5, "1 234": 1234.0, "No data": None, "—": None, "0,00": None, "x": None, "EPC 7": 7.0}),
    (n.price_number, {"1.234,56 kr": 1234.56, "$1,234.56": 1234.56, "12,5": 125.0, "12,50": 12.5, "1,234": 1.234, "1,234,567": 1234567.0,
                      "1.2.3": None, "kr": None, "99.9": 99.9}),
    (n.simple_price, {"1 299,90 kr": 1299.9, "12.5": 12.5, "1.2.3": None}),
    (n.spaced_integer, {"12 345": 12345, "1 000": 1000, "x": None}),
    (n.hash_rank, {"#270\nLifestyle": 270, "270": None}),
    (t.canonical, {"Chair (Grey-Blue): 2.0": "chair grey blue 2 0", None: "", "A®B": "a b"}),
    (t.slug, {"Lamp & Son": "lamp-son", "Big Oak-Table": "big-oak-table", "--": ""}),
    (t.unslug, {"big-oak-table": "Big Oak Table", "led2go-3m": "Led2Go 3M"}),
    (t.strip_suffix, {"Foo AB": "foo", "Foo A/S ": "foo", "Absolut": "absolut", "Foo Gmbh Ltd": "foo gmbh"}),
    (t.org_number, {"556668-4345": "5566684345"}),
    (t.two_level_path, {"A>B > C": "A>B", "A": "A"}),
    (dt.without_zone, {"2024-01-01+02:00": "2024-01-01", "2024-01-01Z": "2024-01-01"}),
])
def test_scalar(spark, fn, pairs):
    assert dict(zip(pairs, values(spark, fn, *pairs))) == pairs


def test_currency(spark):
    got = spark.createDataFrame([("5 kr", "Denmark"), ("5 kr", "Spain"), ("5 kr.", "Norway"), ("3 dkk", "Sweden"), ("5 €", "x"), ("9 zł", "x"),
                                 ("5 Fr", "x"), ("4SEK", "x"), ("5", "Sweden")], "t string, c string")
    rows = got.select(n.currency_of(F.col("t"), F.col("c")).alias("v")).collect()
    assert [r.v for r in rows] == ["DKK", "SEK", "NOK", "DKK", "EUR", "PLN", "CHF", "SEK", None]


def test_repair_text(spark):
    good = ["Väggarmatur", "Övrigt – ‘test’ €5", "plain", "Ã is meant", "日本 Ã¤"]
    damaged = [x.encode("utf-8").decode("cp1252") for x in good[:2]] + good[2:]
    assert values(spark, t.repair_garbled, *damaged) == good


def test_discount_and_share(spark):
    df = spark.createDataFrame([(80.0, 100.0), (100.0, 100.0), (5.0, 0.0)], "s double, l double")
    assert [r.v for r in df.select(n.discount_pct(F.col("s"), F.col("l")).alias("v")).collect()] == [20.0, 0.0, 0.0]
    assert [r.v for r in df.select(n.share(F.col("s"), F.col("l")).alias("v")).collect()] == [80.0, 100.0, None]


def test_table_column_and_numeric_sum(spark):
    html = "<table><tr><th>A</th></tr><tr><td>1</td></tr></table><table><thead><tr><th>n</th><th>EPC (kr)</th></tr></thead>" \
           "<tr><td>x</td><td> 5,0 <b>kr</b></td></tr><tr><td>only</td></tr></table>"
    assert values(spark, lambda c: t.table_column(c, "epc"), html) == [["5,0 kr"]]
    assert values(spark, lambda c: n.numeric_sum(F.split(c, ";")), "1;x;2.5", "x", "") == [3.5, None, None]


def test_relaxed_map_and_link_values(spark):
    assert values(spark, t.relaxed_map, "{'a': 'b', 'c': null}", "not a map", None) == [{"a": "b", "c": None}, {}, {}]
    page = 'x search?brand=Big+Oak%2DTable&amp;p=1" search?brand=7S" search?brand=7S"'
    assert values(spark, lambda c: t.link_values(c, r"search\?brand="), page) == [["Big Oak-Table", "7S"]]


def test_company_test_before_parsing(spark):
    rows = [("<n>EQL PHARMA ab</n>", "EQL Pharma AB", True), ("<n>other</n>", "EQL Pharma AB", False), ("<n>A.B (x)</n>", "a.b (x) GmbH", True),
            ("<n>aXb (x)</n>", "a.b (x) GmbH", False), ("<n>a&#66;</n>", "zz", True), ("<n>buİld</n>", "bui", True), ("<n>ÅÄÖ co</n>", "åäö Ltd", True)]
    df = spark.createDataFrame(rows, "markup string, company string, want boolean")
    got = df.select(t.may_name_company(F.col("markup"), F.col("company")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_members_of_any_shape(spark):
    docs = ['{"a-b": {"swe": ["t", "u"], "bul": "x"}, "n": [1, "2.5", "x", null], "z": null}', '{"a-b": {"fra": ["f"], "bul": "x"}, "n": "7"}',
            '{"a-b": "plain", "n": 3, "z": 0}', '{"a-b": ["p", 2], "n": ["x"], "z": []}', '{"a-b": 12, "n": {}, "z": ""}', "{}", "no json", None,
            '{"a-b": {}, "n": true, "z": "0"}', '{"a-b": {"eng": null, "swe": "s"}, "z": {"k": 1}}']
    df = spark.createDataFrame([(k, d) for k, d in enumerate(docs)], "k int, d string").withColumn("v", F.try_parse_json("d"))
    out = df.select("k", t.member_texts(F.col("v"), F.col("d"), ["a-b", "z"]).alias("t"), n.any_number(t.member(F.col("v"), "n")).alias("n"),
                    t.any_texts(t.member(F.col("v"), "a-b")).alias("list"), t.is_given(t.member(F.col("v"), "z")).alias("given")).orderBy("k").collect()
    assert [r.t and r.t["a-b"] for r in out] == ["t, u", "f", "plain", "p, 2", "12", "", "", "", "", "s"]
    assert [r.n for r in out] == [3.5, 7.0, 3.0, None, None, None, None, None, None, None]
    assert [r.list for r in out][2:6] == [["plain"], ["p", "2"], ["12"], []]
    assert [bool(r.given) for r in out] == [False] * 8 + [True, True]

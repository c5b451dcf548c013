"""Check queries: scalar functions over text that Spark derives from the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates as dt
from tidemark.functions import numbers as n
from tidemark.functions import rules
from tidemark.functions import text as t
from tidemark.functions.fixed_values import NOTICE_TYPE_LABELS
from tidemark.workload import bindings as b
from tidemark.workload.registry import query, table


def _int(column: str):
    return F.col(column).cast("bigint")


def _pick(index, *values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


@query("c1_abbreviated_count", """
    SELECT DISTINCT q || '.' || l || suffix AS text, CASE suffix WHEN 'K+ bought' THEN trunc((q || '.' || l)::DOUBLE * 1000)
           WHEN 'm' THEN trunc((q || '.' || l)::DOUBLE * 1000000) ELSE q END::BIGINT AS bought
    FROM (SELECT l_quantity::BIGINT AS q, l_linenumber AS l, ['K+ bought','m','+ mal',' kg'][(l_suppkey % 4 + 1)::INT] AS suffix FROM lineitem)""")
def c1(spark, d):
    text = F.concat(_int("l_quantity"), F.lit("."), "l_linenumber", _pick(F.col("l_suppkey") % 4, "K+ bought", "m", "+ mal", " kg"))
    return table(spark, d, "lineitem").select(text.alias("text")).distinct().select("text", n.abbreviated_count(F.col("text")).alias("bought"))


@query("c2_bought_in_html", """
    SELECT l_suppkey % 3 AS shape, l_quantity::BIGINT AS q, count(*) AS n,
           CASE l_suppkey % 3 WHEN 0 THEN l_quantity * 1000 WHEN 1 THEN l_quantity ELSE 0 END::BIGINT AS bought
    FROM lineitem GROUP BY ALL""")
def c2(spark, d):
    shape, q = F.col("l_suppkey") % 3, _int("l_quantity")
    html = F.when(shape == 0, F.concat(F.lit("<p>x</p><b>"), q, F.lit("K+ bought in past month</b>"))).when(
        shape == 1, F.concat(F.lit("<i class='a'>"), q, F.lit("+  Bought</i>"))).otherwise(
        F.concat(F.lit("<b>was bought "), q, F.lit(" times</b>")))
    return table(spark, d, "lineitem").select(shape.alias("shape"), q.alias("q"), n.bought_in_html(html).alias("bought")).groupBy(
        "shape", "q", "bought").agg(F.count(F.lit(1)).alias("n"))


@query("c3_best_rank", """
    SELECT l_linenumber::BIGINT AS l, sum(least(CASE WHEN l_partkey > 0 THEN l_partkey ELSE 99999999 END,
               CASE WHEN l_suppkey > 0 THEN l_suppkey * 3 ELSE 99999999 END,
               CASE WHEN l_orderkey > 0 THEN l_orderkey ELSE 99999999 END))::BIGINT AS ranks
    FROM lineitem GROUP BY ALL""")
def c3(spark, d):
    text = F.concat(F.lit("Top 100 in Shoes #"), "l_partkey", F.lit(" Nr. "), F.col("l_suppkey") * 3, F.lit(" - "),
                    "l_orderkey", F.lit(" in Bags (see TOP  100 in Hats)"))
    return table(spark, d, "lineitem").groupBy(_int("l_linenumber").alias("l")).agg(F.sum(n.best_rank(text)).alias("ranks"))


@query("c4_loose_number", """
    SELECT s, p, l, CASE WHEN l = 7 THEN NULL WHEN l = 6 THEN (s || p || '.' || l)::DOUBLE WHEN l = 5 THEN nullif(s, 0)::DOUBLE
           ELSE (s || p || '.' || l)::DOUBLE END AS value
    FROM (SELECT DISTINCT l_suppkey AS s, 100 + l_partkey % 900 AS p, l_linenumber::BIGINT AS l FROM lineitem)""")
def c4(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("s"), (100 + F.col("l_partkey") % 900).alias("p"), _int("l_linenumber").alias("l")).distinct()
    text = F.when(F.col("l") == 7, "No data").when(
        F.col("l") == 6, F.concat("s", F.lit("\u00a0"), "p", F.lit("."), "l", F.lit("  EUR"))).when(
        F.col("l") == 5, F.concat(F.lit("EPC "), "s", F.lit(" kr "), "p")).otherwise(
        F.concat(F.lit(" ca "), "s", F.lit(" "), "p", F.lit(","), "l", F.lit(" kr")))
    return rows.select("s", "p", "l", n.loose_number(text).alias("value"))


@query("c5_price_number", """
    SELECT s, p, l, CASE l WHEN 1 THEN (s || p || '.25')::DOUBLE WHEN 2 THEN (s || p || '.25')::DOUBLE
           WHEN 3 THEN (s || p || '5')::DOUBLE WHEN 4 THEN (s || '.50')::DOUBLE WHEN 5 THEN (s || '.' || p)::DOUBLE
           WHEN 6 THEN (s || p || p)::DOUBLE END AS value
    FROM (SELECT DISTINCT l_suppkey AS s, 100 + l_partkey % 900 AS p, l_linenumber::BIGINT AS l FROM lineitem)""")
def c5(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("s"), (100 + F.col("l_partkey") % 900).alias("p"), _int("l_linenumber").alias("l")).distinct()
    place = F.col("l")
    text = (
        F.when(place == 1, F.concat("s", F.lit("."), "p", F.lit(",25 kr"))).when(place == 2, F.concat(F.lit("$"), "s", F.lit(","), "p", F.lit(".25")))
        .when(place == 3, F.concat("s", "p", F.lit(",5"))).when(place == 4, F.concat("s", F.lit(",50 kr")))
        .when(place == 5, F.concat("s", F.lit(","), "p")).when(place == 6, F.concat("s", F.lit(","), "p", F.lit(","), "p")).otherwise("kr"))
    return rows.select("s", "p", "l", n.price_number(text).alias("value"))


@query("c6_simple_numbers", """
    SELECT p_partkey, (p_partkey || '.' || p_size)::DOUBLE AS price, (p_size || '' || (1000 + p_partkey))::BIGINT AS spaced,
           p_partkey AS rank FROM part""")
def c6(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", n.simple_price(F.concat(F.lit("SEK "), "p_partkey", F.lit(","), "p_size")).alias("price"),
        n.spaced_integer(F.concat("p_size", F.lit(" \u00a0"), 1000 + F.col("p_partkey"))).alias("spaced"),
        n.hash_rank(F.concat(F.lit("#"), "p_partkey", F.lit("\nTools - Installs"))).alias("rank"))


@query("c7_currency_of_cell", """
    SELECT k, c, count(*) AS n, CASE k WHEN 0 THEN 'EUR' WHEN 1 THEN 'EUR' WHEN 2 THEN 'PLN' WHEN 3 THEN 'CHF' WHEN 6 THEN 'SEK' WHEN 7 THEN NULL
           ELSE ['SEK','DKK','NOK','SEK'][c + 1] END AS currency
    FROM (SELECT c_custkey % 8 AS k, (c_nationkey % 4)::BIGINT AS c FROM customer) GROUP BY ALL""")
def c7(spark, d):
    k, c = F.col("c_custkey") % 8, _int("c_nationkey") % 4
    text = _pick(k, "12 eur", "€ 12", "9 ZŁ", "5 Fr", "7 kr", "7 KR.", "SEK4kr", "4 francs")
    seen = n.currency_of(text, _pick(c, "Sweden", "Denmark", "Norway", "Finland"))
    return table(spark, d, "customer").groupBy(k.alias("k"), c.alias("c"), seen.alias("currency")).agg(F.count(F.lit(1)).alias("n"))


@query("c8_price_fallbacks", """
    SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size + 0.5::DOUBLE WHEN 2 THEN p_size + 1.5::DOUBLE END AS first_known,
           CASE WHEN p_size % 4 = 0 THEN p_retailprice WHEN p_size % 4 = 1 THEN p_size + 0.5::DOUBLE ELSE p_retailprice END AS field_price
    FROM part""")
def c8(spark, d):
    kind, size = F.col("p_size") % 4, F.col("p_size")
    sale = F.when(kind == 1, F.create_map(F.lit("SEK"), (size + 0.5).cast("string"))).otherwise(
        F.create_map(F.lit("EUR"), F.lit("1")))
    regular = F.when(kind == 2, F.create_map(F.lit("SEK"), (size + 1.5).cast("string")))
    own = F.when(kind == 0, F.col("p_retailprice").cast("string")).when(kind == 3, "soon")
    raw = F.when(kind == 0, F.concat(F.lit('{"max":1,"min":'), "p_retailprice", F.lit("}"))).when(
        kind == 1, F.concat(F.lit('"'), size + 0.5, F.lit('"'))).otherwise("0")
    return table(spark, d, "part").select(
        "p_partkey", n.first_price(own, F.try_element_at(sale, F.lit("SEK")), F.try_element_at(regular, F.lit("SEK"))).alias("first_known"),
        F.coalesce(F.nullif(n.price_field(raw), F.lit(0.0)), F.col("p_retailprice")).alias("field_price"))


@query("c9_discount_percent", """
    SELECT l_partkey % 300 AS sell, l_suppkey % 300 AS list, count(*) AS n,
           CASE WHEN l_suppkey % 300 > 0 AND l_partkey % 300 < l_suppkey % 300
                THEN round_even(100.0::DOUBLE * (1.0::DOUBLE - (l_partkey % 300)::DOUBLE / (l_suppkey % 300)), 1) ELSE 0 END AS pct
    FROM lineitem GROUP BY ALL""")
def c9(spark, d):
    sell, listed = F.col("l_partkey") % 300, F.col("l_suppkey") % 300
    pct = n.discount_pct(sell.cast("double"), listed.cast("double"))
    return table(spark, d, "lineitem").groupBy(sell.alias("sell"), listed.alias("list"), pct.alias("pct")).agg(F.count(F.lit(1)).alias("n"))


@query("c10_keyword_categories", """
    SELECT p_partkey, CASE WHEN p_partkey = 7 THEN 'Pinned' WHEN p_name LIKE '%ring%' THEN 'Rings' WHEN p_name LIKE '%red%' THEN 'Red'
           WHEN p_name LIKE '%bolt%' THEN 'Bolts' ELSE 'Övrigt' END AS category,
           CASE WHEN p_size % 5 = 0 THEN 'Clothing' WHEN p_size % 5 = 1 THEN p_name WHEN p_name LIKE '%ring%' THEN 'Rings' WHEN p_name LIKE '%red%' THEN 'Red'
           WHEN p_name LIKE '%bolt%' THEN 'Bolts' ELSE p_name END AS crumb
    FROM (SELECT p_partkey, p_size, CASE WHEN p_size % 5 = 1 THEN p_brand ELSE p_name END AS p_name FROM part)""")
def c10(spark, d):
    parts = table(spark, d, "part").withColumn("name", F.when(F.col("p_size") % 5 == 1, F.col("p_brand")).otherwise(F.col("p_name")))
    rule_list = [("ring", "Rings"), ("red", "Red"), ("bolt", "Bolts")]
    crumb = F.when(F.col("p_size") % 5 == 0, "").when(F.col("p_size") % 5 == 1, F.col("name")).otherwise(
        F.concat("p_type", F.lit(" > "), F.col("name"), F.lit(" > "), "p_brand"))
    return parts.select(
        "p_partkey", t.categorise(F.col("p_partkey").cast("string"), F.upper("name"), rule_list, {"7": "Pinned"}, "Övrigt").alias("category"),
        t.breadcrumb_category(crumb, rule_list, F.lit("Clothing")).alias("crumb"))


@query("c11_path_levels", """
    SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_type || '>' || p_brand END AS short_path,
           CASE WHEN p_size % 3 = 0 THEN 'Other' ELSE p_name END AS label
    FROM part""")
def c11(spark, d):
    third = F.col("p_size") % 3 == 0
    path = F.when(third, F.col("p_type")).otherwise(F.concat("p_type", F.lit(" > "), "p_brand", F.lit(" >"), "p_name"))
    labels = F.when(third, F.array(F.lit(""), F.lit(None).cast("string"))).otherwise(F.array("p_type", "p_name", F.lit("")))
    return table(spark, d, "part").select(t.two_level_path(path).alias("short_path"), t.deepest_label(labels).alias("label")).distinct()


@query("c12_base_key", f"""
    SELECT split_part(key, '-', 1) AS first_cut, split_part(key, '-', 1) || '-' || split_part(key, '-', 2) AS last_cut, count(*) AS n
    FROM (SELECT key || '-' || market AS key FROM ({b.COUNTER_SNAPSHOT})) GROUP BY ALL""")
def c12(spark, d):
    key = F.concat_ws("-", "key", "market")
    return b.counter_snapshot(spark, d).groupBy(
        t.base_key(key).alias("first_cut"), t.base_key(key, "last").alias("last_cut")).agg(F.count(F.lit(1)).alias("n"))


@query("c13_canonical_text", r"""
    SELECT page_id, trim(regexp_replace(lower(url), '[\s\-()\[\],.:/®™]+', ' ', 'g')) AS canonical FROM pages""")
def c13(spark, d):
    return table(spark, d, "pages").select("page_id", t.canonical(F.col("url")).alias("canonical"))


@query("c14_slugs", r"""
    SELECT DISTINCT trim(regexp_replace(lower(p_name || ' & ' || p_brand || '!'), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
           upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(split_part(p_name, ' ', 2)[1]) || substr(split_part(p_name, ' ', 2), 2)
               AS title
    FROM part""")
def c14(spark, d):
    name = F.concat("p_name", F.lit(" & "), "p_brand", F.lit("!"))
    return table(spark, d, "part").select(
        t.slug(name).alias("slug"), t.unslug(t.slug(F.col("p_name"))).alias("title")).distinct()


@query("c15_link_values", r"""
    SELECT DISTINCT page_id, url_decode(replace(v, '+', ' ')) AS brand
    FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"&\s]+)', 1)) AS v FROM pages)""")
def c15(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(t.link_values(F.col("html"), 'href="/')).alias("brand"))


@query("c15_path_slugs", r"""
    SELECT DISTINCT page_id, slug FROM (
        SELECT page_id, unnest(regexp_extract_all(html, 'href="/([A-Za-z0-9][A-Za-z0-9-]+)["\s]', 1)) AS slug FROM pages
        UNION ALL SELECT page_id, unnest(regexp_extract_all(html, 'href="/([A-Za-z0-9][A-Za-z0-9-]+)\.html', 1)) FROM pages)""")
def c15_slugs(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(t.path_slugs(F.col("html"), 'href="/')).alias("slug"))


@query("c16_language_pick", """
    SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_name || ', ' || p_brand WHEN 1 THEN p_type WHEN 2 THEN p_brand ELSE '' END AS text,
           CASE p_size % 4 WHEN 0 THEN 'e' WHEN 1 THEN 's' WHEN 2 THEN 'f' ELSE '' END AS link,
           CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_type WHEN 2 THEN p_brand ELSE 'none' END AS name
    FROM part""")
def c16(spark, d):
    kind = F.col("p_size") % 4
    doc = F.when(kind == 0, F.to_json(F.struct(F.array("p_type").alias("fra"), F.array("p_name", "p_brand").alias("eng"), F.array("p_type").alias("swe")))).when(
        kind == 1, F.to_json(F.struct(F.array("p_name").alias("fra"), F.array("p_type").alias("swe")))).when(
        kind == 2, F.to_json(F.struct(F.array("p_brand").alias("fra"))))
    link = F.when(kind == 0, '{"FRA":"f","ENG":"e"}').when(kind == 1, '{"FRA":"f","SWE":"s"}').when(kind == 2, '{"FRA":"f"}')
    names = F.when(kind == 0, F.create_map(F.lit("en"), F.col("p_brand"), F.lit("sv"), F.col("p_name"))).when(
        kind == 1, F.create_map(F.lit("en"), F.col("p_type"), F.lit("sv"), F.lit(""))).when(
        kind == 2, F.create_map(F.lit("de"), F.col("p_brand")))
    return table(spark, d, "part").select(
        "p_partkey", t.pick_language(F.from_json(doc, "map<string,array<string>>")).alias("text"),
        t.pick_link(F.from_json(link, "map<string,string>")).alias("link"),
        t.pick_name(names, ("sv", "en"), F.lit("none")).alias("name"))


@query("c17_numeric_sum", """
    SELECT l_suppkey, sum(CASE WHEN l_linenumber <> 3 THEN l_quantity + l_linenumber END)::BIGINT AS total,
           count(*) FILTER (l_linenumber = 3) AS without_number FROM lineitem GROUP BY ALL""")
def c17(spark, d):
    items = F.when(F.col("l_linenumber") == 3, F.array(F.lit("n/a"))).otherwise(
        F.array(F.col("l_quantity").cast("string"), F.lit("n/a"), F.col("l_linenumber").cast("string")))
    value = n.numeric_sum(items)
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.sum(value).cast("bigint").alias("total"), F.count_if(value.isNull()).alias("without_number"))


@query("c18_org_numbers", r"""
    SELECT c_custkey, regexp_replace(c_name, '[^0-9A-Za-z]', '', 'g') AS org,
           CASE WHEN c_nationkey % 3 = 2 THEN lower(c_name) || ' gmbh holding' ELSE lower(c_name) END AS core FROM customer""")
def c18(spark, d):
    form = _pick(F.col("c_nationkey") % 3, " GmbH ", " A/S", " GmbH Holding")
    return table(spark, d, "customer").select(
        "c_custkey", t.org_number(F.concat("c_name", F.lit(" -"))).alias("org"), t.strip_suffix(F.concat("c_name", form)).alias("core"))


@query("c19_code_labels", """
    SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'Contract Notice' WHEN '2-HIGH' THEN 'Subcontracting Notice'
           WHEN '3-MEDIUM' THEN 'Contract Modification Notice' ELSE o_orderpriority END AS label, count(*) AS n FROM orders GROUP BY ALL""")
def c19(spark, d):
    codes = {"1-URGENT": "cn-standard", "2-HIGH": "subco", "3-MEDIUM": "can-modif"}
    code = t.relabel(F.col("o_orderpriority"), codes)
    return table(spark, d, "orders").groupBy("o_orderpriority", t.relabel(code, NOTICE_TYPE_LABELS).alias("label")).agg(
        F.count(F.lit(1)).alias("n"))


@query("c20_durations", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 5 > 0 THEN
           round_even((DATE '2002-01-01' - o_orderdate::DATE) / 365.25::DOUBLE, 1) END AS years FROM orders""")
def c20(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    zoned = F.concat(day, _pick(F.col("o_orderkey") % 3, "+02:00", "Z", ""))
    end = F.when(F.col("o_orderkey") % 5 > 0, "2002-01-01").otherwise("unknown")
    return table(spark, d, "orders").select(
        "o_orderkey", dt.without_zone(zoned).alias("day"), dt.duration_years(dt.without_zone(zoned), end).alias("years"))


@query("c21_framework_flag", """
    SELECT l_orderkey, (bool_or(l_returnflag = 'R') OR max(CASE WHEN l_quantity > 45 THEN l_quantity END) IS NOT NULL
           OR (count(*) FILTER (l_linestatus = 'F') = count(*) AND count(*) > 1))::BIGINT AS is_framework
    FROM lineitem GROUP BY ALL""")
def c21(spark, d):
    facts = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.when(F.col("l_returnflag") == "R", True)).alias("marked"),
        F.max(F.when(F.col("l_quantity") > 45, F.col("l_quantity"))).alias("top"),
        F.count_if(F.col("l_linestatus") == "F").alias("winners"), F.count(F.lit(1)).alias("tenders"))
    flag = rules.framework_flag(F.col("marked"), F.col("top"), F.col("winners"), F.col("tenders"))
    return facts.select("l_orderkey", flag.alias("is_framework"))


@query("c22_roles", """
    SELECT o_orderstatus, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 'Winner' WHEN o_orderpriority < '2' THEN 'Tenderer'
           WHEN o_orderpriority < '3' THEN 'Buyer' ELSE 'Mentioned' END AS role,
           CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'P' THEN 'No' ELSE '' END AS won, count(*) AS n
    FROM orders GROUP BY ALL""")
def c22(spark, d):
    won, low = F.col("o_orderstatus") == "F", F.col("o_orderpriority")
    winner = F.when(F.col("o_orderstatus") != "O", "someone")
    return table(spark, d, "orders").groupBy(
        "o_orderstatus", "o_orderpriority", rules.role_of(won, low < "2", low < "3").alias("role"),
        rules.won_flag(won, winner).alias("won")).agg(F.count(F.lit(1)).alias("n"))


@query("c23_cross_rates", """
    SELECT DISTINCT s_nationkey::BIGINT AS k, CASE WHEN s_nationkey > 0 THEN 11.5::DOUBLE / s_nationkey ELSE 13.0 END AS cross_rate,
           CASE WHEN s_nationkey > 0 THEN 1.0::DOUBLE / s_nationkey ELSE 1.0 END AS inverse FROM supplier""")
def c23(spark, d):
    k = F.col("s_nationkey").cast("double")
    return table(spark, d, "supplier").select(
        _int("s_nationkey").alias("k"), n.cross_rate(F.lit(11.5), k, F.lit(13.0)).alias("cross_rate"),
        n.inverse_rate(k).alias("inverse")).distinct()


@query("c24_linked_data_price", """
    SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size * 10.0::DOUBLE WHEN 2 THEN p_size::DOUBLE END AS price FROM part""")
def c24(spark, d):
    kind = F.col("p_size") % 4
    other = '<html><script type="application/ld+json">{"@type":"Organization","offers":{"price":"1"}}</script>'
    block = F.when(kind == 0, F.concat(F.lit('{"@type":"Product","offers":{"price":'), "p_retailprice", F.lit(',"priceCurrency":"SEK"}}'))).when(
        kind == 1, F.concat(F.lit('{"@type":"Product","offers":[{"price":"'), "p_size", F.lit('","priceCurrency":"EUR"}]}'))).when(
        kind == 2, F.concat(F.lit('{"@type":"Product","offers":{"price":"'), "p_size", F.lit('"}}'))).otherwise("{broken")
    html = F.concat(F.lit(other + "<script type='application/ld+json' id=\"p\">\n"), block, F.lit("</script></html>"))
    return table(spark, d, "part").select("p_partkey", t.ld_product_price(html, F.lit(10.0)).alias("price"))


@query("c25_relaxed_mapping", """
    SELECT p_partkey, p_name AS name, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_brand END AS url FROM part""")
def c25(spark, d):
    text = F.concat(F.lit("{'sv-SE': '"), "p_name", F.lit("', 'u': "), F.when(F.col("p_size") % 2 == 0, "null").otherwise(
        F.concat(F.lit("'"), "p_brand", F.lit("'"))), F.lit("}"))
    found = t.relaxed_map(text)
    return table(spark, d, "part").select(
        "p_partkey", F.try_element_at(found, F.lit("sv-SE")).alias("name"), F.try_element_at(found, F.lit("u")).alias("url"))


@query("c26_clip_text", "SELECT doc_id, md5(substr(text, 1, 500)) AS clipped FROM documents")
def c26(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(t.clip(F.col("text"))).alias("clipped"))


@query("c27_month_key", "SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n FROM events GROUP BY ALL")
def c27(spark, d):
    return table(spark, d, "events").groupBy(dt.month_key(F.col("ts")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("c28_local_day", """
    SELECT ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm')::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL""")
def c28(spark, d):
    events = table(spark, d, "events")
    return events.groupBy(dt.local_day(events, "ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("c29_badges", "SELECT p_partkey, (p_size % 3 = 0 OR p_name LIKE '%ring%')::BIGINT AS is_new FROM part")
def c29(spark, d):
    badge = "array<struct<theme:string>>"
    primary = F.when(F.col("p_size") % 3 == 0, F.array(F.struct(F.lit("sale").alias("theme")), F.struct(F.lit("new").alias("theme"))).cast(badge)).otherwise(
        F.array(F.struct(F.lit("sale").alias("theme"))).cast(badge))
    second = F.when(F.contains("p_name", F.lit("ring")), F.array(F.struct(F.lit("New").alias("theme"))).cast(badge)).otherwise(
        F.array().cast(badge))
    return table(spark, d, "part").select("p_partkey", t.has_badge(F.concat(primary, second), "NEW").alias("is_new"))


@query("c30_table_column", """
    SELECT o_orderkey, unnest(CASE WHEN o_orderstatus = 'P' THEN [] ELSE [(o_orderkey % 50) || ',5 kr', '- ' || o_custkey] END) AS cell FROM orders""")
def c30(spark, d):
    head = F.when(F.col("o_orderstatus") == "P", "Price").otherwise("My <b>EPC</b>")
    html = F.concat(
        F.lit("<table><thead><tr><th>Name</th><th class='x'>"), head, F.lit("</th></tr></thead><tbody><tr><td>a</td><td><i>"),
        F.col("o_orderkey") % 50, F.lit(",5 kr</i></td></tr><tr><td>only one</td></tr><tr><td>b</td><td>- "), "o_custkey",
        F.lit("</td></tr></tbody></table>"))
    return table(spark, d, "orders").select("o_orderkey", F.explode(t.table_column(html, "epc")).alias("cell"))

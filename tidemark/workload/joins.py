"""Check queries: filters, joins, picks, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.fixed_values import MARKET_PRIORITY
from tidemark.functions.text import canonical, names_company, org_number
from tidemark.functions.numbers import within
from tidemark.functions.dates import in_months, is_stale, month_key, month_range
from tidemark.operators import filters as f
from tidemark.operators import joins as j
from tidemark.operators import picks as p
from tidemark.workload import bindings as b
from tidemark.workload.registry import query, table


# --- filters -------------------------------------------------------------------------------

@query("f1_equal_in_any_case", "SELECT n_nationkey::BIGINT AS n_nationkey, c_custkey FROM customer JOIN nation ON "
       "n_nationkey = c_nationkey WHERE lower(c_mktsegment) = 'building'")
def f1(spark, d):
    kept = table(spark, d, "customer").where(f.same_text(F.col("c_mktsegment"), "Building"))
    return kept.select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")


@query("f2_json_attribute_filter", """
    SELECT event_type, count(*) AS n FROM events WHERE (props::JSON ->> 'k') = '7' GROUP BY ALL""")
def f2(spark, d):
    hit = table(spark, d, "events").where(f.json_attribute_is(F.col("props"), "k", "7"))
    return hit.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("f3_title_or_all_skus_excluded", """
    SELECT p_partkey, p_name FROM part
    WHERE NOT (lower(p_name) LIKE '%widget%' OR (p_type LIKE '%ECO%' AND p_brand LIKE '%ECO%' IS NOT NULL AND
               (p_type || '-1') LIKE '%ECO%' AND (p_type || '-2') LIKE '%ECO%'))""")
def f3(spark, d):
    parts = table(spark, d, "part").withColumn(
        "skus", F.array(F.concat("p_type", F.lit("-1")), F.concat("p_type", F.lit("-2"))))
    dropped = f.title_excluded(F.col("p_name"), ["Widget"]) | f.all_marked(F.col("skus"), "ECO")
    return parts.where(~dropped).select("p_partkey", "p_name")


@query("f4_managed_and_known", """
    SELECT l_linestatus, count(*) AS n FROM lineitem
    WHERE l_returnflag = 'A' AND nullif(l_quantity, 1) IS NOT NULL GROUP BY ALL""")
def f4(spark, d):
    lines = table(spark, d, "lineitem").withColumn("known", F.nullif(F.col("l_quantity"), F.lit(1.0)))
    return lines.where(f.managed(F.col("l_returnflag"), "A", F.col("known"))).groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n"))


@query("f5_positive_stock_sum", """
    SELECT l_suppkey, sum(CASE WHEN l_quantity > 25 THEN l_quantity - 25 ELSE 0 END)::BIGINT AS positive
    FROM lineitem GROUP BY ALL""")
def f5(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_quantity") - 25).cast("bigint").alias("q"))
    return lines.groupBy("l_suppkey").agg(f.positive_sum(F.col("q")).alias("positive"))


@query("f6_month_range", """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1996-03' AND '1997-02' GROUP BY ALL""")
def f6(spark, d):
    orders = table(spark, d, "orders")
    inside = orders.where(month_range(orders, "o_orderdate", "1996-03", "1997-02"))
    return inside.groupBy(month_key(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("f6_month_range_of_keys", """
    SELECT strftime(ts, '%Y-%m') AS month, event_type, count(*) AS n FROM events
    WHERE strftime(ts, '%Y-%m') BETWEEN '2023-12' AND '2024-01' GROUP BY ALL""")
def f6_keys(spark, d):
    events = table(spark, d, "events").select(month_key(F.col("ts")).alias("month"), "event_type")
    return events.where(in_months(F.col("month"), "2023-12", "2024-01")).groupBy("month", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("f7_whole_word_unless", r"""
    SELECT p_partkey, p_name FROM part
    WHERE regexp_matches(p_name, '(?i)\bred\b') AND lower(p_name) NOT LIKE '%ring%' AND lower(p_name) NOT LIKE '%bolt%'""")
def f7(spark, d):
    return table(spark, d, "part").where(f.whole_word(F.col("p_name"), "red", ["ring", "bolt"])).select(
        "p_partkey", "p_name")


@query("f8_active_or_won", """
    SELECT o_orderkey FROM orders
    WHERE o_custkey % 2 = 0 OR o_orderstatus = 'O' OR o_orderpriority LIKE '1%'""")
def f8(spark, d):
    status = F.when(F.col("o_orderstatus") == "O", "Active").otherwise("Historical")
    won = F.when(F.col("o_orderpriority").startswith("1"), "Yes").otherwise("No")
    return table(spark, d, "orders").where(f.active_or_won(status, won, F.col("o_custkey") % 2 != 0)).select("o_orderkey")


@query("f9_null_safe_inequality", """
    SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
    WHERE nullif(l_returnflag, 'N') IS DISTINCT FROM nullif(l_linestatus, 'O') GROUP BY ALL""")
def f9(spark, d):
    lines = table(spark, d, "lineitem")
    a, c = F.nullif(F.col("l_returnflag"), F.lit("N")), F.nullif(F.col("l_linestatus"), F.lit("O"))
    return lines.where(f.changed(a, c)).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("f10_stale_entities", """
    SELECT c_custkey, max(o_orderdate)::DATE::VARCHAR AS last_order FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY ALL HAVING max(o_orderdate) IS NULL OR DATE '2001-08-01' - max(o_orderdate)::DATE > 90""")
def f10(spark, d):
    last = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.max("o_orderdate")).alias("last_order"))
    known = table(spark, d, "customer").select("c_custkey").join(last, "c_custkey", "left")
    return known.where(is_stale(F.col("last_order"), F.lit("2001-08-01").cast("date"), 90))


@query("f11_not_captured_yet", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, article, quantity FROM ({b.BRAND_STOCK_FACTS}) s
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE date_trunc('month', o_orderdate)::DATE = s.snapshot_date)""")
def f11(spark, d):
    captured = table(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("snapshot_date"))
    return f.not_captured(b.brand_stock_facts(spark, d), captured, ["snapshot_date"])


@query("f12_dates_not_present", """
    SELECT DISTINCT l_shipdate::DATE::VARCHAR AS day FROM lineitem
    WHERE l_shipdate::DATE NOT IN (SELECT o_orderdate::DATE FROM orders)""")
def f12(spark, d):
    shipped = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return f.not_captured(shipped, table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")), ["day"])


@query("f13_partial_names", "SELECT n_name FROM nation WHERE lower(n_name) LIKE '%afr%' OR n_name LIKE '%\\_1%' ESCAPE '\\'")
def f13(spark, d):
    parts = table(spark, d, "region").select(
        F.when(F.col("r_name") == "AFRICA", "Afr").otherwise("_1").alias("part"))
    return f.names_like(table(spark, d, "nation"), "n_name", parts, "part").select("n_name")


@query("f13_partial_names_fall_back", "SELECT n_name FROM nation")
def f13_all(spark, d):
    parts = table(spark, d, "region").select(F.concat(F.lit("?"), "r_name").alias("part"))
    return f.names_like(table(spark, d, "nation"), "n_name", parts, "part").select("n_name")


@query("f14_rows_with_keys", """
    SELECT source, lang, count(*) AS n FROM documents WHERE nullif(lang, 'en') IS NOT NULL AND source <> '' GROUP BY ALL""")
def f14(spark, d):
    docs = table(spark, d, "documents").withColumn("key", F.nullif(F.col("lang"), F.lit("en")))
    return f.with_keys(docs, "key", "source").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("f15_plausible_values", """
    SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 AND o_totalprice < 200000 GROUP BY ALL""")
def f15(spark, d):
    return table(spark, d, "orders").where(within(F.col("o_totalprice"), 100_000, 200_000)).groupBy(
        "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# --- joins ---------------------------------------------------------------------------------

@query("j1_inner_dimension", """
    SELECT p_brand AS brand, count(*) AS n, sum(l_quantity)::BIGINT AS units FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY ALL""")
def j1(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("article"), "l_quantity")
    return j.enrich(lines, b.part_articles(spark, d), ["article"], "inner").groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("units"))


@query("j2_left_with_default", f"""
    SELECT coalesce(category, 'Övrigt') AS category, count(*) AS n
    FROM events LEFT JOIN ({b.ARTICLES}) ON article = user_id GROUP BY ALL""")
def j2(spark, d):
    events = table(spark, d, "events").select(F.col("user_id").alias("article"))
    joined = j.enrich(events, b.articles(spark, d), ["article"], "left", {"category": "Övrigt"})
    return joined.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("j5_rate_lookup", f"""
    SELECT o_orderkey, o_totalprice * coalesce(rate, 1.0) AS home_value
    FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN ({b.RATES}) r ON r.currency = CASE WHEN o_orderstatus = 'F' THEN
        ['SEK','EUR','NOK','CHF','DKK'][c_nationkey % 5 + 1] ELSE 'EUR' END""")
def j5(spark, d):
    orders = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    codes = F.array(*[F.lit(c) for c in ("SEK", "EUR", "NOK", "CHF", "DKK")])
    seen = F.when(F.col("o_orderstatus") == "F", F.element_at(codes, F.col("c_nationkey") % 5 + 1))
    rows = orders.withColumns({"seen": F.lower(seen), "expected": F.lit("EUR")})
    rated = j.with_rate(rows, b.rates(spark, d), "seen", "expected")
    return rated.select("o_orderkey", (F.col("o_totalprice") * F.col("rate")).alias("home_value"))


@query("j6_first_market_wins", f"""
    SELECT key, market, ordinal, sell_price FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY list_position(['DE','SE','NO','UK','COM'], market), ordinal) AS rn
        FROM ({b.COUNTER_SNAPSHOT})) WHERE rn = 1""")
def j6(spark, d):
    rows = b.counter_snapshot(spark, d).select("key", "market", "ordinal", "sell_price")
    return p.first_by_priority(rows, ["key"], "market", MARKET_PRIORITY, "ordinal")


@query("j7_presence_flags", """
    SELECT l_partkey, """ + ", ".join(
        f"max((l_suppkey % 5 = {i})::INT)::BIGINT AS in_{m}" for i, m in enumerate(b.MARKETS)) + """,
           count(DISTINCT l_suppkey % 5) AS listed_count FROM lineitem GROUP BY ALL""")
def j7(spark, d):
    rows = b.counter_snapshot(spark, d).withColumn("l_partkey", F.split("key", "_")[0].cast("bigint"))
    return j.presence_flags(rows, ["l_partkey"], "market", b.MARKETS)


@query("j9_mark_exists", """
    SELECT CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') THEN 'Active'
                WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Historical' END AS status, count(*) AS n
    FROM orders GROUP BY ALL""")
def j9(spark, d):
    active = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    marked = j.mark_exists(table(spark, d, "orders"), active, ["o_orderkey"], "is_active")
    status = F.when(F.col("is_active") | (F.col("o_orderstatus") == "O"), "Active").otherwise("Historical")
    return marked.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("j11_name_in_text", """
    SELECT doc_id, n_name AS name FROM documents JOIN (SELECT DISTINCT lower(r_name) AS needle, r_name AS n_name FROM region
        UNION SELECT lower(word), word FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part))
    ON contains(lower(text), needle) GROUP BY ALL""")
def j11(spark, d):
    words = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("name")).distinct()
    names = words.union(table(spark, d, "region").select("r_name")).distinct()
    return j.match_contains(table(spark, d, "documents"), "text", names, "name", ["doc_id"])


@query("j11_many_names_in_text", """
    SELECT doc_id, word AS name FROM documents JOIN (
        SELECT DISTINCT substr(text, 40, 9) AS word FROM documents UNION SELECT DISTINCT substr(text, 80, 3) FROM documents)
    ON word <> '' AND contains(lower(text), lower(word)) GROUP BY ALL""")
def j11_many(spark, d):
    """As many names as documents, some shorter than the pieces they are looked up by."""
    docs = table(spark, d, "documents")
    names = docs.select(F.substring("text", 40, 9).alias("name")).union(docs.select(F.substring("text", 80, 3)))
    return j.match_contains(docs, "text", names, "name", ["doc_id"])


@query("j11_company_in_text", r"""
    SELECT c_custkey, c_mktsegment,
           (contains(t, lower(name)) OR (core <> lower(name) AND contains(t, core)))::BIGINT AS is_named
    FROM (SELECT c_custkey, c_mktsegment, lower('Bid by ' || c_mktsegment || ' group') AS t,
                 c_name, CASE WHEN c_custkey % 2 = 0 THEN 'Building GmbH' ELSE 'Machinery Holdings' END AS name,
                 CASE WHEN c_custkey % 2 = 0 THEN 'building' ELSE 'machinery holdings' END AS core FROM customer)""")
def j11_company(spark, d):
    text = F.concat(F.lit("Bid by "), "c_mktsegment", F.lit(" group"))
    name = F.when(F.col("c_custkey") % 2 == 0, "Building GmbH").otherwise("Machinery Holdings")
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment", names_company(text, name).alias("is_named"))


@query("j12_array_overlap", """
    SELECT o_orderkey FROM orders WHERE o_orderkey IN (
        SELECT l_orderkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal < 0)""")
def j12(spark, d):
    # Identifiers written with a dash are normalised before they meet the tracked ids.
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(F.concat_ws("-", F.lit("S"), "l_suppkey")).alias("ids"))
    rows = lines.withColumn("ids", F.transform("ids", org_number))
    owed = table(spark, d, "supplier").where("s_acctbal < 0").select(F.concat(F.lit("S"), "s_suppkey").alias("id"))
    hit = j.overlaps(rows, "ids", owed, "id", ["l_orderkey", "l_linenumber"])
    return hit.select(F.col("l_orderkey").alias("o_orderkey")).distinct().join(
        table(spark, d, "orders").select("o_orderkey"), "o_orderkey", "left_semi")


@query("j14_parent_fields", """
    SELECT o_orderpriority, sum(l_quantity)::BIGINT AS units, count(*) AS n
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""")
def j14(spark, d):
    parent = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    return j.enrich(lines, parent, ["l_orderkey"]).groupBy("o_orderpriority").agg(
        F.sum("l_quantity").cast("bigint").alias("units"), F.count(F.lit(1)).alias("n"))


@query("j15_full_outer_months", """
    SELECT coalesce(a.month, b.month) AS month, coalesce(a.n, 0)::BIGINT AS targets, coalesce(b.n, 0)::BIGINT AS totals
    FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL) a
    FULL JOIN (SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n FROM lineitem GROUP BY ALL) b USING (month)""")
def j15(spark, d):
    targets = table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy(
        month_key(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("targets"))
    totals = table(spark, d, "lineitem").groupBy(month_key(F.col("l_shipdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("totals"))
    return j.enrich(targets, totals, ["month"], "full", {"targets": 0, "totals": 0})


@query("j16_calendar_left_join", """
    SELECT k.d::VARCHAR AS day, coalesce(n, 0)::BIGINT AS n FROM (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem) k
    LEFT JOIN (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY ALL) USING (d)""")
def j16(spark, d):
    days = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    metrics = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return j.enrich(days, metrics, ["day"], "left", {"n": 0})


# --- ranks by first appearance ---------------------------------------------------------------

RANKED_LISTS = """
    SELECT l_suppkey AS list, l_linenumber::BIGINT AS page, l_orderkey AS position, l_partkey AS item FROM lineitem"""


def ranked_lists(spark, d):
    """Lists (supplier) of items (part) over pages (line number) in listing order."""
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("list"), F.col("l_linenumber").cast("bigint").alias("page"),
        F.col("l_orderkey").alias("position"), F.col("l_partkey").alias("item"))


FIRST_SEEN_RANKS = f"""
    SELECT list, item, page, position, row_number() OVER (PARTITION BY list ORDER BY page, position, item) AS rank FROM (
        SELECT list, item, min(page) AS page, min(position) FILTER (page = lowest) AS position FROM (
            SELECT *, min(page) OVER (PARTITION BY list, item) AS lowest FROM ({RANKED_LISTS})) GROUP BY list, item)"""


@query("w4_rank_of_first_seen", f"SELECT list, item, rank FROM ({FIRST_SEEN_RANKS})")
def w4(spark, d):
    return j.rank_first_seen(ranked_lists(spark, d), ["list"], "page", "position", "item", span=1000).select("list", "item", "rank")


TARGETS = {"small ring": ["blue bolt"], "red widget": ["red-widget", "Red/Gear"]}


@query("j13_best_rank_by_alias", f"""
    SELECT list, CASE WHEN p_name IN ('small ring', 'blue bolt') THEN 'small ring' ELSE 'red widget' END AS target,
           min(rank) AS rank
    FROM ({FIRST_SEEN_RANKS}) JOIN part ON p_partkey = item
    WHERE p_name IN ('small ring', 'blue bolt', 'red widget', 'red gear') GROUP BY ALL""")
def j13(spark, d):
    ranked = j.rank_first_seen(ranked_lists(spark, d), ["list"], "page", "position", "item")
    titled = ranked.join(
        table(spark, d, "part").select(F.col("p_partkey").alias("item"), F.upper("p_name").alias("title")), "item")
    return j.best_rank_by_alias(titled, ["list"], "title", TARGETS)


# --- picks, ordering, sets -------------------------------------------------------------------

@query("w5_last_wins", """
    SELECT l_partkey, arg_max(l_suppkey, l_orderkey * 8 + l_linenumber) AS supplier,
           max(l_orderkey * 8 + l_linenumber) AS version FROM lineitem GROUP BY ALL""")
def w5(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_partkey", F.col("l_suppkey").alias("supplier"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("version"))
    return p.last_wins(rows, ["l_partkey"], "version")


@query("w9_first_seen", """
    SELECT user_id, first_seen::VARCHAR AS first_seen,
           (first_seen > (SELECT min(ts)::DATE FROM events))::BIGINT AS is_expansion
    FROM (SELECT user_id, min(ts)::DATE AS first_seen FROM events GROUP BY ALL)""")
def w9(spark, d):
    rows = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    return p.first_seen(rows, ["user_id"], "day")


@query("w10_latest_run_per_day", """
    SELECT ts::DATE::VARCHAR AS day, hour(ts)::BIGINT AS run, event_type, event_id, value FROM events
    QUALIFY hour(ts) = max(hour(ts)) OVER (PARTITION BY ts::DATE)""")
def w10(spark, d):
    rows = table(spark, d, "events").select(F.to_date("ts").alias("day"), F.hour("ts").alias("run"), "event_type", "event_id", "value")
    return p.latest_run_per_day(rows, "day", "run")


@query("w10_latest_run_per_key", """
    SELECT ts::DATE::VARCHAR AS day, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value
    FROM events GROUP BY ALL""")
def w10_per_key(spark, d):
    rows = table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_type", "event_id", "value")
    return p.latest_run_per_key(rows, "day", "event_id", ["event_type"])


@query("w11_representative_row", f"""
    SELECT key, ordinal, sell_price FROM (
        SELECT key, ordinal, sell_price, row_number() OVER (PARTITION BY key ORDER BY sell_price <= 0, ordinal) AS rn
        FROM (SELECT split_part(key, '-', 1) AS key, ordinal, sell_price FROM ({b.COUNTER_SNAPSHOT}))) WHERE rn = 1""")
def w11(spark, d):
    rows = b.counter_snapshot(spark, d).select(
        F.substring_index("key", "-", 1).alias("key"), "ordinal", "sell_price")
    return p.first_by(rows, ["key"], F.when(F.col("sell_price") > 0, 0).otherwise(1), F.col("ordinal"))


@query("o1_multi_key_order", """
    SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY ALL""")
def o1(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n")).orderBy("l_returnflag", "l_linestatus")


@query("o2_top_ten", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o2(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return p.top_k(rows, F.col("o_totalprice"), 10, ties=["o_orderkey"])


@query("o2_top_ten_per_group", """
    SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (
        PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 10""")
def o2_groups(spark, d):
    rows = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return p.top_k(rows, F.col("o_totalprice"), 10, ["o_orderpriority"], ["o_orderkey"])


@query("o3_order_by_product", """
    SELECT p_partkey, p_size * p_retailprice AS worth FROM part ORDER BY worth DESC""")
def o3(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", (F.col("p_size") * F.col("p_retailprice")).alias("worth")).orderBy(F.col("worth").desc())


@query("o4_pinned_first", """
    SELECT p_brand, p_name, p_partkey FROM part ORDER BY p_brand <> 'Brand#13', p_brand, p_name, p_partkey""")
def o4(spark, d):
    rows = table(spark, d, "part").select("p_brand", "p_name", "p_partkey")
    return p.pinned_order(rows, "p_brand", "Brand#13", "p_name", "p_partkey")


@query("o5_status_then_date", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Historical' END AS status,
           CASE WHEN o_orderpriority LIKE '5%' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def o5(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", "Active").otherwise("Historical").alias("status"),
        F.when(F.col("o_orderpriority").startswith("5"), "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return p.status_order(rows, "status", {"Historical": 0, "Active": 1}, "day")


@query("t1_new_elements", """
    SELECT DISTINCT l_partkey AS item FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01'
    EXCEPT SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_returnflag = 'R'""")
def t1(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("item"), "l_shipdate", "l_returnflag")
    now = lines.where("l_shipdate >= timestamp_ntz'2001-06-01'").select("item")
    return p.new_elements(now, lines.where("l_shipdate < timestamp_ntz'1996-01-01' and l_returnflag = 'R'"), ["item"])


@query("t2_union_of_keys", """
    SELECT o_custkey AS key FROM orders UNION SELECT c_custkey FROM customer""")
def t2(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("key")).union(
        table(spark, d, "customer").select("c_custkey")).distinct()


@query("t3_concat_keep_first", """
    SELECT key, arg_min(label, src * 1000000000 + ordinal) AS label, arg_min(ordinal, src * 1000000000 + ordinal) AS ordinal
    FROM (SELECT o_custkey AS key, o_orderpriority AS label, o_orderkey AS ordinal, 0 AS src FROM orders
          UNION ALL SELECT c_custkey, c_mktsegment, c_custkey, 1 FROM customer) GROUP BY ALL""")
def t3(spark, d):
    a = table(spark, d, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("label"), F.col("o_orderkey").alias("ordinal"))
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("label"), F.col("c_custkey").alias("ordinal"))
    return p.concat_first(a, c, ["key"], "ordinal")


@query("t4_union_with_label", """
    SELECT store, count(*) AS n, sum(k)::BIGINT AS keys FROM (
        SELECT 'orders' AS store, o_custkey AS k FROM orders UNION ALL SELECT 'customer', c_custkey FROM customer) GROUP BY ALL""")
def t4(spark, d):
    parts = {"orders": table(spark, d, "orders").select(F.col("o_custkey").alias("k")),
             "customer": table(spark, d, "customer").select(F.col("c_custkey").alias("k"))}
    return p.union_labelled(parts, "store").groupBy("store").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"))


@query("t5_intersection", "SELECT o_custkey AS key FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def t5(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("key")).intersect(
        table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey"))


@query("t6_distinct_links", r"""
    SELECT DISTINCT c.page_id % 7 AS cid, c.link FROM (
        SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages) c""")
def t6(spark, d):
    links = F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), F.lit(1))).alias("link")
    return table(spark, d, "pages").select((F.col("page_id") % 7).alias("cid"), links).dropDuplicates(["cid", "link"])


@query("t7_drifting_columns", """
    SELECT part, count(*) AS n, count(extra) AS with_extra, count(other) AS with_other FROM (
        SELECT 'a' AS part, o_orderpriority AS extra, NULL AS other FROM orders
        UNION ALL SELECT 'b', NULL, c_mktsegment FROM customer) GROUP BY ALL""")
def t7(spark, d):
    a = table(spark, d, "orders").select(F.lit("a").alias("part"), F.col("o_orderpriority").alias("extra"))
    c = table(spark, d, "customer").select(F.lit("b").alias("part"), F.col("c_mktsegment").alias("other"))
    return a.unionByName(c, allowMissingColumns=True).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.count("extra").alias("with_extra"), F.count("other").alias("with_other"))

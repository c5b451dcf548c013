"""Check queries: aggregations, reshaping, series and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import numbers as n
from tidemark.functions.dates import month_key
from tidemark.functions.text import relabel
from tidemark.operators import aggregates as a
from tidemark.operators import quality as q
from tidemark.operators import reshape as r
from tidemark.operators import series as s
from tidemark.operators.deltas import snapshot_delta
from tidemark.workload import bindings as b
from tidemark.workload.registry import query, table


# --- aggregations --------------------------------------------------------------------------

@query("a1_sum_by_date_and_brand", """
    SELECT o_orderdate::DATE::VARCHAR AS day, o_orderpriority AS brand, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
    FROM orders GROUP BY ALL""")
def a1(spark, d):
    return table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("brand")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))


@query("a3_filtered_counts", """
    SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS high, count(*) FILTER (user_id % 2 = 0) AS even
    FROM events GROUP BY ALL""")
def a3(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 50).alias("high"),
        F.count_if(F.col("user_id") % 2 == 0).alias("even"))


@query("a5_guarded_ratio", """
    SELECT o_custkey, CASE WHEN count(*) FILTER (o_orderstatus = 'P') <> 0
           THEN sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) FILTER (o_orderstatus = 'P') END AS per_pending
    FROM orders GROUP BY ALL""")
def a5(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(n.ratio(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"),
        F.count_if(F.col("o_orderstatus") == "P")).alias("per_pending"))


@query("a6_price_stats", """
    SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 2) AS average_price,
           round(quantile_cont(l_quantity, 0.5), 2) AS median_price
    FROM lineitem GROUP BY ALL""")
def a6(spark, d):
    return a.price_stats(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


_ORDER_VALUES = """
    SELECT o_orderpriority AS grp, c_nationkey::BIGINT AS country, o_totalprice AS v FROM orders JOIN customer ON c_custkey = o_custkey"""


def order_values(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("country"))
    return table(spark, d, "orders").join(customers, "o_custkey").select(
        F.col("o_orderpriority").alias("grp"), F.col("country").cast("bigint").alias("country"), F.col("o_totalprice").alias("v"))


@query("a7a_median_of_medians", f"""
    WITH m AS (SELECT grp, country, median(v) AS median, count(*) AS n FROM ({_ORDER_VALUES}) GROUP BY ALL)
    SELECT grp, country::DOUBLE AS country, median, n FROM m
    UNION ALL SELECT grp, NULL, median(median), count(*) FROM m GROUP BY grp""")
def a7a(spark, d):
    rows = a.median_levels(order_values(spark, d), ["grp"], "country", "v", "of_medians")
    return rows.withColumn("country", F.col("country").cast("double"))


@query("a7b_median_of_pooled", f"""
    SELECT grp, country::DOUBLE AS country, median(v) AS median, count(*) AS n
    FROM ({_ORDER_VALUES}) GROUP BY GROUPING SETS ((grp, country), (grp))""")
def a7b(spark, d):
    rows = a.median_levels(order_values(spark, d), ["grp"], "country", "v", "pooled")
    return rows.withColumn("country", F.col("country").cast("double"))


@query("a7_median_without_groups", "SELECT median(value) AS median, count(*) AS n FROM events")
def a7(spark, d):
    return a.exact_median(table(spark, d, "events"), [], "value")


@query("a8_max_counter_per_base", f"""
    SELECT split_part(key, '-', 1) AS base_key, max(sale_last_week) AS week, max(sale_last_days) AS days
    FROM ({b.COUNTER_SNAPSHOT}) GROUP BY ALL""")
def a8(spark, d):
    return b.counter_snapshot(spark, d).groupBy(F.substring_index("key", "-", 1).alias("base_key")).agg(
        F.max("sale_last_week").alias("week"), F.max("sale_last_days").alias("days"))


@query("a9_rollups_in_one_pass", """
    WITH l AS (SELECT date_trunc('month', l_shipdate)::DATE::VARCHAR AS month, l_returnflag, l_linestatus, l_suppkey::VARCHAR AS supp,
                      l_quantity, l_extendedprice::DECIMAL(18,2) AS price FROM lineitem)
    SELECT month, CASE WHEN grouping(l_returnflag) = 0 THEN 'l_returnflag' WHEN grouping(l_linestatus) = 0 THEN 'l_linestatus'
                       WHEN grouping(supp) = 0 THEN 'supp' ELSE 'total' END AS dimension,
           coalesce(l_returnflag, l_linestatus, supp) AS member, count(*) AS n,
           sum(l_quantity)::BIGINT AS units, sum(price)::DOUBLE AS revenue
    FROM l GROUP BY GROUPING SETS ((month), (month, l_returnflag), (month, l_linestatus), (month, supp))""")
def a9(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.trunc("l_shipdate", "month").alias("month"), "l_returnflag", "l_linestatus", F.col("l_suppkey").cast("string").alias("supp"),
        "l_quantity", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return a.rollups(lines, "month", ["l_returnflag", "l_linestatus", "supp"], [
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("units"), F.sum("price").alias("revenue")])


_RESTOCKS = f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, store, variant_id, prev_value AS stock_before, quantity AS stock_after,
           quantity - prev_value AS delta
    FROM (SELECT *, lag(quantity) OVER (PARTITION BY store, variant_id ORDER BY snapshot_date) AS prev_value
          FROM ({b.STORE_SNAPSHOT})) WHERE quantity - prev_value >= 10"""


@query("a10_collect_and_explode_events", _RESTOCKS)
def a10(spark, d):
    moved = snapshot_delta(b.store_snapshot(spark, d), ["store", "variant_id"], "snapshot_date", "quantity",
                           max_gap_days=None, mode="three_way")
    named = moved.withColumnsRenamed({"prev_value": "stock_before", "quantity": "stock_after"})
    packed = a.collect_events(named, ["snapshot_date"], F.col("kind") == "restock",
                              ["store", "variant_id", "stock_before", "stock_after", "delta"])
    return a.explode_events(
        packed, "events", "store:string,variant_id:bigint,stock_before:bigint,stock_after:bigint,delta:bigint")


@query("a11_table_audit", """
    SELECT event_type, count(*) AS rows, count(DISTINCT ts::DATE) AS dates, count(DISTINCT user_id) AS keys,
           min(ts::DATE)::VARCHAR AS first_date, max(ts::DATE)::VARCHAR AS last_date FROM events GROUP BY ALL""")
def a11(spark, d):
    events = table(spark, d, "events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    return q.audit(events, "day", ["user_id"], ["event_type"])


@query("a11_table_audit_whole", """
    SELECT count(*) AS rows, count(DISTINCT l_shipdate::DATE) AS dates, count(DISTINCT l_partkey) AS keys,
           min(l_shipdate::DATE)::VARCHAR AS first_date, max(l_shipdate::DATE)::VARCHAR AS last_date FROM lineitem""")
def a11_whole(spark, d):
    return q.audit(table(spark, d, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("day")), "day", ["l_partkey"])


@query("a11_audit_from_day_sketches", """
    SELECT l_returnflag, count(*) AS rows, count(DISTINCT l_shipdate::DATE) AS dates, min(l_shipdate::DATE)::VARCHAR AS first_date,
           max(l_shipdate::DATE)::VARCHAR AS last_date, count(DISTINCT l_partkey) AS keys, 1::BIGINT AS estimate_is_near FROM lineitem GROUP BY ALL""")
def a11_days(spark, d):
    """The estimate from merged day sketches is within four standard errors of the exact count."""
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_partkey", F.to_date("l_shipdate").alias("day"))
    days = q.day_sketches(lines, "day", ["l_partkey"], ["l_returnflag"])
    merged = q.audit_days(days, "day", ["l_returnflag"]).withColumnRenamed("keys", "estimate")
    exact = q.audit(lines, "day", ["l_partkey"], ["l_returnflag"]).select("l_returnflag", "keys")
    near = F.abs(F.col("estimate") - F.col("keys")) <= 4 * 1.04 / 64 * F.col("keys") + 1
    return a.join_groups(merged, exact, ["l_returnflag"]).withColumn("estimate_is_near", near).drop("estimate")


_CHANNELS = {"click": "DE", "view": "SE", "signup": "FI"}

_REVIEW_ROWS = """
    SELECT strftime(ts, '%Y-%m') AS month, CASE event_type WHEN 'click' THEN 'DE' WHEN 'view' THEN 'SE' WHEN 'signup' THEN 'FI'
           ELSE 'other' END AS country, ['PANTS','TOPS','unknown'][user_id % 3 + 1] AS category, value > 100 AS is_big
    FROM events"""


def review_rows(spark, d):
    return table(spark, d, "events").select(
        month_key(F.col("ts")).alias("month"),
        F.coalesce(relabel(F.col("event_type"), _CHANNELS, passthrough=False), F.lit("other")).alias("country"),
        F.coalesce(F.element_at(F.array(F.lit("PANTS"), F.lit("TOPS"), F.lit(None)), (F.col("user_id") % 3 + 1).cast("int")),
                   F.lit("unknown")).alias("category"),
        (F.col("value") > 100).alias("is_big"))


@query("a12_monthly_breakdown", f"""
    SELECT month, CASE WHEN grouping(country) = 0 THEN 'country' WHEN grouping(category) = 0 THEN 'category' ELSE 'total' END
           AS dimension, coalesce(country, category) AS member, count(*) AS total
    FROM ({_REVIEW_ROWS}) GROUP BY GROUPING SETS ((month), (month, country), (month, category))""")
def a12(spark, d):
    return a.monthly_breakdown(review_rows(spark, d), "month", {"country": F.col("country"), "category": F.col("category")})


@query("a13_second_total_without_capped", f"""
    SELECT month, CASE WHEN grouping(country) = 0 THEN 'country' ELSE 'total' END AS dimension, country AS member,
           count(*) AS total, count(*) FILTER (NOT is_big) AS total_uncapped
    FROM ({_REVIEW_ROWS}) GROUP BY GROUPING SETS ((month), (month, country))""")
def a13(spark, d):
    return a.monthly_breakdown(review_rows(spark, d), "month", {"country": F.col("country")}, F.col("is_big"))


@query("a14_share", """
    SELECT c_mktsegment, o_orderpriority, CASE WHEN count(*) FILTER (o_orderstatus <> 'F') <> 0 THEN
           round_even(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'P') / count(*) FILTER (o_orderstatus <> 'F'), 2) END AS pct
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL""")
def a14(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return rows.groupBy("c_mktsegment", "o_orderpriority").agg(n.share(
        F.count_if(F.col("o_orderstatus") == "P"), F.count_if(F.col("o_orderstatus") != "F")).alias("pct"))


@query("a15_weighted_revenue", """
    SELECT l_returnflag, sum(q * sell)::DOUBLE AS q_x_sell, sum(q * list)::DOUBLE AS q_x_list, sum(n * sell)::DOUBLE AS n_x_sell,
           sum(n * list)::DOUBLE AS n_x_list, count(*) AS total, count(*) FILTER (q > 0 OR n > 0) AS with_sales
    FROM (SELECT l_returnflag, l_quantity::BIGINT - 10 AS q, l_linenumber::BIGINT - 4 AS n,
                 (l_partkey % 400)::DECIMAL(10,2) AS sell, (l_partkey % 400 + 10)::DECIMAL(10,2) AS list FROM lineitem)
    GROUP BY ALL""")
def a15(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_returnflag", (F.col("l_quantity").cast("bigint") - 10).alias("q"), (F.col("l_linenumber").cast("bigint") - 4).alias("n"),
        (F.col("l_partkey") % 400).cast("decimal(10,2)").alias("sell"),
        (F.col("l_partkey") % 400 + 10).cast("decimal(10,2)").alias("list"))
    return a.weighted_revenue(lines, ["q", "n"], ["sell", "list"], ["l_returnflag"])


@query("a16_discount_of_totals", """
    SELECT l_suppkey, round_even(100.0::DOUBLE * (1.0::DOUBLE - sum(sell)::DOUBLE / sum(list)::DOUBLE), 1) AS pct
    FROM (SELECT l_suppkey, (l_extendedprice * (1 - l_discount))::DECIMAL(18,4) AS sell, l_extendedprice::DECIMAL(18,4) AS list
          FROM lineitem) GROUP BY ALL""")
def a16(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_suppkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("sell"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("list"))
    return lines.groupBy("l_suppkey").agg(
        a.discount_of_totals(F.sum("sell").cast("double"), F.sum("list").cast("double")).alias("pct"))


@query("a17_month_end_mean", """
    WITH m AS (SELECT event_type, last_day(ts::DATE) AS month, count(*) AS n, sum(value::DECIMAL(18,4))::DOUBLE / count(*) AS value
               FROM events GROUP BY ALL)
    SELECT event_type, month::VARCHAR AS month, round(value, 6) AS value FROM m""")
def a17(spark, d):
    daily = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,4)").alias("value"))
    return s.to_month(daily, "day", "value", ["event_type"]).withColumn("value", F.round(F.col("value").cast("double"), 6))


@query("a17_month_end_mean_dense", """
    WITH m AS (SELECT o_custkey AS grp, last_day(o_orderdate::DATE) AS month, sum(o_totalprice::DECIMAL(18,4))::DOUBLE / count(*) AS value
               FROM orders GROUP BY ALL),
    k AS (SELECT grp, unnest(generate_series(date_trunc('month', min(month)), max(month), INTERVAL 1 MONTH)) AS f FROM m GROUP BY grp)
    SELECT k.grp, last_day(f::DATE)::VARCHAR AS month, round(m.value, 4) AS value
    FROM k LEFT JOIN m ON m.grp = k.grp AND m.month = last_day(f::DATE)""")
def a17_dense(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("grp"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,4)").alias("value"))
    return s.to_month(rows, "day", "value", ["grp"]).withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("a18_lot_counts", """
    SELECT l_orderkey, l_linenumber::BIGINT % 3 AS lot, count(*) AS num_tenders,
           count(DISTINCT l_suppkey) FILTER (l_returnflag = 'R') AS num_winners FROM lineitem GROUP BY ALL""")
def a18(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber").cast("bigint") % 3).alias("lot"), "l_suppkey", "l_returnflag")
    return a.lot_counts(lines, lines.where("l_returnflag = 'R'"), ["l_orderkey", "lot"], "l_suppkey")


@query("a19_merge_repeated_results", """
    SELECT l_partkey, arg_max(code, ord) FILTER (code <> '') AS code, arg_max(price, ord) FILTER (price IS NOT NULL) AS price
    FROM (SELECT l_partkey, l_orderkey * 8 + l_linenumber AS ord, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS code,
                 CASE WHEN l_quantity > 10 THEN l_extendedprice END AS price FROM lineitem) GROUP BY ALL""")
def a19(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_partkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("code"),
        F.when(F.col("l_quantity") > 10, F.col("l_extendedprice")).alias("price"))
    return a.merge_results(lines, ["l_partkey"], "ord", ["code", "price"])


@query("a20_currency_mix", """
    SELECT c_mktsegment, ['SEK','EUR','NOK','GBP','DKK'][c_nationkey % 5 + 1] AS currency, count(*) AS n FROM customer GROUP BY ALL""")
def a20(spark, d):
    codes = F.array(*[F.lit(c) for c in ("SEK", "EUR", "NOK", "GBP", "DKK")])
    rows = table(spark, d, "customer").withColumn("currency", F.element_at(codes, F.col("c_nationkey") % 5 + 1))
    return a.currency_mix(rows, ["c_mktsegment"], "currency")


@query("a21_raw_and_unique_keys", f"""
    SELECT count(*) AS raw_keys, count(DISTINCT key) AS unique_keys, count(DISTINCT split_part(key, '-', 1)) AS base_keys
    FROM ({b.COUNTER_SNAPSHOT})""")
def a21(spark, d):
    # Counted by two reductions instead of one expanded distinct count.
    per_key = b.counter_snapshot(spark, d).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    per_base = per_key.groupBy(F.substring_index("key", "-", 1).alias("base")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    return per_base.agg(F.sum("n").alias("raw_keys"), F.sum("k").alias("unique_keys"), F.count(F.lit(1)).alias("base_keys"))


@query("a24_proxy_value", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, sum(fresh)::BIGINT AS total_new_reviews,
           sum(fresh * (10 + product % 7))::BIGINT AS proxy_value
    FROM (SELECT snapshot_date, product, greatest(0, count - coalesce(lag(count) OVER
              (PARTITION BY channel, product ORDER BY snapshot_date), 0)) AS fresh FROM ({b.REVIEW_COUNTS})) GROUP BY ALL""")
def a24(spark, d):
    moved = snapshot_delta(b.review_counts(spark, d), ["channel", "product"], "snapshot_date", "count",
                           max_gap_days=None, mode="growth", first_as_zero=True)
    return moved.groupBy("snapshot_date").agg(
        F.sum("growth").alias("total_new_reviews"), F.sum(F.col("growth") * (10 + F.col("product") % 7)).alias("proxy_value"))


@query("a25_rating_metrics", """
    SELECT source, round_even((sum(quality)::DOUBLE / count(*)) * 5, 3) AS avg_rating,
           round_even(count(*) FILTER (quality = 1)::DOUBLE / count(*) * 100, 1) AS pct_top
    FROM labels JOIN documents USING (doc_id) GROUP BY ALL""")
def a25(spark, d):
    from tidemark.plans.reviews import rating_metrics

    rated = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return rating_metrics(rated, ["source"], "quality", top=1)


# --- reshape -------------------------------------------------------------------------------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def monthly_by_priority(spark, d):
    return table(spark, d, "orders").groupBy(
        month_key(F.col("o_orderdate")).alias("month"), "o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))


_MONTHLY = """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, o_orderstatus, count(*) AS n,
           sum(o_totalprice::DECIMAL(18,2)) AS total FROM orders GROUP BY ALL"""


@query("u1_melt_without_nulls", f"""
    SELECT month, o_orderpriority AS series, sum(n)::BIGINT AS value FROM ({_MONTHLY})
    WHERE (substr(month, 6, 2)::INT + substr(o_orderpriority, 1, 1)::INT) % 3 <> 0 GROUP BY ALL""")
def u1(spark, d):
    """Every third cell of the wide table is unknown."""
    known = (F.substring("month", 6, 2).cast("int") + F.substring("o_orderpriority", 1, 1).cast("int")) % 3 != 0
    wide = monthly_by_priority(spark, d).withColumn("n", F.when(known, F.col("n")))
    return r.melt(r.pivot_fixed(wide, ["month"], "o_orderpriority", PRIORITIES, "n", fill=None), ["month"])


@query("u2_melt_paired_columns", """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, CASE o_orderpriority WHEN '1-URGENT' THEN 'Net' ELSE 'Cloth Blue' END AS product,
           CASE o_orderstatus WHEN 'O' THEN 'US' ELSE 'DE' END AS country, count(*)::DOUBLE AS bought,
           CASE WHEN max(o_orderkey) % 3 <> 0 THEN max(o_orderkey) END::DOUBLE AS rank
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('O', 'F') GROUP BY ALL""")
def u2(spark, d):
    cells = [("Net", "1-URGENT"), ("Cloth Blue", "2-HIGH")]
    aggs = []
    for product, priority in cells:
        for country, status in (("US", "O"), ("DE", "F")):
            here = (F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") == status)
            top = F.max(F.when(here, F.col("o_orderkey")))
            aggs.append(F.nullif(F.count_if(here), F.lit(0)).alias(f"{product} {country} Bought"))
            aggs.append(F.when(top % 3 != 0, top).alias(f"{product} {country} Rank"))
    wide = table(spark, d, "orders").groupBy(month_key(F.col("o_orderdate")).alias("month")).agg(*aggs)
    rows = r.melt_paired(wide, ["month"], r"(.+) (US|DE) (Bought|Rank)", ["product", "country"], {"Bought": "bought", "Rank": "rank"})
    return rows.withColumns({"bought": F.col("bought").cast("double"), "rank": F.col("rank").cast("double")})


@query("u3_pivot_fixed_columns", f"""
    SELECT month, {', '.join(f'''coalesce(sum(n) FILTER (o_orderpriority = '{p}'), 0)::BIGINT AS "{p}"''' for p in PRIORITIES)}
    FROM ({_MONTHLY}) GROUP BY ALL""")
def u3(spark, d):
    return r.pivot_fixed(monthly_by_priority(spark, d), ["month"], "o_orderpriority", PRIORITIES, "n")


@query("u4_pivot_by_latest", f"""
    SELECT month, {', '.join(f'''coalesce(sum(n) FILTER (o_orderpriority = '{p}'), 0)::BIGINT AS "{p} (Orders)",
    coalesce(sum(total) FILTER (o_orderpriority = '{p}'), 0)::DOUBLE AS "{p} (Value)"''' for p in PRIORITIES)}
    FROM ({_MONTHLY}) GROUP BY ALL""")
def u4(spark, d):
    return r.pivot_by_latest(monthly_by_priority(spark, d), "month", "o_orderpriority", {"n": "Orders", "total": "Value"}, PRIORITIES)


@query("u4_long_by_latest", """
    WITH f AS (SELECT year(l_shipdate) AS y, l_partkey, sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY ALL),
    l AS (SELECT l_partkey, coalesce(sum(q) FILTER (y = (SELECT max(y) FROM f)), 0) AS latest FROM f GROUP BY ALL)
    SELECT y::BIGINT AS y, l_partkey, q::BIGINT AS q, n::BIGINT AS n, position FROM f
    JOIN (SELECT l_partkey, row_number() OVER (ORDER BY latest DESC, l_partkey) AS position FROM l) USING (l_partkey)""")
def u4_long(spark, d):
    """A report with as many columns as there are parts, as data."""
    lines = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("y"), "l_partkey", F.col("l_quantity").cast("bigint").alias("q"), F.lit(1).cast("bigint").alias("n"))
    return r.long_by_latest(lines, "y", "l_partkey", ["q", "n"], "q")


@query("u4_column_order", f"""
    WITH m AS (SELECT month, o_orderpriority, sum(n) AS n FROM ({_MONTHLY}) GROUP BY ALL)
    SELECT *, row_number() OVER (ORDER BY latest DESC, o_orderpriority) AS position FROM (
        SELECT o_orderpriority, coalesce(sum(n) FILTER (month = (SELECT max(month) FROM m)), 0)::BIGINT AS latest FROM m GROUP BY ALL)""")
def u4_order(spark, d):
    return r.latest_order(monthly_by_priority(spark, d), "month", "o_orderpriority", "n")


@query("u5_tracked_columns_and_other", f"""
    SELECT month, coalesce(sum(n) FILTER (o_orderpriority = '1-URGENT'), 0)::BIGINT AS "1-URGENT",
           coalesce(sum(n) FILTER (o_orderpriority = '2-HIGH'), 0)::BIGINT AS "2-HIGH",
           coalesce(sum(n) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')), 0)::BIGINT AS other
    FROM ({_MONTHLY}) GROUP BY ALL""")
def u5(spark, d):
    tracked = ["1-URGENT", "2-HIGH"]
    rows = monthly_by_priority(spark, d).withColumn("bucket", r.bucket_other(F.col("o_orderpriority"), tracked))
    return r.pivot_fixed(rows, ["month"], "bucket", [*tracked, "other"], "n")


@query("u6_packed_rollups_to_rows", f"""
    SELECT month, o_orderpriority AS member, sum(n)::BIGINT AS n, (sum(total)::DOUBLE / sum(n)) AS mean
    FROM ({_MONTHLY}) GROUP BY ALL""")
def u6(spark, d):
    rows = monthly_by_priority(spark, d).groupBy("month", F.col("o_orderpriority").alias("member")).agg(
        F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"))
    packed = a.pack_rows(rows, ["month"], ["member", "n", "total"], "by_member")
    flat = a.explode_events(packed, "by_member", "member:string,n:bigint,total:double")
    return flat.select("month", "member", "n", (F.col("total") / F.col("n")).alias("mean"))


@query("u7_filtered_pivot", f"""
    SELECT month, coalesce(sum(n) FILTER (o_orderstatus = 'O'), 0)::BIGINT AS "O", coalesce(sum(n) FILTER (o_orderstatus = 'F'), 0)::BIGINT AS "F"
    FROM ({_MONTHLY}) WHERE o_orderpriority = '1-URGENT' GROUP BY ALL""")
def u7(spark, d):
    rows = monthly_by_priority(spark, d).where("o_orderpriority = '1-URGENT'")
    return r.pivot_fixed(rows, ["month"], "o_orderstatus", ["O", "F"], "n")


@query("j8_combine_series", f"""
    SELECT month, max(n) FILTER (o_orderpriority = '1-URGENT' AND m % 2 = 0)::DOUBLE AS urgent, max(n) FILTER (o_orderpriority = '5-LOW' AND m % 3 = 0)::DOUBLE AS low
    FROM (SELECT *, substr(month, 6, 2)::INT AS m FROM ({_MONTHLY})) GROUP BY ALL""")
def j8(spark, d):
    """Two series with unknown months beside an anchor that knows all of them."""
    rows = monthly_by_priority(spark, d).withColumn("n", F.col("n").cast("double"))
    month = F.substring("month", 6, 2).cast("int")
    parts = {name: rows.where(F.col("o_orderpriority") == p).withColumn("n", F.when(month % every == 0, F.col("n")))
             for name, p, every in (("urgent", "1-URGENT", 2), ("low", "5-LOW", 3), ("anchor", "2-HIGH", 1))}
    return r.combine_series(parts, "month", "n", anchor="anchor")


# --- chunked series ------------------------------------------------------------------------

@query("w8_chunk_windows", """
    WITH RECURSIVE span AS (SELECT c_nationkey::BIGINT AS k, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS z
                  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
    w AS (SELECT k, a, z, 0 AS chunk, a AS chunk_start, least((a + INTERVAL 24 MONTH)::DATE, z) AS chunk_end FROM span
          UNION ALL
          SELECT k, a, z, chunk + 1, (chunk_end - INTERVAL 3 MONTH)::DATE, least(((chunk_end - INTERVAL 3 MONTH)::DATE + INTERVAL 24 MONTH)::DATE, z)
          FROM w WHERE (chunk_end - INTERVAL 3 MONTH)::DATE < z AND (chunk_end - INTERVAL 3 MONTH)::DATE > chunk_start)
    SELECT k, chunk::BIGINT AS chunk, chunk_start::VARCHAR AS chunk_start, chunk_end::VARCHAR AS chunk_end
    FROM w""")
def w8(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    span = rows.groupBy(F.col("c_nationkey").cast("bigint").alias("k")).agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z"))
    windows = F.explode(s.chunk_windows(F.col("a"), F.col("z"), 24, 3)).alias("w")
    return span.select("k", windows).select("k", "w.*")


def trend_chunks(spark, d):
    """Daily event counts per type in windows of 15 days, step 11, each on a scale of its own.

    Window 1 is all zero over its first four days, so that the fallback scale takes part.
    """
    daily = table(spark, d, "events").groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    at = F.datediff("day", daily.agg(F.min("day").alias("d")).select("d").scalar())
    windows = F.sequence(F.greatest(F.lit(0).cast("long"), F.floor((at - 15) / 11) + 1), F.floor(at / 11))
    rows = daily.select("series", "day", "n", at.alias("at"), F.explode(windows).alias("chunk"))
    level = F.when((F.col("chunk") == 1) & (F.col("at") < 15), 0.0).otherwise(F.col("n") * (F.col("chunk") + 1) / 4)
    return rows.select("series", "chunk", "day", level.alias("value"))


_CHUNKS = """
    SELECT series, chunk, day, CASE WHEN chunk = 1 AND pos < 15 THEN 0.0 ELSE n * (chunk + 1) / 4 END::DOUBLE AS value
    FROM (SELECT event_type AS series, ts::DATE AS day, count(*)::DOUBLE AS n, ts::DATE - (SELECT min(ts)::DATE FROM events) AS pos FROM events GROUP BY ALL) e,
    LATERAL (SELECT unnest(generate_series(greatest(0, floor((pos - 15) / 11.0) + 1)::BIGINT, floor(pos / 11.0)::BIGINT)) AS chunk) c"""

_STITCHED = f"""
    WITH RECURSIVE c AS MATERIALIZED ({_CHUNKS}),
    r AS (SELECT o.series, o.chunk, sum(p.value) AS ref, sum(o.value) AS own FROM c o JOIN c p
          ON p.series = o.series AND p.day = o.day AND p.chunk = o.chunk - 1 GROUP BY ALL),
    f AS (SELECT DISTINCT c.series, 0::BIGINT AS chunk, 1.0::DOUBLE AS scale FROM c
          UNION ALL
          SELECT f.series, f.chunk + 1, CASE WHEN r.own > 0 THEN f.scale * r.ref / r.own ELSE 1.0 END
          FROM f JOIN r ON r.series = f.series AND r.chunk = f.chunk + 1)
    SELECT c.series, c.day, c.chunk, c.value * f.scale AS value FROM c JOIN f USING (series, chunk)
    WHERE NOT EXISTS (SELECT 1 FROM c e WHERE e.series = c.series AND e.day = c.day AND e.chunk < c.chunk)"""


@query("w7_stitch_chunks", f"SELECT series, day::VARCHAR AS day, chunk, round(value, 6) AS value FROM ({_STITCHED})")
def w7(spark, d):
    done = s.stitch(trend_chunks(spark, d), ["series"], "chunk", "day", "value")
    return done.withColumn("value", F.round("value", 6))


@query("w7_stitch_chunks_tail", f"SELECT series, day::VARCHAR AS day, chunk, round(value, 6) AS value FROM ({_STITCHED})")
def w7_tail(spark, d):
    done = s.stitch(trend_chunks(spark, d), ["series"], "chunk", "day", "value", fill="tail")
    return done.withColumn("value", F.round("value", 6))


@query("v11_monthly_trend", f"""
    SELECT series, last_day(day)::VARCHAR AS month, round(avg(value), 6) AS value FROM ({_STITCHED}) GROUP BY ALL""")
def v11(spark, d):
    from tidemark.plans.trends import monthly_trend

    long = monthly_trend(trend_chunks(spark, d), ["series"], "chunk", "day", "value")
    return long.withColumn("value", F.round("value", 6))


# --- data quality --------------------------------------------------------------------------

@query("q1_gap_warnings", """
    SELECT user_id, day::VARCHAR AS day, before::VARCHAR AS prev_date, (day - before)::BIGINT AS gap_days FROM (
        SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS before
        FROM (SELECT DISTINCT user_id, ts::DATE AS day FROM events)) WHERE day - before > 1""")
def q1(spark, d):
    days = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    return q.gaps(days, "day", 1, ["user_id"])


@query("q2_missing_dates", """
    WITH k AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem)
    SELECT u::DATE::VARCHAR AS day FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS u FROM k)
    WHERE u::DATE NOT IN (SELECT o_orderdate::DATE FROM orders) AND u::DATE BETWEEN (SELECT min(o_orderdate)::DATE FROM orders)
      AND (SELECT max(o_orderdate)::DATE FROM orders)""")
def q2(spark, d):
    return q.missing_dates(table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")), "day")


def garbled_documents(spark, d):
    """Texts damaged by reading their UTF-8 bytes as Latin-1."""
    docs = table(spark, d, "documents")
    return docs.withColumn("text", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"))


@query("q3_mojibake_counts", """
    SELECT 'text' AS column_name, count(*) FILTER (regexp_matches(text, '[À-ÿ]')) AS garbled FROM documents
    UNION ALL SELECT 'source', 0""")
def q3(spark, d):
    return q.mojibake(garbled_documents(spark, d), ["text", "source"])


@query("q3_mojibake_repair", """
    SELECT doc_id, md5(text) AS text_md5, length(text) AS n FROM documents""")
def q3_repair(spark, d):
    fixed = q.repair(garbled_documents(spark, d), ["text"])
    return fixed.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"))


@query("q4_low_volume", """
    SELECT c_mktsegment, c_nationkey::BIGINT AS c_nationkey, count(*) AS rows, 12 AS minimum FROM customer GROUP BY ALL HAVING count(*) < 12""")
def q4(spark, d):
    return q.low_volume(table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"], 12)


@query("q4_low_volume_by_source", """
    SELECT n_nationkey::BIGINT AS c_nationkey, count(c_custkey) AS rows, (50 + n_nationkey)::BIGINT AS minimum
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL HAVING count(c_custkey) < 50 + n_nationkey""")
def q4_table(spark, d):
    wanted = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), (50 + F.col("n_nationkey")).cast("bigint").alias("minimum"))
    return q.low_volume(table(spark, d, "customer"), ["c_nationkey"], wanted)


@query("q5_reconcile", """
    SELECT coalesce(a.day, b.day) AS day, CASE WHEN b.day IS NULL THEN 'only_a' WHEN a.day IS NULL THEN 'only_b'
           WHEN a.n = b.n THEN 'exact' ELSE 'mismatch' END AS verdict
    FROM (SELECT o_orderdate::DATE::VARCHAR AS day, count(*) AS n FROM orders GROUP BY ALL) a
    FULL JOIN (SELECT l_shipdate::DATE::VARCHAR AS day, count(*) AS n FROM lineitem GROUP BY ALL) b USING (day)""")
def q5(spark, d):
    a_side = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    b_side = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    return q.reconcile(a_side, b_side, ["day"], ["n"])


@query("q6_duplicate_keys", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def q6(spark, d):
    return q.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q7_zero_days", """
    SELECT day::VARCHAR AS day, count(*) AS rows FROM (
        SELECT o_orderdate::DATE AS day, CASE WHEN o_totalprice > 100000 THEN o_totalprice ELSE 0 END AS v FROM orders)
    GROUP BY ALL HAVING sum(v) = 0""")
def q7(spark, d):
    rows = table(spark, d, "orders").select(
        F.to_date("o_orderdate").alias("day"), F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).otherwise(0.0).alias("v"))
    return q.zero_days(rows, "day", ["v"])

"""Check queries: the composite views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import month_key
from tidemark.functions.fixed_values import FALLBACK_RATES, MARKET_CURRENCY, MARKET_PRIORITY
from tidemark.functions.once import keep_if
from tidemark.operators.aggregates import explode_events
from tidemark.operators.filters import whole_word
from tidemark.operators.joins import enrich
from tidemark.plans import catalog, notices, prices, rankings, reviews
from tidemark.plans.trends import trend_rows, upsert_trend
from tidemark.operators.series import stitch, to_month
from tidemark.sources.tables import upsert
from tidemark.workload import bindings as b
from tidemark.workload.measures import _REVIEW_ROWS, _STITCHED, review_rows, trend_chunks
from tidemark.workload.payloads import _AWARDED, new_folder, notice_documents
from tidemark.workload.registry import query, table


# --- catalog -------------------------------------------------------------------------------

def site_snapshot(spark, d):
    """Daily site snapshot: store facts with brand, title, category path and two prices."""
    key = F.col("variant_id")
    return b.store_snapshot(spark, d).select(
        "snapshot_date", F.col("store").alias("site"), key.alias("product_key"), F.concat(F.lit("brand"), key % 9).alias("brand"),
        F.concat(F.lit("title"), key).alias("title"), F.concat(F.lit("top"), key % 2, F.lit(" > mid"), key % 3, F.lit(" > leaf")).alias("category"),
        F.concat(F.lit("S"), key % 4).alias("size"), F.col("quantity").alias("stock"), F.col("price").alias("sell_price"), (F.col("price") + 5).alias("list_price"))


_STEPS = f"""
    SELECT c.snapshot_date, c.store AS site, c.variant_id AS product_key, 'brand' || (c.variant_id % 9) AS brand, c.quantity AS stock, o.quantity AS before,
           'top' || (c.variant_id % 2) || '>mid' || (c.variant_id % 3) AS category_group, c.price,
           CASE WHEN o.quantity IS NULL THEN 'first' WHEN c.quantity - o.quantity >= 10 THEN 'restock' WHEN c.quantity > o.quantity THEN 'return' ELSE 'sale' END
               AS kind, CASE WHEN o.quantity IS NULL OR c.quantity - o.quantity >= 10 THEN 0 ELSE o.quantity - c.quantity END AS sold
    FROM ({b.STORE_SNAPSHOT}) c
    JOIN (SELECT d, lag(d) OVER (ORDER BY d) AS prior FROM (SELECT DISTINCT ts::DATE AS d FROM events)) k ON k.d = c.snapshot_date
    LEFT JOIN ({b.STORE_SNAPSHOT}) o ON o.snapshot_date = k.prior AND o.store = c.store AND o.variant_id = c.variant_id"""


@query("v5_site_daily_summary", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, CASE WHEN grouping(site) = 0 THEN 'site' WHEN grouping(category_group) = 0 THEN 'category_group'
           WHEN grouping(brand) = 0 THEN 'brand' ELSE 'total' END AS dimension, coalesce(site, category_group, brand) AS member,
           count(*) AS total_products, sum(sold)::BIGINT AS est_sold_units, sum(sold * price)::DOUBLE AS sell_rev,
           sum(sold * (price + 5))::DOUBLE AS list_rev, count(*) FILTER (kind = 'restock') AS restocks, count(*) FILTER (kind = 'return') AS returns
    FROM ({_STEPS}) GROUP BY GROUPING SETS ((snapshot_date), (snapshot_date, site), (snapshot_date, category_group), (snapshot_date, brand))""")
def v5(spark, d):
    return catalog.site_daily_summary(site_snapshot(spark, d))


@query("v5_day_row", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, count(*) AS total_products, sum(sold)::BIGINT AS est_sold_units, sum(sold * price)::DOUBLE AS sell_rev,
           sum(sold * (price + 5))::DOUBLE AS list_rev, count(*) FILTER (kind = 'restock') AS restocks, count(*) FILTER (kind = 'return') AS returns,
           count(DISTINCT site) AS sites, count(DISTINCT category_group) AS categories, count(DISTINCT brand) AS brands,
           sum(sold) FILTER (site = 'click')::BIGINT AS click_units, sum(sold * price) FILTER (brand = 'brand3')::DOUBLE AS brand3_rev,
           count(*) FILTER (category_group = 'top1>mid2' AND kind = 'restock') AS group_restocks
    FROM ({_STEPS}) GROUP BY ALL""")
def v5_day(spark, d):
    rows = catalog.daily_row(site_snapshot(spark, d))
    maps = {"sites": "by_site", "categories": "by_category", "brands": "by_brand"}
    return rows.select(
        "snapshot_date", "total_products", "est_sold_units", "sell_rev", "list_rev", "restocks", "returns",
        *[F.size(m).alias(name) for name, m in maps.items()],
        F.try_element_at("by_site", F.lit("click"))["est_sold_units"].alias("click_units"),
        F.try_element_at("by_brand", F.lit("brand3"))["sell_rev"].alias("brand3_rev"),
        F.coalesce(F.try_element_at("by_category", F.lit("top1>mid2"))["restocks"], F.lit(0)).alias("group_restocks"))


@query("v5_detail_rows", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, site, product_key, kind, sold::BIGINT AS sold,
           {', '.join(f"max((site = '{s}')::INT) OVER w::BIGINT AS in_{s}" for s in ("click", "view", "signup"))},
           (max((site = 'click')::INT) OVER w + max((site = 'view')::INT) OVER w + max((site = 'signup')::INT) OVER w)::BIGINT AS listed_count
    FROM ({_STEPS}) WINDOW w AS (PARTITION BY snapshot_date, product_key)""")
def v5_detail(spark, d):
    rows = catalog.detail_rows(site_snapshot(spark, d), ["click", "view", "signup"])
    return rows.select("snapshot_date", "site", "product_key", "kind", F.col("sold").cast("bigint").alias("sold"), "in_click", "in_view", "in_signup", "listed_count")


@query("v5_restock_events", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, product_key, site, brand, 'S' || product_key % 4 AS size, before AS stock_before, stock AS stock_after, stock - before AS delta,
           price::DOUBLE AS sell_price FROM ({_STEPS}) WHERE kind = 'restock'""")
def v5_events(spark, d):
    packed = catalog.daily_events(site_snapshot(spark, d), "restock")
    return explode_events(packed, "restock_events", "product_key:bigint,site:string,brand:string,size:string,stock_before:bigint,"
                          "stock_after:bigint,delta:bigint,sell_price:decimal(10,2)")


def _colours(cut: str) -> str:
    base = "split_part(key, '-', 1)" if cut == "first" else "regexp_replace(key, '-[^-]*$', '')"
    return f"""
    SELECT base_key, market, title, category, week AS sale_last_week, days AS sale_last_days, sell * rate / 11.5::DOUBLE AS sell_price,
           list * rate / 11.5::DOUBLE AS list_price, sell, list
    FROM (SELECT base_key, market, arg_min(title, rank_in) AS title, arg_min(category, rank_in) AS category, max(sale_last_week) AS week,
                 max(sale_last_days) AS days, arg_min(sell_price, rank_in) AS sell, arg_min(list_price, rank_in) AS list
          FROM (SELECT *, {base} AS base_key, ordinal + CASE WHEN sell_price > 0 THEN 0 ELSE 1000000000000 END AS rank_in,
                       min(list_position(['DE','SE','NO','UK','COM'], market)) OVER (PARTITION BY {base}) AS best
                FROM ({b.COUNTER_SNAPSHOT}))
          WHERE list_position(['DE','SE','NO','UK','COM'], market) = best GROUP BY ALL)
    JOIN (SELECT unnest(['DE','SE','NO','UK','COM']) AS market, unnest([11.5::DOUBLE, 1.0, 0.97, 13.0, 11.5]) AS rate) USING (market)"""


@query("v6_product_colours", f"""
    SELECT base_key, market, title, category, sale_last_week, sale_last_days, round(sell_price, 6) AS sell_price, round(list_price, 6) AS list_price
    FROM ({_colours('first')})""")
def v6(spark, d):
    rows = catalog.product_colours(b.counter_snapshot(spark, d), b.rates(spark, d), MARKET_CURRENCY, MARKET_PRIORITY, rounded=False)
    return rows.drop("discount_pct").withColumns({c: F.round(c, 6) for c in ("sell_price", "list_price")})


@query("v6_counter_revenue", f"""
    SELECT category, round(sum(sale_last_week * sell_price), 4) AS sale_last_week_x_sell_price, round(sum(sale_last_week * list_price), 4) AS sale_last_week_x_list_price,
           round(sum(sale_last_days * sell_price), 4) AS sale_last_days_x_sell_price, round(sum(sale_last_days * list_price), 4) AS sale_last_days_x_list_price,
           count(*) AS total, count(*) FILTER (sale_last_week > 0 OR sale_last_days > 0) AS with_sales
    FROM ({_colours('first')}) GROUP BY ALL""")
def v6_revenue(spark, d):
    colours = catalog.product_colours(b.counter_snapshot(spark, d), b.rates(spark, d), MARKET_CURRENCY, MARKET_PRIORITY, rounded=False)
    rows = catalog.counter_revenue(colours, ["category"])
    return rows.withColumns({c: F.round(c, 4) for c in rows.columns if "_x_" in c})


def _summed(scale: int, value: str) -> str:
    """A category rounds its sum; the total adds rounded products."""
    each = f"sum(round_even({value}, {scale})::DECIMAL(18,{scale}))::DOUBLE"
    return f"CASE WHEN grouping(category) = 1 THEN {each} ELSE round_even(sum({value}), {scale}) END"


@query("v7_category_estimate", f"""
    SELECT *, CASE WHEN revenue_list > 0 THEN round_even(100.0::DOUBLE * (1.0::DOUBLE - revenue_sell / revenue_list), 1) ELSE 0 END AS avg_discount_pct FROM (
        SELECT category, {_summed(1, 'units')} AS units, {_summed(2, 'units * sell_price')} AS revenue_sell,
               {_summed(2, 'units * list_price')} AS revenue_list, count(*) AS product_colours
        FROM (SELECT *, sale_last_week / 7.0::DOUBLE AS units FROM ({_colours('last')})) WHERE sale_last_week > 0 GROUP BY GROUPING SETS ((), (category)))""")
def v7(spark, d):
    colours = catalog.product_colours(
        b.counter_snapshot(spark, d), b.rates(spark, d), MARKET_CURRENCY, MARKET_PRIORITY, cut="last", rounded=False)
    return catalog.category_estimate(colours)


@query("a23_counter_to_daily_estimate", f"""
    SELECT base_key AS base, market, sale_last_week / 7.0::DOUBLE AS daily, round(sale_last_week / 7.0::DOUBLE * sell_price, 6) AS revenue
    FROM ({_colours('first')}) WHERE sale_last_week > 0""")
def a23(spark, d):
    """The greatest counter in the first market that lists a base key, as units and revenue a day."""
    colours = catalog.product_colours(b.counter_snapshot(spark, d), b.rates(spark, d), MARKET_CURRENCY, MARKET_PRIORITY, rounded=False)
    return catalog.daily_estimate(colours).select(
        F.col("base_key").alias("base"), "market", F.col("units").alias("daily"), F.round("revenue_sell", 6).alias("revenue"))


# --- reviews -------------------------------------------------------------------------------

REVIEW_LABELS = {"click": "DE", "view": "SE", "signup": "DE"}


def review_runs(spark, d):
    """Cumulative counts in two runs a day: the first one counted wrongly and knows products that the last one lacks."""
    from pyspark.sql import Window

    daily = table(spark, d, "events").groupBy(
        F.to_date("ts").alias("snapshot_date"), F.col("user_id").alias("product"), F.col("event_type").alias("channel")).agg(F.count(F.lit(1)).alias("n"))
    # One row per day and key after the count: the running window is no longer than the calendar.
    running = Window.partitionBy("product", "channel").orderBy("snapshot_date")
    last = daily.select("snapshot_date", F.lit(2).alias("run"), "product", "channel", F.sum("n").over(running).alias("count"))
    wrong = last.withColumns({"run": F.lit(1), "count": F.col("count") + 100})
    return last.union(wrong).union(wrong.withColumns({"product": F.col("product") + 1_000_000, "channel": F.lit("gone")}))


@query("v8_review_proxy_summary", f"""
    WITH c AS ({b.REVIEW_COUNTS}),
    p AS (SELECT snapshot_date, product, sum(count) AS count FROM c GROUP BY ALL),
    g AS (SELECT *, greatest(0, count - coalesce(lag(count) OVER (PARTITION BY product ORDER BY snapshot_date), 0)) AS fresh FROM p),
    t AS (SELECT snapshot_date, sum(count)::BIGINT AS total_reviews, sum(fresh)::BIGINT AS total_new_reviews,
                 sum(fresh * CASE WHEN product % 4 = 0 THEN 0 ELSE 10 + product % 7 END)::DOUBLE AS proxy_value FROM g GROUP BY ALL),
    ch AS (SELECT snapshot_date, channel, sum(count) AS count FROM c GROUP BY ALL),
    k AS (SELECT day, lag(day) OVER (ORDER BY day) AS prior FROM (SELECT DISTINCT snapshot_date AS day FROM c)),
    gc AS (SELECT n.*, greatest(0, n.count - coalesce(o.count, 0)) AS fresh FROM ch n JOIN k ON k.day = n.snapshot_date
           LEFT JOIN ch o ON o.snapshot_date = k.prior AND o.channel = n.channel),
    ct AS (SELECT snapshot_date, sum(CASE WHEN channel IN ('click', 'signup') THEN fresh ELSE 0 END)::BIGINT AS "new_DE",
                  sum(CASE WHEN channel = 'view' THEN fresh ELSE 0 END)::BIGINT AS "new_SE",
                  sum(CASE WHEN channel IN ('error', 'purchase') THEN fresh ELSE 0 END)::BIGINT AS new_other FROM gc GROUP BY ALL),
    s AS (SELECT f AS snapshot_date, count(*) AS n FROM (SELECT channel, min(snapshot_date) AS f FROM ch GROUP BY channel)
          WHERE f > (SELECT min(snapshot_date) FROM ch) GROUP BY f)
    SELECT snapshot_date::VARCHAR AS snapshot_date, total_reviews, total_new_reviews, proxy_value, "new_DE", "new_SE", new_other,
           coalesce(n, 0)::BIGINT AS new_channels FROM t JOIN ct USING (snapshot_date) LEFT JOIN s USING (snapshot_date)""")
def v8(spark, d):
    product = F.col("user_id").alias("product")
    prices_known = table(spark, d, "events").select(product).distinct().where(F.col("product") % 4 != 0).withColumn(
        "price", (10 + F.col("product") % 7).cast("double"))
    return reviews.proxy_summary(review_runs(spark, d), prices_known, REVIEW_LABELS, ["DE", "SE"])


_REVIEW_FACTS = """
    SELECT ts::DATE AS day, event_type AS channel, ['PANTS', 'TOPS', 'HATS'][user_id % 3 + 1] AS category, ['MEN', 'WOMEN'][user_id % 2 + 1] AS gender,
           'w' || weekofyear(ts) AS language, (event_id % 5) / 4.0::DOUBLE AS rating FROM events"""


def review_aggregates(spark, d):
    """Cumulative counts per member of four dimensions, and per rating, in two runs a day: the first one counted wrongly."""
    from pyspark.sql import Window

    user = F.col("user_id")
    members = {
        "channel": F.col("event_type"), "category": F.element_at(F.array(F.lit("PANTS"), F.lit("TOPS"), F.lit("HATS")), (user % 3 + 1).cast("int")),
        "gender": F.element_at(F.array(F.lit("MEN"), F.lit("WOMEN")), (user % 2 + 1).cast("int")),
        "language": F.concat(F.lit("w"), F.weekofyear("ts")), "rating": ((F.col("event_id") % 5) / 4).cast("string"),
    }
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), c.alias("member")) for n, c in members.items()])).alias("m")
    daily = table(spark, d, "events").select(F.to_date("ts").alias("snapshot_date"), each).select("snapshot_date", "m.*").groupBy(
        "snapshot_date", "dimension", "member").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("dimension", "member").orderBy("snapshot_date")
    last = daily.select("snapshot_date", F.lit(2).alias("run"), "dimension", "member", F.sum("n").over(running).alias("count"))
    wrong = last.withColumns({"run": F.lit(1), "count": F.col("count") + 100, "member": F.when(F.col("dimension") == "language", "gone").otherwise(F.col("member"))})
    both = last.union(wrong)
    rated = both.where("dimension = 'rating'").select("snapshot_date", "run", F.col("member").cast("double").alias("rating"), "count")
    return both.where("dimension <> 'rating'"), rated


@query("v8_review_summary", f"""
    WITH c AS ({b.REVIEW_COUNTS}), facts AS ({_REVIEW_FACTS}),
    p AS (SELECT snapshot_date, product, sum(count) AS count FROM c GROUP BY ALL),
    g AS (SELECT *, greatest(0, count - coalesce(lag(count) OVER (PARTITION BY product ORDER BY snapshot_date), 0)) AS fresh FROM p),
    t AS (SELECT snapshot_date, sum(count)::BIGINT AS total_reviews, sum(fresh)::BIGINT AS total_new_reviews,
                 sum(fresh * CASE WHEN product % 4 = 0 THEN 0 ELSE 10 + product % 7 END)::DOUBLE AS proxy_value FROM g GROUP BY ALL),
    long AS (SELECT day, 'channel' AS dim, channel AS member FROM facts UNION ALL SELECT day, 'category', category FROM facts
             UNION ALL SELECT day, 'gender', gender FROM facts UNION ALL SELECT day, 'language', language FROM facts),
    cum AS (SELECT day, dim, member, sum(count(*)) OVER (PARTITION BY dim, member ORDER BY day) AS count FROM long GROUP BY day, dim, member),
    k AS (SELECT day, lag(day) OVER (ORDER BY day) AS prior FROM (SELECT DISTINCT day FROM cum)),
    gm AS (SELECT n.*, greatest(0, n.count - coalesce(o.count, 0)) AS fresh FROM cum n JOIN k USING (day)
           LEFT JOIN cum o ON o.day = k.prior AND o.dim = n.dim AND o.member = n.member),
    w AS (SELECT day, coalesce(sum(fresh) FILTER (dim = 'channel' AND member IN ('click', 'signup')), 0)::BIGINT AS "new_DE",
                 coalesce(sum(fresh) FILTER (dim = 'channel' AND member = 'view'), 0)::BIGINT AS "new_SE",
                 coalesce(sum(fresh) FILTER (dim = 'channel' AND member NOT IN ('click', 'signup', 'view')), 0)::BIGINT AS new_other_country,
                 coalesce(sum(fresh) FILTER (member = 'PANTS'), 0)::BIGINT AS "new_PANTS", coalesce(sum(fresh) FILTER (member = 'TOPS'), 0)::BIGINT AS "new_TOPS",
                 coalesce(sum(fresh) FILTER (member = 'HATS'), 0)::BIGINT AS new_other_cat, coalesce(sum(fresh) FILTER (member = 'MEN'), 0)::BIGINT AS "new_MEN",
                 coalesce(sum(fresh) FILTER (member = 'WOMEN'), 0)::BIGINT AS "new_WOMEN" FROM gm GROUP BY day),
    s AS (SELECT f AS day, string_agg(member, ',' ORDER BY member) FILTER (dim = 'channel') AS ch, string_agg(member, ',' ORDER BY member) FILTER (dim = 'language') AS la
          FROM (SELECT dim, member, min(day) AS f FROM cum GROUP BY ALL) WHERE f > (SELECT min(day) FROM cum) GROUP BY f),
    r AS (SELECT day, rating, sum(count(*)) OVER (PARTITION BY rating ORDER BY day) AS count FROM facts GROUP BY day, rating),
    rr AS (SELECT day, round_even(sum(rating * count) / sum(count) * 5, 3) AS avg_rating,
                  round_even(coalesce(sum(count) FILTER (rating = 1), 0)::DOUBLE / sum(count) * 100, 1) AS pct_top FROM r GROUP BY day)
    SELECT t.snapshot_date::VARCHAR AS snapshot_date, total_reviews, total_new_reviews, proxy_value, avg_rating, pct_top, w.* EXCLUDE (day),
           coalesce(ch, '') AS new_channels, coalesce(la, '') AS new_languages
    FROM t JOIN w ON w.day = t.snapshot_date JOIN rr ON rr.day = t.snapshot_date LEFT JOIN s ON s.day = t.snapshot_date""")
def v8_summary(spark, d):
    product = F.col("user_id").alias("product")
    known = table(spark, d, "events").select(product).distinct().where(F.col("product") % 4 != 0).withColumn(
        "price", (10 + F.col("product") % 7).cast("double"))
    aggregates, ratings = review_aggregates(spark, d)
    return reviews.review_summary(
        review_runs(spark, d), known, aggregates, ratings,
        {"channel": ["DE", "SE"], "category": ["PANTS", "TOPS"], "gender": ["MEN", "WOMEN"]}, {"channel": REVIEW_LABELS},
        {"channel": "new_other_country", "category": "new_other_cat"}, {"channel": "new_channels", "language": "new_languages"})


@query("v9_monthly_history", f"""
    SELECT month, count(*) AS total, count(*) FILTER (NOT is_big) AS total_uncapped, count(*) FILTER (country = 'DE') AS "country_DE",
           count(*) FILTER (country = 'SE') AS "country_SE", count(*) FILTER (country NOT IN ('DE', 'SE')) AS country_other,
           count(*) FILTER (category = 'PANTS') AS "category_PANTS", count(*) FILTER (category <> 'PANTS') AS category_other
    FROM ({_REVIEW_ROWS}) GROUP BY ALL""")
def v9(spark, d):
    return reviews.monthly_history(
        review_rows(spark, d), {"country": F.col("country"), "category": F.col("category")},
        {"country": ["DE", "SE"], "category": ["PANTS"]}, F.col("is_big"))


@query("v9_target_share", r"""
    SELECT strftime(l_shipdate, '%Y-%m') AS month, p_type AS category, count(*) FILTER (regexp_matches(p_name, '\bring\b') AND p_name NOT LIKE '%blue%') AS targets,
           count(*) AS total, round_even(100.0::DOUBLE * count(*) FILTER (regexp_matches(p_name, '\bring\b') AND p_name NOT LIKE '%blue%') / count(*), 2) AS share_pct
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def v9_share(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", F.col("p_type").alias("category"))
    rows = enrich(table(spark, d, "lineitem").select("l_partkey", month_key(F.col("l_shipdate")).alias("month")), parts, ["l_partkey"], "inner")
    return reviews.target_share(rows, "month", whole_word(F.col("p_name"), "ring", ["blue"]), F.col("category"))


@query("v9_two_source_share", r"""
    WITH i AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, CASE WHEN p_size % 2 = 0 THEN 'PANTS' ELSE 'JACKETS' END AS category, count(*) AS n
               FROM lineitem JOIN part ON p_partkey = l_partkey
               WHERE regexp_matches(p_name, '\bring\b') AND NOT (p_size % 2 = 0 AND p_name LIKE '%blue%') GROUP BY ALL),
    h AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN o_orderkey % 2 = 0 THEN 'PANTS' ELSE 'JACKETS' END AS category, count(*) AS n FROM orders GROUP BY ALL),
    f AS (SELECT coalesce(i.month, h.month) AS month, coalesce(i.category, h.category) AS category, coalesce(i.n, 0) AS s, coalesce(h.n, 0) AS t
          FROM i FULL JOIN h ON i.month = h.month AND i.category = h.category)
    SELECT month, coalesce(sum(s) FILTER (category = 'PANTS'), 0)::BIGINT AS "PANTS_targets", coalesce(sum(t) FILTER (category = 'PANTS'), 0)::BIGINT AS "PANTS_total",
           round_even(100.0::DOUBLE * "PANTS_targets" / nullif("PANTS_total", 0), 2) AS "PANTS_share_pct",
           coalesce(sum(s) FILTER (category = 'JACKETS'), 0)::BIGINT AS "JACKETS_targets", coalesce(sum(t) FILTER (category = 'JACKETS'), 0)::BIGINT AS "JACKETS_total",
           round_even(100.0::DOUBLE * "JACKETS_targets" / nullif("JACKETS_total", 0), 2) AS "JACKETS_share_pct" FROM f GROUP BY ALL""")
def v9_two_sources(spark, d):
    category = F.when(F.col("p_size") % 2 == 0, "PANTS").otherwise("JACKETS")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", category.alias("category"))
    items = enrich(table(spark, d, "lineitem").select("l_partkey", month_key(F.col("l_shipdate")).alias("month")), parts, ["l_partkey"], "inner")
    kind = F.when(F.col("o_orderkey") % 2 == 0, "PANTS").otherwise("JACKETS")
    totals = table(spark, d, "orders").groupBy(month_key(F.col("o_orderdate")).alias("month"), kind.alias("category")).agg(F.count(F.lit(1)).alias("total"))
    return reviews.two_source_share(items, totals, "month", "category", "p_name", "ring", ["PANTS", "JACKETS"], {"PANTS": ["blue"]})


# --- prices --------------------------------------------------------------------------------

def partner_cells(spark, d):
    """Order totals as localised table cells; the customer's nation gives country and currency."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    at = (F.col("c_nationkey") % 4 + 1).cast("int")
    country = F.element_at(F.array(*[F.lit(x) for x in ("Sweden", "Denmark", "Norway", "Finland")]), at)
    expected = F.element_at(F.array(*[F.lit(x) for x in ("SEK", "DKK", "NOK", "EUR")]), at)
    amount = F.format_string("%d,%02d", F.floor("o_totalprice"), F.col("o_orderkey") % 100)
    unit = F.element_at(F.array(*[F.lit(x) for x in (" kr", " EUR", "", " €")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    text = F.when(F.col("o_orderkey") % 11 == 0, "No data").otherwise(F.concat(amount, unit))
    return rows.select((F.col("c_mktsegment") == "BUILDING").alias("is_finance"), country.alias("country"), expected.alias("currency"), text.alias("text"))


_CELLS = """
    SELECT (c_mktsegment = 'BUILDING')::BIGINT AS is_finance, ['Sweden','Denmark','Norway','Finland'][c_nationkey % 4 + 1] AS country,
           (floor(o_totalprice)::BIGINT || '.' || lpad((o_orderkey % 100)::VARCHAR, 2, '0'))::DOUBLE * CASE o_orderkey % 4 WHEN 1 THEN 11.5::DOUBLE WHEN 3 THEN 11.5
               ELSE [1.0::DOUBLE, 1.5, 0.97, CASE o_orderkey % 4 WHEN 0 THEN 1.0 ELSE 11.5 END][c_nationkey % 4 + 1] END AS v
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 11 <> 0"""


@query("v10_partner_medians", f"""
    WITH m AS (SELECT is_finance, country, median(v) AS median, count(*) AS n FROM ({_CELLS}) GROUP BY ALL)
    SELECT is_finance, country, round(median, 6) AS median, n FROM m
    UNION ALL SELECT is_finance, NULL, round(median(median), 6), count(*) FROM m GROUP BY is_finance""")
def v10(spark, d):
    rows = prices.epc_medians(partner_cells(spark, d), b.rates(spark, d), ["is_finance"])
    return rows.withColumn("median", F.round("median", 6))


@query("v10_partner_medians_pooled", f"""
    SELECT is_finance, country, round(median(v), 6) AS median, count(*) AS n FROM ({_CELLS}) GROUP BY GROUPING SETS ((is_finance, country), (is_finance))""")
def v10_pooled(spark, d):
    rows = prices.epc_medians(partner_cells(spark, d), b.rates(spark, d), ["is_finance"], overall="pooled")
    return rows.withColumn("median", F.round("median", 6))


@query("v14_source_price_stats", """
    SELECT month, o_orderpriority, n, (s // n + CASE WHEN 2 * (s % n) > n OR (2 * (s % n) = n AND (s // n) % 2 = 1) THEN 1 ELSE 0 END)::DOUBLE / 100
           AS average_price, (l[(n + 1) // 2] + l[n // 2 + 1])::DOUBLE / 200 AS median_price
    FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) AS n, sum(c)::BIGINT AS s, list_sort(list(c)) AS l
          FROM (SELECT o_orderdate, o_orderpriority, floor(o_totalprice)::BIGINT * 100 + o_orderkey % 50 * 2 AS c FROM orders) GROUP BY ALL)""")
def v14(spark, d):
    text = F.concat(F.format_string("%,d", F.floor("o_totalprice").cast("bigint")), F.lit("."), F.format_string("%02d", F.col("o_orderkey") % 50 * 2), F.lit(" SEK"))
    rows = table(spark, d, "orders").select(
        month_key(F.col("o_orderdate")).alias("month"), "o_orderpriority", text.alias("text"))
    return prices.source_price_stats(rows, ["month", "o_orderpriority"], "text")


@query("v14_wide_price_report", """
    WITH l AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS p, count(*) AS n, sum(c)::BIGINT AS s, list_sort(list(c)) AS l
               FROM (SELECT o_orderdate, o_orderpriority, floor(o_totalprice)::BIGINT * 100 + o_orderkey % 50 * 2 AS c FROM orders) GROUP BY ALL),
    v AS (SELECT month, p, (s // n + CASE WHEN 2 * (s % n) > n OR (2 * (s % n) = n AND (s // n) % 2 = 1) THEN 1 ELSE 0 END)::DOUBLE / 100 AS a,
                 (l[(n + 1) // 2] + l[n // 2 + 1])::DOUBLE / 200 AS m FROM l)
    SELECT month, max(a) FILTER (p = '1-URGENT') AS average_price_urgent, max(a) FILTER (p = '5-LOW') AS average_price_low, NULL::DOUBLE AS average_price_closed,
           max(m) FILTER (p = '1-URGENT') AS median_price_urgent, max(m) FILTER (p = '5-LOW') AS median_price_low, NULL::DOUBLE AS median_price_closed
    FROM v GROUP BY month""")
def v14_wide(spark, d):
    return prices.wide_price_report(v14(spark, d), "month", "o_orderpriority", {"urgent": "1-URGENT", "low": "5-LOW", "closed": "none"})


@query("c23_rate_table", """
    WITH q AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, ['SEK', 'EUR', 'NOK', 'GBP', 'DKK'][o_orderkey % 5 + 1] AS c,
                      max(floor(o_totalprice / 1000)) FILTER (o_totalprice >= 1000) AS q FROM orders GROUP BY ALL),
    h AS (SELECT day, max(q) FILTER (c = 'SEK') AS home FROM q GROUP BY day)
    SELECT h.day, n.c AS currency, CASE n.c WHEN 'SEK' THEN 1.0::DOUBLE WHEN 'EUR' THEN coalesce(home, 11.5::DOUBLE) ELSE coalesce(home / q.q, n.f) END AS rate
    FROM h CROSS JOIN (SELECT unnest(['SEK', 'EUR', 'NOK', 'GBP', 'DKK', 'PLN']) AS c, unnest([1.0::DOUBLE, 11.5, 0.97, 13.0, 1.0, 1.0]) AS f) n
    LEFT JOIN q ON q.day = h.day AND q.c = n.c""")
def c23_rates(spark, d):
    """Daily quotes of five currencies; days without a quote take the defaults."""
    currency = F.element_at(F.array(*[F.lit(x) for x in ("SEK", "EUR", "NOK", "GBP", "DKK")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    quotes = table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), currency.alias("currency"), F.floor(F.col("o_totalprice") / 1000).cast("double").alias("quote"))
    return prices.rate_table(quotes, ["SEK", "EUR", "NOK", "GBP", "DKK", "PLN"], "SEK", "EUR", FALLBACK_RATES, ["day"])


@query("v11_trend_latest_state", f"""
    SELECT 'events' AS pipeline, 'default' AS sheet, series, last_day(day)::VARCHAR AS month, round(avg(value), 6) AS value
    FROM ({_STITCHED}) GROUP BY ALL""")
def v11_state(spark, d):
    monthly = to_month(stitch(trend_chunks(spark, d), ["series"], "chunk", "day", "value"), "day", "value", ["series"])
    wide = monthly.groupBy("month").pivot("series", ["click", "error", "purchase", "signup", "view"]).agg(F.max("value"))
    old = trend_rows(wide.withColumns({c: F.col(c) * 0 for c in wide.columns if c != "month"}), "events", fetched_at="2024-01-01 00:00:00")
    new = trend_rows(wide, "events", fetched_at="2024-02-01 00:00:00")
    return upsert_trend(old, new).select("pipeline", "sheet", "series", "month", F.round("value", 6).alias("value"))


# --- notices -------------------------------------------------------------------------------

def notice_payloads(spark, d):
    """One JSON notice per order, with the service's own field names; fields change between text, number, list and languages.

    The orders are one small file, so the documents are spread by their key, as many stored files would be, and each is
    built once.
    """
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    rows = joined.repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    key, total = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("can-standard", "cn-standard", "veat", "other")]), (key % 4 + 1).cast("int"))

    def said(*parts):
        return F.concat(F.lit('"'), *parts, F.lit('"'))

    def listed(*items):
        return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))

    def document(**members):
        named = [F.concat(F.lit('"' + name.replace("_", "-") + '":'), value) for name, value in members.items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}"))

    won = F.col("o_orderstatus") != "O"
    org = F.col("o_custkey").cast("string")
    doc = document(
        publication_number=F.when(key % 2 == 0, said(key.cast("string"))).otherwise(key.cast("string")),
        notice_type=said(kind), publication_date=said(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("+02:00")), procedure_type=listed(said(F.lit("open"))),
        notice_title=F.when(key % 3 == 0, document(swe=listed(said("o_orderpriority")))).when(key % 3 == 1, said("o_orderpriority")).otherwise(F.lit("null")),
        title_proc=F.when(key % 3 == 2, document(spa=said("o_orderpriority"), deu=said(F.lit("later")))),
        description_proc=document(eng=listed(said(F.repeat(F.lit("words "), 100)))),
        buyer_name=document(fra=listed(said(F.lit("City of "), F.col("c_nationkey").cast("string"))), bul=listed(said(F.lit("other")))),
        winner_name=F.when(won & (key % 2 == 0), document(eng=listed(said("c_mktsegment", F.lit(" AB")), said(F.lit("Partner Oy"))))).when(
            won, listed(said("c_mktsegment", F.lit(" AB")), said(F.lit("Partner Oy")))),
        winner_identifier=F.when(key % 2 == 0, listed(said(F.lit("x")), said(F.lit("55-"), org))).otherwise(said(F.lit("55 "), org)),
        estimated_value_lot=listed(said(F.lit("10")), said(F.lit("x")), F.lit("2.5")), estimated_value_cur_lot=said(F.lit("SEK")),
        tender_value=F.when(key % 2 == 0, listed(total, said(F.lit("1")))).when(key % 4 == 1, F.lit("[]")),
        tender_value_cur=F.when(key % 2 == 0, listed(said(F.lit("EUR")), said(F.lit("EUR")))),
        total_value=F.when(key % 4 == 1, total).otherwise(said(total)), total_value_cur=listed(said(F.lit("NOK"))))
    return rows.select(keep_if(doc, lambda x: x.isNotNull()).alias("payload"), (key % 7 == 0).alias("listed_active"), key.cast("string").alias("number"))


@query("v12_notice_shapes", """
    SELECT field, shape, count(*) AS notices FROM (
      SELECT 'publication-number' AS field, CASE WHEN o_orderkey % 2 = 0 THEN 'STRING' ELSE 'BIGINT' END AS shape FROM orders UNION ALL
      SELECT 'notice-title', CASE o_orderkey % 3 WHEN 0 THEN 'OBJECT' WHEN 1 THEN 'STRING' ELSE 'VOID' END FROM orders UNION ALL
      SELECT 'title-proc', CASE o_orderkey % 3 WHEN 2 THEN 'OBJECT' ELSE 'ABSENT' END FROM orders UNION ALL
      SELECT 'tender-value', CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 4 = 1 THEN 'ARRAY' ELSE 'ABSENT' END FROM orders) GROUP BY ALL""")
def v12_shapes(spark, d):
    return notices.notice_shapes(notice_payloads(spark, d), "payload", ["publication-number", "notice-title", "title-proc", "tender-value"])


@query("v12_procurement_notices", """
    SELECT o_orderkey::VARCHAR AS publication_number, 'Building GmbH' AS company,
           CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 4 = 1 THEN 'Active' ELSE 'Historical' END AS status,
           strftime(o_orderdate, '%Y-%m-%d') AS publication_date,
           CASE WHEN (o_orderstatus <> 'O' AND c_mktsegment = 'BUILDING') OR o_custkey = 77 THEN 'Yes' WHEN o_orderstatus <> 'O' THEN 'No' ELSE '' END AS won_by_company,
           CASE WHEN (o_orderstatus <> 'O' AND c_mktsegment = 'BUILDING') OR o_custkey = 77 THEN 'Winner' ELSE 'Mentioned' END AS role,
           CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS awarded_value, 'City of ' || c_nationkey AS buyer_name, 12.5::DOUBLE AS estimated_value,
           CASE WHEN o_orderstatus <> 'O' THEN c_mktsegment || ' AB, Partner Oy' ELSE '' END AS winner_name,
           ['Contract Award Notice','Contract Notice','Voluntary Ex-Ante Transparency Notice','other'][(o_orderkey % 4 + 1)::INT] AS notice_type,
           o_orderpriority AS title, substr(repeat('words ', 100), 1, 500) AS description, CASE WHEN o_orderkey % 2 = 0 THEN 'EUR, EUR' ELSE 'NOK' END AS awarded_currency,
           'SEK' AS estimated_currency, '' AS tenderers, 'Open' AS procedure_type, '2024-01-01 00:00:00' AS last_seen_at
    FROM orders JOIN customer ON c_custkey = o_custkey""")
def v12(spark, d):
    docs = notice_payloads(spark, d)
    active = docs.where("listed_active").select(F.col("number").alias("publication_number"))
    seen = F.lit("2024-01-01").cast("timestamp")
    fresh = notices.notice_rows(docs.select("payload"), "payload", active, F.lit("Building GmbH"), F.array(F.lit("5577")), seen)
    # The upsert reads the rows three times: they are stored instead of being parsed for each.
    folder = new_folder(spark)
    fresh.write.parquet(folder)
    fresh = spark.read.schema(fresh.schema).parquet(folder)
    # Latest state: an earlier, outdated load of the same notices is replaced.
    old = fresh.withColumn("status", F.lit("outdated"))
    return upsert(old, fresh.withColumn("ordinal", F.lit(1)), ["company", "publication_number"], "ordinal")


@query("v12_report_rows", """
    SELECT o_orderkey::VARCHAR AS publication_number FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderkey % 7 = 0 OR o_orderkey % 4 = 1 OR (o_orderstatus <> 'O' AND c_mktsegment = 'BUILDING') OR o_custkey = 77""")
def v12_report(spark, d):
    docs = notice_payloads(spark, d)
    active = docs.where("listed_active").select(F.col("number").alias("publication_number"))
    rows = notices.notice_rows(docs.select("payload"), "payload", active, F.lit("Building GmbH"), F.array(F.lit("5577")))
    return notices.report_rows(rows, F.lit(True)).select("publication_number")


@query("v13_lot_tenders", f"""
    SELECT 'Building GmbH' AS company, o_orderkey::VARCHAR AS publication_number, lot_id, tender_id, CASE lot_id WHEN 'LOT-1' THEN o_orderpriority ELSE 'second' END AS lot_title,
           CASE tender_id WHEN 'TEN-1' THEN o_custkey + 0.5::DOUBLE ELSE 9.25 END AS tender_value, 'SEK' AS currency,
           CASE WHEN tender_id = 'TEN-3' OR o_orderkey % 2 = 1 THEN 'Won' ELSE 'Lost' END AS result,
           CASE WHEN lot_id = 'LOT-1' AND o_orderkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS is_framework, 1::BIGINT AS winners_on_lot,
           CASE tender_id WHEN 'TEN-3' THEN o_orderpriority ELSE '' END AS contract_title, CASE lot_id WHEN 'LOT-1' THEN 2 ELSE 1 END::BIGINT AS num_tenders_on_lot,
           CASE WHEN lot_id = 'LOT-1' AND o_orderkey % 5 = 0 THEN o_orderkey % 100 END::DOUBLE AS fa_max_value,
           CASE WHEN lot_id = 'LOT-1' AND o_orderkey % 5 = 0 THEN 'EUR' ELSE '' END AS fa_max_currency,
           strftime(o_orderdate, '%Y-%m-%d') AS start_date, '2003-01-01' AS end_date, round_even((DATE '2003-01-01' - o_orderdate::DATE) / 365.25::DOUBLE, 1) AS duration_years,
           2::BIGINT AS total_lots, 1 + (o_orderkey % 2)::BIGINT AS lots_won, 1000.0::DOUBLE AS proc_estimated_value, 'NOK' AS proc_estimated_currency,
           o_totalprice AS total_awarded_value, 'SEK' AS total_awarded_currency, strftime(o_orderdate, '%Y-%m-%d') AS publication_date,
           'City of ' || c_nationkey AS buyer_name, o_orderpriority AS notice_title,
           ['Contract Award Notice','Contract Notice','Voluntary Ex-Ante Transparency Notice','other'][(o_orderkey % 4 + 1)::INT] AS notice_type
    FROM {_AWARDED} CROSS JOIN (SELECT unnest(['TEN-1', 'TEN-3']) AS tender_id, unnest(['LOT-1', 'LOT-2']) AS lot_id)
    WHERE c_mktsegment = 'BUILDING'""")
def v13(spark, d):
    docs = notice_payloads(spark, d)
    active = docs.where("listed_active").select(F.col("number").alias("publication_number"))
    company = F.lit("Building GmbH")
    parents = notices.notice_rows(docs.select("payload"), "payload", active, company, F.array(F.lit("5577")))
    parents = parents.withColumnRenamed("title", "notice_title")
    return notices.lot_tender_rows(notice_documents(spark, d), parents, company)


# --- ranks and brands ----------------------------------------------------------------------

@query("v15_listing_ranks", """
    WITH f AS (SELECT l_suppkey AS list, l_partkey AS item, min(l_linenumber * 100000000 + l_orderkey) AS place FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY place, item) AS rank FROM f)
    SELECT list, CASE WHEN p_name IN ('small ring', 'blue bolt') THEN 'small ring' ELSE 'red widget' END AS target, min(rank) AS rank
    FROM r JOIN part ON p_partkey = item WHERE p_name IN ('small ring', 'blue bolt', 'red widget', 'red gear') GROUP BY ALL""")
def v15(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("list"), F.col("l_linenumber").alias("page"), F.col("l_orderkey").alias("position"), F.col("l_partkey").alias("link"))
    titled = enrich(lines, table(spark, d, "part").select(F.col("p_partkey").alias("link"), F.concat(F.lit("New: "), "p_name").alias("title")), ["link"], "inner")
    return rankings.listing_ranks(titled, ["list"], "page", "position", "link", "title",
                                  {"small ring": ["blue bolt"], "red widget": ["red (gear)"]})


@query("v15_listing_ranks_in_runs", """
    WITH f AS (SELECT 1 + l_suppkey % 2 AS list, l_partkey AS item, min(l_linenumber * 100000000 + l_orderkey) AS place FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY place, item) AS rank FROM f)
    SELECT list, CASE WHEN p_name LIKE '%ring%' THEN 'ring' ELSE 'bolt' END AS target, min(rank) AS rank
    FROM r JOIN part ON p_partkey = item WHERE p_name LIKE '%ring%' OR p_name LIKE '%bolt%' GROUP BY ALL""")
def v15_runs(spark, d):
    """Two long lists, numbered in runs of 500 positions; titles join after repeated links are gone."""
    lines = table(spark, d, "lineitem").select(
        (1 + F.col("l_suppkey") % 2).alias("list"), F.col("l_linenumber").alias("page"), F.col("l_orderkey").alias("position"), F.col("l_partkey").alias("link"))
    titles = table(spark, d, "part").select(F.col("p_partkey").alias("link"), F.col("p_name").alias("title"))
    return rankings.listing_ranks(lines, ["list"], "page", "position", "link", "title", {"ring": [], "bolt": []}, span=500, titles=titles)


@query("v15_marketplace_rows", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN l_quantity * 1000 WHEN 1 THEN l_quantity ELSE 0 END::BIGINT AS bought_past_month,
           CASE WHEN l_suppkey > 0 THEN least(l_suppkey, l_partkey + 1) ELSE l_partkey + 1 END AS best_sellers_rank FROM lineitem""")
def v15_rows(spark, d):
    q, third = F.col("l_quantity").cast("bigint"), F.col("l_linenumber") % 3
    badge = F.when(third == 0, F.concat(q, F.lit("K+ bought in past month"))).otherwise("")
    html = F.when(third == 1, F.concat(F.lit("<span>"), q, F.lit("+ bought</span>"))).otherwise("<span>none</span>")
    text = F.concat(F.lit("#"), "l_suppkey", F.lit(" in Chairs (See Top 100), Nr. "), F.col("l_partkey") + 1, F.lit(" in Office"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", badge.alias("badge"), html.alias("html"), text.alias("text"))
    return rankings.marketplace_rows(rows, ["l_orderkey", "l_linenumber"], "badge", "html", "text")


@query("v16_new_brand_log", r"""
    WITH l AS (SELECT DISTINCT split_part(url, ':', 1) AS scheme, url_decode(replace(unnest(regexp_extract_all(html, 'href="/([^"&\s]+)', 1)), '+', ' ')) AS brand FROM pages)
    SELECT brand, trim(regexp_replace(lower(brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM (
        SELECT DISTINCT brand FROM l WHERE scheme = 'https' EXCEPT SELECT brand FROM l WHERE scheme = 'http')""")
def v16(spark, d):
    pages = table(spark, d, "pages").withColumn("scheme", F.split("url", ":")[0])
    brands = rankings.brand_rows(pages, "html", 'href="/', ["scheme"])
    log = rankings.new_brand_log(brands.where("scheme = 'https'"), brands.where("scheme = 'http'"))
    return log.select("brand", "slug")


@query("v16_first_run_only_seeds", "SELECT doc_id AS brands FROM documents WHERE false UNION ALL SELECT 0")
def v16_seed(spark, d):
    brands = rankings.brand_rows(table(spark, d, "pages"), "html", 'href="/')
    return rankings.new_brand_log(brands, brands.where("brand is null")).agg(F.count(F.lit(1)).alias("brands"))


@query("v16_brand_log", r"""
    WITH b AS (SELECT p_name || ' ' || p_size AS brand, replace(p_name, ' ', '-') || '-' || p_size AS slug, p_partkey % 2 = 0 AS is_old, p_size % 3 <> 0 AS has_page,
                      replace(p_name, ' ', '-') || '-' || p_size AS page, 'home-' || lower(p_type) AS category FROM part),
    c AS (SELECT page, string_agg(list_aggregate(list_transform(string_split(category, '-'), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' '), ', ' ORDER BY category) AS categories
          FROM (SELECT DISTINCT page, category FROM b) GROUP BY page)
    SELECT 'brand' AS kind, n.brand, n.slug, CASE WHEN n.slug IN (SELECT slug FROM b WHERE has_page) THEN coalesce(c.categories, '') ELSE '' END AS categories
    FROM (SELECT DISTINCT brand, slug FROM b WHERE brand NOT IN (SELECT brand FROM b WHERE is_old)) n LEFT JOIN c ON c.page = n.slug
    UNION ALL SELECT DISTINCT 'page', NULL, slug, '' FROM b WHERE has_page AND slug NOT IN (SELECT slug FROM b WHERE is_old AND has_page)""")
def v16_log(spark, d):
    """Brands linked from one page per part; those of a third of the sizes have no page of their own."""
    name, plain = F.concat("p_name", F.lit(" "), "p_size"), F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), "p_size")
    kind = F.concat(F.lit("home-"), F.lower("p_type"))
    html = F.concat(
        F.lit('<a href="/search?brand='), F.replace(name, F.lit(" "), F.lit("+")), F.lit('"><a href="/brands/'),
        F.when(F.col("p_size") % 3 != 0, plain).otherwise(""), F.lit('.html">'))
    own = F.concat(F.lit('<a href="/brands/'), plain, F.lit("/"), kind, F.lit('.html"><a href="/brands/other/lamps.html">'))
    pages = table(spark, d, "part").select((F.col("p_partkey") % 2 == 0).alias("is_old"), plain.alias("slug"), html.alias("html"), own.alias("own"))
    brands = rankings.brand_rows(pages, "html", r"search\?brand=", ["is_old"])
    featured = rankings.featured_slugs(pages, "html", "/brands/", ["is_old"])
    categories = rankings.brand_categories(pages, "slug", "own", "/brands/")
    log = rankings.brand_log(brands, brands.where("is_old").select("brand"), featured, featured.where("is_old").select("slug"), categories)
    return log.withColumn("categories", F.array_join("categories", ", "))

"""Check queries: deltas, date pairs, stock views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.deltas import (
    date_calendar, date_pair_delta, flow_totals, hours_since_previous, previous_row, series_change, snapshot_delta,
)
from tidemark.plans import stock as plans
from tidemark.workload import bindings as b
from tidemark.workload.registry import query, table

_LAGGED = f"""
    SELECT *, lag(quantity) OVER w AS prev_value, lag(snapshot_date) OVER w AS prev_date
    FROM ({b.STORE_SNAPSHOT}) WINDOW w AS (PARTITION BY store, variant_id ORDER BY snapshot_date)"""

_ADJACENT = f"""
    SELECT c.*, p.quantity AS prev_value, p.snapshot_date AS prev_date
    FROM ({b.STORE_SNAPSHOT}) c
    JOIN (SELECT d, lag(d) OVER (ORDER BY d) AS before FROM (SELECT DISTINCT ts::DATE AS d FROM events)) k
      ON k.d = c.snapshot_date
    LEFT JOIN ({b.STORE_SNAPSHOT}) p
      ON p.snapshot_date = k.before AND p.store = c.store AND p.variant_id = c.variant_id"""


@query("v1_brand_stock", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, p_brand AS brand, sum(quantity)::BIGINT AS total_quantity
    FROM ({b.BRAND_STOCK_FACTS}) JOIN part ON p_partkey = article GROUP BY ALL""")
def v1(spark, d):
    return plans.brand_stock(b.brand_stock_facts(spark, d), b.part_articles(spark, d))


_PAIRS = f"""
    WITH s AS ({b.STOCK_SNAPSHOT}),
    k AS (SELECT d, lag(d) OVER (ORDER BY d) AS before FROM (SELECT DISTINCT snapshot_date AS d FROM s)),
    grid AS (SELECT k.d, k.before, e.article, e.warehouse_id
             FROM k, (SELECT DISTINCT article, warehouse_id FROM s) e WHERE k.before IS NOT NULL),
    pairs AS (
        SELECT g.d AS snapshot_date, g.article, g.warehouse_id, coalesce(p.quantity, 0)::BIGINT AS prev,
               coalesce(c.quantity, 0)::BIGINT AS curr
        FROM grid g
        LEFT JOIN s c ON c.snapshot_date = g.d AND c.article = g.article AND c.warehouse_id = g.warehouse_id
        LEFT JOIN s p ON p.snapshot_date = g.before AND p.article = g.article AND p.warehouse_id = g.warehouse_id
        WHERE c.article IS NOT NULL OR p.article IS NOT NULL)"""

_FLOWS = f"""{_PAIRS}
    SELECT snapshot_date::VARCHAR AS snapshot_date, coalesce(category, 'Övrigt') AS category,
           sum(CASE WHEN curr < prev THEN prev - curr ELSE 0 END)::BIGINT AS sales_out,
           sum(CASE WHEN curr > prev THEN curr - prev ELSE 0 END)::BIGINT AS sales_in
    FROM pairs LEFT JOIN ({b.ARTICLES}) USING (article) GROUP BY ALL"""


@query("v2_category_flows", _FLOWS)
def v2(spark, d):
    return plans.category_flows(b.stock_snapshot(spark, d), b.articles(spark, d))


@query("v2_category_flows_full_outer", _FLOWS)
def v2_full(spark, d):
    return plans.category_flows(b.stock_snapshot(spark, d), b.articles(spark, d), form="full_outer")


@query("v2_category_flows_dense", f"""
    WITH flows AS ({_FLOWS})
    SELECT k.snapshot_date, m.category, coalesce(sales_out, 0)::BIGINT AS sales_out, coalesce(sales_in, 0)::BIGINT AS sales_in
    FROM (SELECT DISTINCT snapshot_date FROM flows) k
    CROSS JOIN (SELECT unnest(['Dimmer','Armaturer','Termostat','LED-Panel','Övrigt']) AS category) m
    LEFT JOIN flows USING (snapshot_date, category)""")
def v2_dense(spark, d):
    members = ["Dimmer", "Armaturer", "Termostat", "LED-Panel", "Övrigt"]
    return plans.category_flows(b.stock_snapshot(spark, d), b.articles(spark, d), members=members)


@query("j3_date_pair_delta", f"""{_PAIRS}
    SELECT snapshot_date::VARCHAR AS snapshot_date, article, warehouse_id, prev, curr, curr - prev AS delta FROM pairs""")
def j3(spark, d):
    return date_pair_delta(b.stock_snapshot(spark, d), ["article", "warehouse_id"], "snapshot_date", "quantity")


@query("j4_current_and_previous_rows", f"""{_PAIRS}
    SELECT snapshot_date::VARCHAR AS snapshot_date, sum(prev)::BIGINT AS prev, sum(curr)::BIGINT AS curr
    FROM pairs GROUP BY ALL""")
def j4(spark, d):
    moved = date_pair_delta(
        b.stock_snapshot(spark, d), ["article", "warehouse_id"], "snapshot_date", "quantity", "full_outer")
    return moved.groupBy("snapshot_date").agg(F.sum("prev").alias("prev"), F.sum("curr").alias("curr"))


@query("a2_flow_totals", f"""{_PAIRS}
    SELECT snapshot_date::VARCHAR AS snapshot_date, warehouse_id,
           sum(greatest(prev - curr, 0))::BIGINT AS outflow, sum(greatest(curr - prev, 0))::BIGINT AS inflow
    FROM pairs GROUP BY ALL""")
def a2(spark, d):
    moved = date_pair_delta(b.stock_snapshot(spark, d), ["article", "warehouse_id"], "snapshot_date", "quantity")
    return flow_totals(moved, ["snapshot_date", "warehouse_id"])


@query("v3_store_daily_sales", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, store,
           sum(CASE WHEN snapshot_date - prev_date <= 1 AND prev_value > quantity THEN prev_value - quantity ELSE 0 END)::BIGINT
               AS est_sold_units,
           sum(CASE WHEN snapshot_date - prev_date <= 1 AND prev_value > quantity
                    THEN (prev_value - quantity) * price ELSE 0 END)::DOUBLE AS est_sold_revenue
    FROM ({_LAGGED}) WHERE prev_value IS NOT NULL GROUP BY ALL""")
def v3(spark, d):
    return plans.store_daily_sales(b.store_snapshot(spark, d))


@query("w1_guarded_delta", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, store, variant_id, quantity, price::DOUBLE AS price,
           (prev_date IS NULL)::BIGINT AS is_first, prev_date::VARCHAR AS prev_date, prev_value::DOUBLE AS prev_value,
           (CASE WHEN snapshot_date - prev_date <= 1 THEN quantity - prev_value END)::DOUBLE AS delta,
           CASE WHEN snapshot_date - prev_date <= 1 AND prev_value > quantity THEN prev_value - quantity ELSE 0 END AS sold
    FROM ({_LAGGED})""")
def w1(spark, d):
    moved = snapshot_delta(b.store_snapshot(spark, d), ["store", "variant_id"], "snapshot_date", "quantity")
    return moved.withColumns({"prev_value": F.col("prev_value").cast("double"), "delta": F.col("delta").cast("double")})


@query("w1_guarded_delta_segmented", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, store, variant_id,
           CASE WHEN snapshot_date - prev_date <= 1 AND prev_value > quantity THEN prev_value - quantity ELSE 0 END AS sold
    FROM ({_LAGGED})""")
def w1_segmented(spark, d):
    week = F.floor(F.datediff("snapshot_date", F.lit("1970-01-01").cast("date")) / 7)
    moved = snapshot_delta(
        b.store_snapshot(spark, d), ["store", "variant_id"], "snapshot_date", "quantity", segment=week)
    return moved.select("snapshot_date", "store", "variant_id", "sold")


_METRICS = """
    SELECT snapshot_date::VARCHAR AS snapshot_date, store, count(*) AS variants_seen,
           count(prev_date) AS matched_prev, count(*) FILTER (prev_date IS NULL) AS new_variants,
           count(*) FILTER (quantity > prev_value) AS restock_events,
           sum(CASE WHEN quantity > prev_value THEN quantity - prev_value ELSE 0 END)::BIGINT AS restock_units,
           count(*) FILTER (quantity = prev_value) AS no_change_events,
           sum(CASE WHEN quantity < prev_value AND variant_id % 10 <> 0 THEN prev_value - quantity ELSE 0 END)::BIGINT AS sold_units,
           sum(CASE WHEN quantity < prev_value AND variant_id % 10 = 0 THEN prev_value - quantity ELSE 0 END)::BIGINT
               AS sold_units_missing_price,
           sum(CASE WHEN quantity < prev_value AND variant_id % 10 <> 0 THEN (prev_value - quantity) * price ELSE 0 END)::DOUBLE
               AS revenue
    FROM ({rows}) GROUP BY ALL"""


def _some_unpriced(spark, d):
    return b.store_snapshot(spark, d).withColumn("price", F.when(F.col("variant_id") % 10 != 0, F.col("price")))


@query("w1u_delta_metrics_remember", _METRICS.format(rows=_LAGGED))
def w1u(spark, d):
    return plans.delta_metrics(
        _some_unpriced(spark, d), ["store", "variant_id"], "snapshot_date", "quantity", "price", ["store"], remember=True)


@query("w1u_delta_metrics_forget", _METRICS.format(rows=_ADJACENT))
def w1u_forget(spark, d):
    return plans.delta_metrics(
        _some_unpriced(spark, d), ["store", "variant_id"], "snapshot_date", "quantity", "price", ["store"])


@query("w1t_three_way", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, kind, count(*) AS n, sum(sold)::BIGINT AS sold FROM (
        SELECT snapshot_date,
               CASE WHEN prev_value IS NULL THEN 'first' WHEN quantity - prev_value >= 10 THEN 'restock'
                    WHEN quantity > prev_value THEN 'return' ELSE 'sale' END AS kind,
               CASE WHEN prev_value IS NULL OR quantity - prev_value >= 10 THEN 0 ELSE prev_value - quantity END AS sold
        FROM ({_ADJACENT})) GROUP BY ALL""")
def w1t(spark, d):
    moved = snapshot_delta(b.store_snapshot(spark, d), ["store", "variant_id"], "snapshot_date", "quantity",
                           max_gap_days=None, mode="three_way", adjacent=True)
    return moved.groupBy("snapshot_date", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("sold").alias("sold"))


@query("w1c_counter_growth", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, channel,
           sum(greatest(0, count - coalesce(before, 0)))::BIGINT AS growth
    FROM (SELECT *, lag(count) OVER (PARTITION BY channel, product ORDER BY snapshot_date) AS before
          FROM ({b.REVIEW_COUNTS})) GROUP BY ALL""")
def w1c(spark, d):
    moved = snapshot_delta(b.review_counts(spark, d), ["channel", "product"], "snapshot_date", "count",
                           max_gap_days=None, mode="growth", first_as_zero=True)
    return moved.groupBy("snapshot_date", "channel").agg(F.sum("growth").alias("growth"))


@query("w2_date_calendar", """
    SELECT d::VARCHAR AS order_day, lag(d) OVER (ORDER BY d)::VARCHAR AS prev_date, lead(d) OVER (ORDER BY d)::VARCHAR AS next_date
    FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)""")
def w2(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("order_day"))
    return date_calendar(days, "order_day")


@query("w3_hours_since_previous", f"""
    SELECT day::VARCHAR AS day, first_at::VARCHAR AS first_at, round(
        (epoch_us(first_at) - lag(epoch_us(first_at)) OVER (ORDER BY first_at)) / 3.6e9, 6) AS hours
    FROM (SELECT day, date_trunc('second', min(captured_at)) AS first_at FROM ({b.VARIANT_CAPTURES}) GROUP BY day)""")
def w3(spark, d):
    daily = b.variant_captures(spark, d).groupBy("day").agg(F.date_trunc("second", F.min("captured_at")).alias("first_at"))
    return hours_since_previous(daily, "first_at").select(
        "day", F.date_format("first_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"),
        F.round("hours_since_prev_snapshot", 6).alias("hours"))


@query("w6_series_change", """
    SELECT d::VARCHAR AS day, n, (n - lag(n) OVER (ORDER BY d))::DOUBLE AS change
    FROM (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY ALL)""")
def w6(spark, d):
    daily = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return series_change(daily, "day", "n").withColumn("change", F.col("change").cast("double"))


@query("w6_raw_event_change", """
    SELECT event_type, count(*) AS n,
           round(sum(value::DECIMAL(18,4) - before::DECIMAL(18,4))::DOUBLE, 4) AS net_change,
           count(*) FILTER (value > before) AS rises
    FROM (SELECT event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS before FROM events)
    GROUP BY ALL""")
def w6_raw(spark, d):
    """A few very long histories: every event type holds a large part of all rows, so they are cut by day."""
    events = table(spark, d, "events").select(
        "event_type", "event_id", F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,4)").alias("value"))
    linked = previous_row(events, ["event_type"], "event_id", {"before": "value"}, segment=F.col("day"))
    return linked.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value") - F.col("before")), 4).alias("net_change"),
        F.count_if(F.col("value") > F.col("before")).alias("rises"))


@query("v4_availability_daily_sales", f"""
    WITH l AS (SELECT *, lag(available) OVER w AS prev_available, lag(day) OVER w AS prev_day
               FROM ({b.VARIANT_CAPTURES}) WINDOW w AS (PARTITION BY product_id ORDER BY captured_at)),
    m AS (SELECT *, CASE WHEN price IS NOT NULL AND day - prev_day <= 1 AND available < prev_available
                         THEN prev_available - available ELSE 0 END AS units FROM l),
    t AS (SELECT day, min(captured_at) AS first_at, sum(units)::BIGINT AS units_sold,
                 sum(units * coalesce(price, 0)) AS revenue,
                 count(*) FILTER (prev_available IS NULL) AS new_variants FROM m GROUP BY day)
    SELECT day::VARCHAR AS day, units_sold, revenue::DOUBLE AS revenue,
           CASE WHEN units_sold > 0 THEN round(revenue::DOUBLE / units_sold, 2) END AS aov,
           round((epoch_us(first_at) - lag(epoch_us(first_at)) OVER (ORDER BY first_at)) / 3.6e9, 6)
               AS hours_since_prev_snapshot, new_variants
    FROM t""")
def v4(spark, d):
    daily = plans.availability_daily_sales(b.variant_captures(spark, d))
    return daily.withColumn("hours_since_prev_snapshot", F.round("hours_since_prev_snapshot", 6))


@query("a22_sum_over_locations", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, article, sum(quantity)::BIGINT AS quantity
    FROM ({b.STOCK_SNAPSHOT}) GROUP BY ALL""")
def a22(spark, d):
    return b.stock_snapshot(spark, d).groupBy("snapshot_date", "article").agg(F.sum("quantity").alias("quantity"))


@query("a4_first_capture_of_local_day", """
    SELECT (ts + INTERVAL 1 HOUR)::DATE::VARCHAR AS day, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_at, count(*) AS n
    FROM events GROUP BY 1""")
def a4(spark, d):
    from tidemark.functions.dates import local_day

    events = table(spark, d, "events")
    return events.groupBy(local_day(events, "ts").alias("day")).agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("first_at"), F.count(F.lit(1)).alias("n"))

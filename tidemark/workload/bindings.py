"""The provided tables read as snapshot facts, in Spark and as SQL table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import local_day
from tidemark.operators.picks import first_by
from tidemark.workload.registry import table

# Category of an article; the last residue has none.
ARTICLE_CATEGORIES = {0: "Dimmer", 1: "Armaturer", 2: "Termostat", 3: "LED-Panel"}


def store_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day, store (event type) and variant (user): the day's last value is the stock."""
    return table(spark, folder, "events").groupBy(
        F.to_date("ts").alias("snapshot_date"), F.col("event_type").alias("store"), F.col("user_id").alias("variant_id")
    ).agg(F.max_by("value", "event_id").cast("bigint").alias("quantity")).withColumn(
        "price", (10 + F.col("variant_id") % 7).cast("decimal(10,2)")
    )


STORE_SNAPSHOT = """
    SELECT ts::DATE AS snapshot_date, event_type AS store, user_id AS variant_id,
           trunc(arg_max(value, event_id))::BIGINT AS quantity, (10 + user_id % 7)::DECIMAL(10,2) AS price
    FROM events GROUP BY ALL"""


def stock_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The same facts as stock per article (user) and warehouse (event type)."""
    return store_snapshot(spark, folder).select(
        "snapshot_date", F.col("variant_id").alias("article"), F.col("store").alias("warehouse_id"), "quantity"
    )


STOCK_SNAPSHOT = f"""
    SELECT snapshot_date, variant_id AS article, store AS warehouse_id, quantity FROM ({STORE_SNAPSHOT})"""


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Article dimension; every fifth article has no category row."""
    label = F.element_at(F.create_map(*[F.lit(x) for kv in ARTICLE_CATEGORIES.items() for x in kv]),
                         (F.col("article") % 5).cast("int"))
    ids = table(spark, folder, "events").select(F.col("user_id").alias("article")).distinct()
    return ids.where(F.col("article") % 5 < 4).withColumn("category", label)


ARTICLES = """
    SELECT DISTINCT user_id AS article,
           CASE user_id % 5 WHEN 0 THEN 'Dimmer' WHEN 1 THEN 'Armaturer' WHEN 2 THEN 'Termostat' ELSE 'LED-Panel' END
           AS category
    FROM events WHERE user_id % 5 < 4"""


def variant_captures(spark: SparkSession, folder: str) -> DataFrame:
    """First event of a user on a local day as a timestamped capture; every tenth price is unknown."""
    events = table(spark, folder, "events")
    events = events.withColumn("day", local_day(events, "ts"))
    rows = first_by(events.select("user_id", "day", "event_id", "ts", "value"), ["user_id", "day"], "event_id")
    return rows.select(
        F.col("ts").alias("captured_at"), F.col("user_id").alias("product_id"), F.col("value").cast("bigint").alias("available"),
        F.when(F.col("event_id") % 10 != 0, (10 + F.col("user_id") % 7).cast("decimal(10,2)")).alias("price"), "day",
    )


VARIANT_CAPTURES = """
    SELECT arg_min(ts, event_id) AS captured_at, user_id AS product_id,
           trunc(arg_min(value, event_id))::BIGINT AS available,
           CASE WHEN min(event_id) % 10 <> 0 THEN (10 + user_id % 7)::DECIMAL(10,2) END AS price,
           ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm')::DATE AS day
    FROM events GROUP BY user_id, ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm')::DATE"""


def brand_stock_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Units shipped per month and part, as a monthly stock fact."""
    return table(spark, folder, "lineitem").groupBy(
        F.trunc("l_shipdate", "month").alias("snapshot_date"), F.col("l_partkey").alias("article")
    ).agg(F.sum("l_quantity").cast("bigint").alias("quantity"))


BRAND_STOCK_FACTS = """
    SELECT date_trunc('month', l_shipdate)::DATE AS snapshot_date, l_partkey AS article,
           sum(l_quantity)::BIGINT AS quantity
    FROM lineitem GROUP BY ALL"""


def part_articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("article"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand")
    )


MARKETS = ["DE", "SE", "NO", "UK", "COM"]


def counter_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Counters per variant key ``<part>_<size>-<line>`` and market (supplier modulo 5).

    ``ordinal`` is the listing order; some prices are 0 so that the representative is not always first.
    """
    lines = table(spark, folder, "lineitem")
    market = F.element_at(F.array(*[F.lit(m) for m in MARKETS]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    sell = F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.col("l_partkey") % 400 + 20.0)
    return lines.select(
        market.alias("market"),
        F.concat_ws("", F.col("l_partkey"), F.lit("_1-"), F.col("l_linenumber")).alias("key"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ordinal"),
        F.col("l_quantity").cast("bigint").alias("sale_last_week"),
        (F.col("l_quantity") / 10).cast("bigint").alias("sale_last_days"),
        sell.alias("sell_price"),
        (F.col("l_partkey") % 400 + 30.0).alias("list_price"),
        F.concat(F.lit("part "), F.col("l_partkey")).alias("title"),
        F.concat(F.lit("cat"), F.col("l_partkey") % 12).alias("category"),
    )


COUNTER_SNAPSHOT = """
    SELECT ['DE','SE','NO','UK','COM'][(l_suppkey % 5 + 1)::INT] AS market,
           l_partkey || '_1-' || l_linenumber AS key,
           l_orderkey * 8 + l_linenumber AS ordinal,
           l_quantity::BIGINT AS sale_last_week, trunc(l_quantity / 10)::BIGINT AS sale_last_days,
           CASE WHEN l_linenumber = 1 THEN 0.0::DOUBLE ELSE l_partkey % 400 + 20.0::DOUBLE END AS sell_price,
           l_partkey % 400 + 30.0::DOUBLE AS list_price, 'part ' || l_partkey AS title,
           'cat' || (l_partkey % 12) AS category
    FROM lineitem"""


def rates(spark: SparkSession, folder: str) -> DataFrame:
    """Exchange rates to the home currency, one per currency seen in the nation table."""
    ccy = F.element_at(F.array(*[F.lit(c) for c in ("SEK", "EUR", "NOK", "GBP", "DKK")]), F.col("n_regionkey") + 1)
    value = F.element_at(F.array(*[F.lit(v) for v in (1.0, 11.5, 0.97, 13.0, 1.5)]), F.col("n_regionkey") + 1)
    return table(spark, folder, "nation").select(ccy.alias("currency"), value.alias("rate")).distinct()


RATES = """
    SELECT DISTINCT ['SEK','EUR','NOK','GBP','DKK'][n_regionkey + 1] AS currency,
           [1.0::DOUBLE, 11.5, 0.97, 13.0, 1.5][n_regionkey + 1] AS rate FROM nation"""


def review_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Cumulative review counts per day, product (user) and channel (event type)."""
    daily = table(spark, folder, "events").groupBy(
        F.to_date("ts").alias("snapshot_date"), F.col("event_type").alias("channel"), F.col("user_id").alias("product")
    ).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    # One row per day and key: the running window is no longer than the calendar.
    running = Window.partitionBy("channel", "product").orderBy("snapshot_date")
    return daily.select("snapshot_date", "channel", "product", F.sum("n").over(running).alias("count"))


REVIEW_COUNTS = """
    SELECT snapshot_date, channel, product, (sum(n) OVER (PARTITION BY channel, product ORDER BY snapshot_date))::BIGINT
           AS count
    FROM (SELECT ts::DATE AS snapshot_date, event_type AS channel, user_id AS product, count(*) AS n
          FROM events GROUP BY ALL)"""

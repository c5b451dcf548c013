"""Stock and sales views over full snapshot history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import UNMAPPED_CATEGORY
from tidemark.functions.numbers import ratio
from tidemark.operators.deltas import date_pair_delta, flow_totals, hours_since_previous, snapshot_delta
from tidemark.operators.joins import enrich
from tidemark.operators.reshape import densify


def brand_stock(stock: DataFrame, article: DataFrame) -> DataFrame:
    """Stock per day and brand; articles without a brand row are left out."""
    joined = enrich(stock, article.select("article", "brand"), ["article"], "inner")
    return joined.groupBy("snapshot_date", "brand").agg(F.sum("quantity").alias("total_quantity"))


def category_flows(
    stock: DataFrame, article: DataFrame, form: str = "union_sum", members: Sequence[str] | None = None
) -> DataFrame:
    """Units out and in per day and category; gaps between captures are spanned.

    ``members`` lists categories to show on every date, with 0 where nothing moved.
    """
    moved = date_pair_delta(stock, ["article", "warehouse_id"], "snapshot_date", "quantity", form)
    labelled = enrich(moved, article.select("article", "category"), ["article"], "left", {"category": UNMAPPED_CATEGORY})
    totals = flow_totals(labelled, ["snapshot_date", "category"]).select(
        "snapshot_date", "category", F.col("outflow").alias("sales_out"), F.col("inflow").alias("sales_in")
    )
    if members is None:
        return totals
    return densify(totals, "snapshot_date", "category", members, ["sales_out", "sales_in"])


def store_daily_sales(snapshot: DataFrame, max_gap_days: int = 1) -> DataFrame:
    """Estimated units and revenue per day and store; only one-day steps count."""
    moved = snapshot_delta(
        snapshot, ["store", "variant_id"], "snapshot_date", "quantity", "price", max_gap_days, mode="sold"
    )
    return moved.where(F.col("prev_value").isNotNull()).groupBy("snapshot_date", "store").agg(
        F.sum("sold").cast("bigint").alias("est_sold_units"), F.round(F.sum("revenue"), 2).alias("est_sold_revenue")
    )


def availability_daily_sales(captures: DataFrame, max_gap_days: int = 1) -> DataFrame:
    """Units, revenue, order value, hours between captures and new variants per local day.

    Drops without a price count nothing. Days come from the captures, so each has its row; the hours
    are taken between the days' first captures, over one row per day.
    """
    moved = snapshot_delta(
        captures, ["product_id"], "day", "available", "price", max_gap_days, mode="metrics", order="captured_at"
    )
    daily = moved.groupBy("day").agg(
        F.min("captured_at").alias("day_captured_at"), F.sum("sold").cast("bigint").alias("units_sold"),
        F.sum("revenue").alias("revenue"), F.count_if(F.col("prev_value").isNull()).alias("new_variants"),
    )
    return hours_since_previous(daily, "day_captured_at").select(
        "day", "units_sold", F.round("revenue", 2).alias("revenue"),
        F.when(F.col("units_sold") > 0, ratio(F.col("revenue"), F.col("units_sold"), 2)).alias("aov"),
        "hours_since_prev_snapshot", "new_variants",
    )


def delta_metrics(snapshot: DataFrame, keys: Sequence[str], date: str, measure: str, price: str,
                  by: Sequence[str] = (), remember: bool = False) -> DataFrame:
    """Run metrics per day: seen, matched, new, restocks, unchanged, sold, sold without price."""
    moved = snapshot_delta(snapshot, keys, date, measure, price, None, mode="metrics", adjacent=not remember)
    return moved.groupBy(date, *by).agg(
        F.count(F.lit(1)).alias("variants_seen"), F.count_if("is_matched").alias("matched_prev"),
        F.count_if("is_first").alias("new_variants"), F.count_if("is_restock").alias("restock_events"),
        F.sum("restock_units").alias("restock_units"), F.count_if("is_unchanged").alias("no_change_events"),
        F.sum("sold").alias("sold_units"), F.sum("sold_without_price").alias("sold_units_missing_price"),
        F.sum("revenue").alias("revenue"),
    )

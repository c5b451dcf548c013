"""Catalog snapshots: daily site summary, counter revenue per product colour, category estimates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import FALLBACK_RATES
from tidemark.functions.numbers import discount_pct
from tidemark.functions.text import base_key, two_level_path
from tidemark.operators.aggregates import collect_events, discount_of_totals, rollups, weighted_revenue
from tidemark.operators.deltas import snapshot_delta
from tidemark.operators.joins import enrich, presence_flags

EVENT_FIELDS = ["product_key", "site", "brand", "title", "category", "size", "stock_before", "stock_after", "delta", "sell_price"]


def classified(snapshot: DataFrame, threshold: int = 10) -> DataFrame:
    """Each variant's step since the captured day before, with revenue at sell and list price.

    A key the day before lacks has no step: the state of a run holds that run's keys only.
    """
    moved = snapshot_delta(
        snapshot, ["site", "product_key"], "snapshot_date", "stock", max_gap_days=None, mode="three_way",
        threshold=threshold, adjacent=True,
    )
    return moved.withColumns({
        "sell_rev": F.col("sold") * F.col("sell_price"), "list_rev": F.col("sold") * F.col("list_price"),
        "category_group": two_level_path(F.col("category")),
    })


def site_daily_summary(snapshot: DataFrame, threshold: int = 10) -> DataFrame:
    """Per day: the total and the rollups by site, two-level category and brand, in one pass.

    ``restocks`` and ``returns`` count events; ``est_sold_units`` nets returns.
    """
    measures = [
        F.count(F.lit(1)).alias("total_products"), F.sum("sold").alias("est_sold_units"),
        F.sum("sell_rev").alias("sell_rev"), F.sum("list_rev").alias("list_rev"),
        F.count_if(F.col("kind") == "restock").alias("restocks"), F.count_if(F.col("kind") == "return").alias("returns"),
    ]
    return rollups(classified(snapshot, threshold), "snapshot_date", ["site", "category_group", "brand"], measures)


def daily_row(snapshot: DataFrame, threshold: int = 10) -> DataFrame:
    """One row per day: the totals, and maps from site, two-level category and brand to the same measures.

    The maps hold the members of the dimensions, never products; ``to_json`` at the sink makes documents of them.
    """
    rows = site_daily_summary(snapshot, threshold)
    measures = [c for c in rows.columns if c not in ("snapshot_date", "dimension", "member")]
    named = F.coalesce("member", F.lit("Other"))

    def by(dimension: str) -> Column:
        entry = F.struct(named.alias("key"), F.struct(*measures).alias("value"))
        return F.map_from_entries(F.collect_list(F.when(F.col("dimension") == dimension, entry)))

    return rows.groupBy("snapshot_date").agg(
        F.max(F.when(F.col("dimension") == "total", F.struct(*measures))).alias("__t"),
        by("site").alias("by_site"), by("category_group").alias("by_category"), by("brand").alias("by_brand"),
    ).select("snapshot_date", "__t.*", "by_site", "by_category", "by_brand")


def detail_rows(snapshot: DataFrame, sites: Sequence[str], threshold: int = 10) -> DataFrame:
    """Every listing of a day with its step, on which sites the product is listed that day, and on how many."""
    step = classified(snapshot, threshold)
    flags = presence_flags(snapshot, ["snapshot_date", "product_key"], "site", sites)
    return step.join(flags, ["snapshot_date", "product_key"], "left")


def daily_events(snapshot: DataFrame, kind: str, threshold: int = 10) -> DataFrame:
    """Restock or return events per day as packed records; large days take several records."""
    named = classified(snapshot, threshold).withColumns({"stock_before": F.col("prev_value"), "stock_after": F.col("stock")})
    return collect_events(named, ["snapshot_date"], F.col("kind") == kind, EVENT_FIELDS, f"{kind}_events")


def product_colours(
    variants: DataFrame, rates: DataFrame, currencies: Mapping[str, str], priority: Sequence[str],
    cut: str = "first", by: Sequence[str] = (), home: str = "EUR", rounded: bool = True,
) -> DataFrame:
    """One row per base key from the first listing market, with converted prices.

    Counters are global, so the greatest over the sizes counts; the representative is the first
    listed size with a positive price. Everything is one aggregation per base key: the market's place
    leads each composite order, so rows of later markets never win.
    """
    place = F.array_position(F.array(*[F.lit(m) for m in priority]), F.col("market"))
    keyed = variants.where(F.col("market").isin(*priority)).withColumns({
        "base_key": base_key(F.col("key"), cut), "__place": place,
    })
    rep = F.struct("market", "title", "category", "sell_price", "list_price")
    order = F.struct("__place", F.when(F.col("sell_price") > 0, 0).otherwise(1), "ordinal")

    def greatest_in_first_market(counter: str) -> Column:
        return F.max(F.struct((-F.col("__place")).alias("p"), F.col(counter).alias("v")))["v"].alias(counter)

    picked = keyed.groupBy(*by, "base_key").agg(
        F.min_by(rep, order).alias("r"), greatest_in_first_market("sale_last_week"), greatest_in_first_market("sale_last_days")
    ).select(*by, "base_key", "r.*", "sale_last_week", "sale_last_days")
    code = F.create_map(*[F.lit(x) for kv in currencies.items() for x in kv])
    home_rate = rates.where(F.col("currency") == home).agg(F.max("rate").alias("r")).select("r").scalar()
    home_rate = F.coalesce(home_rate, F.lit(FALLBACK_RATES.get(home)).cast("double"))
    priced = enrich(
        picked.withColumn("currency", F.try_element_at(code, F.col("market"))), rates, ["currency"], "left", {"rate": 1.0}
    )
    factor = F.col("rate") / home_rate
    listed = F.coalesce(F.nullif(F.col("list_price"), F.lit(0.0)), F.col("sell_price"))
    sell_home, list_home = F.col("sell_price") * factor, listed * factor
    return priced.select(
        *by, "base_key", "market", "title", "category", "sale_last_week", "sale_last_days",
        (F.bround(sell_home, 2) if rounded else sell_home).alias("sell_price"),
        (F.bround(list_home, 2) if rounded else list_home).alias("list_price"),
        discount_pct(F.col("sell_price"), listed).alias("discount_pct"),
    )


def counter_revenue(colours: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weekly and daily counter x sell and list price, product colours and those with sales."""
    return weighted_revenue(colours, ["sale_last_week", "sale_last_days"], ["sell_price", "list_price"], by)


def daily_estimate(colours: DataFrame) -> DataFrame:
    """Product colours that sold in the last seven days, with their daily units and revenues, unrounded."""
    return colours.where(F.col("sale_last_week") > 0).withColumn("units", F.col("sale_last_week") / 7.0).withColumns({
        "revenue_sell": F.col("units") * F.col("sell_price"), "revenue_list": F.col("units") * F.col("list_price"),
    })


def category_estimate(colours: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Daily estimate per category from a seven-day counter, and a total row with a NULL category.

    Product colours that sold nothing are left out. A category rounds its sums; the total adds the products' rounded values.
    """
    scales = {"units": 1, "revenue_sell": 2, "revenue_list": 2}
    active = daily_estimate(colours)
    rounded = {c: F.bround(c, s).cast(f"decimal(38,{s})") for c, s in scales.items()}
    sets = [[F.col(c) for c in by], [*[F.col(c) for c in by], F.col("category")]]
    sums = active.withColumns({f"__{c}": v for c, v in rounded.items()}).groupingSets(sets, *by, "category").agg(
        *[F.sum(c).alias(c) for c in scales], *[F.sum(f"__{c}").cast("double").alias(f"__{c}") for c in scales],
        F.count(F.lit(1)).alias("product_colours"), F.grouping("category").alias("__whole"),
    )
    shown = {c: F.when(F.col("__whole") == 1, F.col(f"__{c}")).otherwise(F.bround(c, s)) for c, s in scales.items()}
    return sums.withColumns(shown).select(
        *by, "category", *scales, "product_colours", discount_of_totals(F.col("revenue_sell"), F.col("revenue_list")).alias("avg_discount_pct")
    )

"""Review counts as a demand proxy; monthly review history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import share
from tidemark.operators.aggregates import monthly_breakdown
from tidemark.operators.deltas import snapshot_delta
from tidemark.operators.filters import whole_word
from tidemark.operators.joins import enrich
from tidemark.operators.picks import first_seen, latest_run_per_day
from tidemark.operators.reshape import bucket_other


def rating_metrics(df: DataFrame, by: Sequence[str], rating: str, top, scale_to: int = 5) -> DataFrame:
    """Mean of a 0-1 rating on a scale to ``scale_to`` and the share of the top bucket."""
    rated = F.count(rating)
    return df.groupBy(*by).agg(
        F.bround(F.avg(rating) * scale_to, 3).alias("avg_rating"),
        F.when(rated > 0, F.bround(F.count_if(F.col(rating) == top) / rated * 100, 1)).otherwise(0.0).alias("pct_top"),
    )


def _product_totals(latest: DataFrame, prices: DataFrame) -> DataFrame:
    """Per day: total and new reviews and their value at the products' prices; no price counts 0."""
    per_product = latest.groupBy("snapshot_date", "product").agg(F.sum("count").alias("count"))
    grown = snapshot_delta(per_product, ["product"], "snapshot_date", "count", max_gap_days=None, mode="growth",
                           first_as_zero=True)
    priced = enrich(grown, prices, ["product"], "left", {"price": 0.0})
    return priced.groupBy("snapshot_date").agg(
        F.sum("count").alias("total_reviews"), F.sum("growth").alias("total_new_reviews"),
        F.bround(F.sum(F.col("price") * F.col("growth")), 0).alias("proxy_value"),
    )


def proxy_summary(
    counts: DataFrame, prices: DataFrame, labels: Mapping[str, str], tracked: Sequence[str]
) -> DataFrame:
    """Per day: total and new reviews, proxy value, new reviews per tracked country, new channels.

    ``counts`` holds cumulative counts by (snapshot_date, run, product, channel); the last run of a
    day replaces all that earlier ones left. A product's first sighting counts all its reviews as new, and so does a
    channel's when the captured day before lacks it.
    """
    latest = latest_run_per_day(counts, "snapshot_date", "run").drop("run")
    totals = _product_totals(latest, prices)
    per_channel = latest.groupBy("snapshot_date", "channel").agg(F.sum("count").alias("count"))
    moved = snapshot_delta(per_channel, ["channel"], "snapshot_date", "count", max_gap_days=None, mode="growth",
                           first_as_zero=True, adjacent=True)
    code = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    bucket = bucket_other(F.try_element_at(code, F.col("channel")), tracked)
    country = [
        F.coalesce(F.sum(F.when(F.col("bucket") == c, F.col("growth"))), F.lit(0)).alias(f"new_{c}")
        for c in [*tracked, "other"]
    ]
    by_country = moved.withColumn("bucket", bucket).groupBy("snapshot_date").agg(*country)
    seen = first_seen(per_channel, ["channel"], "snapshot_date").where("is_expansion")
    signals = seen.groupBy(F.col("first_seen").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("new_channels"))
    return enrich(totals.join(by_country, "snapshot_date"), signals, ["snapshot_date"], "left", {"new_channels": 0})


def _rated_days(ratings: DataFrame, scale_to: int, top: float) -> DataFrame:
    """Per day: mean rating on a scale to ``scale_to`` and the share of the top rating, from counts per rating."""
    rows = F.sum("count")
    best = F.coalesce(F.sum(F.when(F.col("rating") == top, F.col("count"))), F.lit(0))
    return ratings.where("rating is not null").groupBy("snapshot_date").agg(
        F.bround(F.when(rows > 0, F.sum(F.col("rating") * F.col("count")) / rows * scale_to), 3).alias("avg_rating"),
        F.when(rows > 0, F.bround(best / rows * 100, 1)).otherwise(0.0).alias("pct_top"),
    )


def _first_sightings(moved: DataFrame, signals: Mapping[str, str]) -> DataFrame:
    """Per day: the members first seen then, sorted and comma-joined, one column per dimension; a dimension's first day seeds it."""
    first = moved.where(F.col("dimension").isin(*signals)).groupBy("dimension", "member").agg(F.min("snapshot_date").alias("snapshot_date"))
    start = first.groupBy("dimension").agg(F.min("snapshot_date").alias("__start"))
    later = first.join(start, "dimension").where(F.col("snapshot_date") > F.col("__start"))
    names = [
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("dimension") == d, F.col("member")))), ",").alias(column)
        for d, column in signals.items()
    ]
    return later.groupBy("snapshot_date").agg(*names)


def review_summary(
    counts: DataFrame, prices: DataFrame, aggregates: DataFrame, ratings: DataFrame,
    tracked: Mapping[str, Sequence[str]], labels: Mapping[str, Mapping[str, str]] | None = None,
    others: Mapping[str, str] | None = None, signals: Mapping[str, str] | None = None, scale_to: int = 5, top: float = 1.0,
) -> DataFrame:
    """The whole daily review summary, one row per captured day.

    ``counts`` (snapshot_date, run, product, channel, count) gives totals, new reviews and the proxy value, ``ratings``
    (snapshot_date, run, rating, count) the mean and the share of the ``top`` rating. ``aggregates`` (snapshot_date, run,
    dimension, member, count) gives new reviews per tracked member, ``new_<member>``, against the captured day before: a
    member it lacks counts in full, a falling count as 0. ``labels`` renames members of a dimension, several to one name if
    need be; ``others`` names the column of a dimension that takes all members that are not tracked, and NULL; ``signals`` names a
    column of the members first seen on a day, by their own names. The last run of a day replaces earlier ones in each input.
    Days come from ``counts``: where another input lacks a day, its numbers are 0, its signals empty and its ratings NULL.
    """
    labels, others, signals = labels or {}, others or {}, signals or {}
    columns = [f"new_{m}" for members in tracked.values() for m in members] + list(others.values()) + list(signals.values())
    if len(set(columns)) < len(columns):
        raise ValueError(f"columns of several dimensions share a name: {sorted(columns)}")
    totals = _product_totals(latest_run_per_day(counts, "snapshot_date", "run").drop("run"), prices)
    latest = latest_run_per_day(aggregates, "snapshot_date", "run").drop("run")
    per_member = latest.groupBy("snapshot_date", "dimension", "member").agg(F.sum("count").alias("count"))
    moved = snapshot_delta(per_member, ["dimension", "member"], "snapshot_date", "count", max_gap_days=None, mode="growth",
                           first_as_zero=True, adjacent=True)
    cells = []
    for dimension, members in tracked.items():
        renamed = labels.get(dimension)
        code = F.col("member")
        if renamed is not None:
            code = F.try_element_at(F.create_map(*[F.lit(x) for kv in renamed.items() for x in kv]), code)
        bucket, here = bucket_other(code, members, "\0other"), F.col("dimension") == dimension
        wanted = {m: f"new_{m}" for m in members} | ({"\0other": others[dimension]} if dimension in others else {})
        cells += [F.coalesce(F.sum(F.when(here & (bucket == m), F.col("growth"))), F.lit(0)).alias(c) for m, c in wanted.items()]
    numbers = [f"new_{m}" for members in tracked.values() for m in members] + list(others.values())
    rated = _rated_days(latest_run_per_day(ratings, "snapshot_date", "run"), scale_to, top)
    out = enrich(enrich(totals, rated, ["snapshot_date"]), moved.groupBy("snapshot_date").agg(*cells), ["snapshot_date"], "left", dict.fromkeys(numbers, 0))
    return enrich(out, _first_sightings(moved, signals), ["snapshot_date"], "left", dict.fromkeys(signals.values(), "")) if signals else out


def monthly_history(
    reviews: DataFrame, dims: Mapping[str, Column], tracked: Mapping[str, Sequence[str]], capped: Column
) -> DataFrame:
    """Wide monthly history: totals, then the tracked members and ``other`` of each dimension."""
    long = monthly_breakdown(reviews, "month", dims, capped)
    cells = [
        F.max(F.when(F.col("dimension") == "total", F.col("total"))).alias("total"),
        F.max(F.when(F.col("dimension") == "total", F.col("total_uncapped"))).alias("total_uncapped"),
    ]
    for dim, members in tracked.items():
        here = F.col("dimension") == dim
        cells += [
            F.coalesce(F.sum(F.when(here & (F.col("member") == m), F.col("total"))), F.lit(0)).alias(f"{dim}_{m}")
            for m in members
        ]
        cells.append(F.coalesce(
            F.sum(F.when(here & ~F.col("member").isin(*members), F.col("total"))), F.lit(0)
        ).alias(f"{dim}_other"))
    return long.groupBy("month").agg(*cells)


def target_share(reviews: DataFrame, month: str, is_target: Column, by: Column | None = None) -> DataFrame:
    """Monthly count of target rows, of all rows and the share in percent."""
    group = [F.col(month).alias("month")] + ([by] if by is not None else [])
    return reviews.groupBy(*group).agg(
        F.count_if(is_target).alias("targets"), F.count(F.lit(1)).alias("total")
    ).withColumn("share_pct", share(F.col("targets"), F.col("total")))


def two_source_share(
    items: DataFrame, totals: DataFrame, month: str, category: str, name: str, word: str, categories: Sequence[str],
    excluded: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Wide monthly shares: items named by the whole word, from one source, over category totals from another.

    ``excluded`` lists words that rule an item out in its category. A month or category that one source lacks counts 0
    there; the share is NULL without a total. ``totals`` has (month, category, total).
    """
    ruled_out = F.lit(False)
    for member, words in excluded.items():
        for part in words:
            ruled_out = ruled_out | ((F.col(category) == member) & F.contains(F.lower(name), F.lit(part)))
    wanted = whole_word(F.col(name), word, []) & ~ruled_out & F.col(category).isin(*categories)
    counted = items.where(wanted).groupBy(F.col(month).alias("month"), F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("targets"))
    known = totals.where(F.col(category).isin(*categories)).select(F.col(month).alias("month"), F.col(category).alias("category"), "total")
    both = counted.join(known, ["month", "category"], "full").fillna(0, subset=["targets", "total"])

    def of(member: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("category") == member, F.col(column))), F.lit(0))

    wide = both.groupBy("month").agg(*[of(m, c).alias(f"{m}_{c}") for m in categories for c in ("targets", "total")])
    return wide.withColumns({f"{m}_share_pct": share(F.col(f"{m}_targets"), F.col(f"{m}_total")) for m in categories})

"""Snapshot-to-snapshot change: per-entity deltas, date pairs, series changes.

Snapshot facts hold one row per entity and day, so an entity's history is no longer than the
calendar and a window over it stays small even for the busiest entity. For histories without
that bound (several captures a day, raw counters) pass ``segment``: the history is then split
into pieces that are windowed apart and only their edge rows meet again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import RESTOCK_MINIMUM


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Mapping[str, str],
    segment: Column | None = None,
) -> DataFrame:
    """Add values of the preceding row of the same entity, NULL on the first one.

    ``columns`` maps new name -> source column; the flag ``is_first`` is added as well.
    ``segment`` is an expression that never decreases along ``order``.
    """
    carried = F.struct(*[F.col(source).alias(name) for name, source in columns.items()])
    if segment is None:
        whole = Window.partitionBy(*keys).orderBy(order)
        linked = df.withColumn("__prev", F.lag(carried).over(whole))
    else:
        cut = df.withColumn("__segment", segment)
        inner = Window.partitionBy(*keys, "__segment").orderBy(order)
        parts = cut.select(
            "*",
            F.lag(carried).over(inner).alias("__prev"),
            carried.alias("__carried"),
            F.row_number().over(inner).alias("__at"),
            F.lead(F.lit(1)).over(inner).isNull().alias("__last"),
        )
        edges = parts.where((F.col("__at") == 1) | F.col("__last"))
        across = Window.partitionBy(*keys).orderBy(order, "__at")
        heads = edges.withColumn("__prev", F.lag("__carried").over(across)).where(F.col("__at") == 1)
        linked = parts.where(F.col("__at") > 1).unionByName(heads)
        linked = linked.drop("__segment", "__carried", "__at", "__last")
    return linked.select(
        *[c for c in linked.columns if c != "__prev"],
        F.col("__prev").isNull().alias("is_first"),
        *[F.col("__prev")[name].alias(name) for name in columns],
    )


def snapshot_delta(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    measure: str,
    price: str | None = None,
    max_gap_days: int | None = 1,
    mode: str = "sold",
    threshold: int = RESTOCK_MINIMUM,
    first_as_zero: bool = False,
    adjacent: bool = False,
    order: str | None = None,
    segment: Column | None = None,
    captured: DataFrame | None = None,
) -> DataFrame:
    """Change of ``measure`` against the entity's previous snapshot.

    Always adds ``prev_date``, ``prev_value``, ``is_first`` and ``delta``. ``delta`` is NULL without a
    previous value or, when ``max_gap_days`` is set, when the previous snapshot is older than that.
    ``first_as_zero`` counts the first sighting against 0. ``adjacent`` forgets a key that the captured
    date just before lacks: on its return it counts as a first sighting; ``captured`` has the captured dates where
    ``df`` does not hold them all. ``order`` names a finer order than the date, such as the capture time.

    ``mode`` adds:

    * ``sold`` - ``sold`` (never negative) and ``revenue`` at the current price;
    * ``metrics`` - flags and units for new, matched, restocked, unchanged, sold and sold without price;
    * ``three_way`` - ``kind`` in first / restock / return / sale; a return counts as negative ``sold``;
    * ``growth`` - ``growth``, the change clamped at 0;
    * ``diff`` - nothing more than the signed change.
    """
    linked = previous_row(df, keys, order or date, {"prev_date": date, "prev_value": measure}, segment)
    if adjacent:
        # One row per calendar day: the size of this broadcast is bounded by the date type.
        calendar = F.broadcast(date_calendar(df if captured is None else captured, date).select(date, F.col("prev_date").alias("__day_before")))
        linked = linked.join(calendar, date, "left")
        near = F.coalesce(F.col("prev_date") == F.col("__day_before"), F.lit(False))
        linked = linked.withColumns({
            "is_first": ~near, "prev_date": F.when(near, F.col("prev_date")),
            "prev_value": F.when(near, F.col("prev_value")),
        }).drop("__day_before")
    before = F.when(F.col("is_first"), F.lit(0)).otherwise(F.col("prev_value")) if first_as_zero else F.col("prev_value")
    change = F.col(measure) - before
    if max_gap_days is not None:
        near = F.datediff(date, "prev_date") <= max_gap_days
        change = F.when((F.col("is_first") if first_as_zero else F.lit(False)) | near, change)
    out = linked.withColumn("delta", change)
    if mode == "diff":
        return out
    if mode == "growth":
        return out.withColumn("growth", F.greatest(F.lit(0), "delta"))
    drop, rise = F.greatest(F.lit(0), -F.col("delta")), F.greatest(F.lit(0), F.col("delta"))
    if mode == "sold":
        out = out.withColumn("sold", F.coalesce(drop, F.lit(0)))
        return out if price is None else out.withColumn("revenue", F.col("sold") * F.col(price))
    if mode == "metrics":
        priced = F.lit(True) if price is None else F.col(price).isNotNull()
        sold = F.when(priced, drop).otherwise(0)
        return out.select(
            "*",
            (~F.col("is_first")).alias("is_matched"),
            (F.col("delta") > 0).alias("is_restock"),
            (F.col("delta") == 0).alias("is_unchanged"),
            F.coalesce(rise, F.lit(0)).alias("restock_units"),
            F.coalesce(sold, F.lit(0)).alias("sold"),
            F.coalesce(F.when(~priced, drop), F.lit(0)).alias("sold_without_price"),
            F.coalesce(sold * F.col(price) if price else F.lit(0), F.lit(0)).alias("revenue"),
        )
    if mode == "three_way":
        kind = (
            F.when(F.col("delta").isNull(), "first")
            .when(F.col("delta") >= threshold, "restock")
            .when(F.col("delta") > 0, "return")
            .otherwise("sale")
        )
        out = out.withColumn("kind", kind)
        return out.withColumn("sold", F.when(F.col("kind").isin("sale", "return"), -F.col("delta")).otherwise(0))
    raise ValueError(f"unknown mode {mode!r}")


def date_calendar(df: DataFrame, date: str) -> DataFrame:
    """Distinct dates with the previous and next captured date.

    The dates are made distinct before the window: it then sees one row per day, never the facts.
    """
    along = Window.orderBy(date)
    days = df.select(F.col(date).cast("date").alias(date)).where(F.col(date).isNotNull()).distinct()
    return days.select(date, F.lag(date).over(along).alias("prev_date"), F.lead(date).over(along).alias("next_date"))


def date_pair_delta(
    df: DataFrame, keys: Sequence[str], date: str, measure: str, form: str = "union_sum"
) -> DataFrame:
    """Current against previous captured date for every entity seen on either; an absent side is 0.

    Gaps between captured dates are spanned. ``union_sum`` scans and shuffles the facts once: each row
    counts as current on its day and as previous on the next captured day. ``full_outer`` joins the two
    sides. Both give the same rows.
    """
    # One row per calendar day: the size of this broadcast is bounded by the date type.
    calendar = F.broadcast(date_calendar(df, date))
    facts = df.select(F.col(date).cast("date").alias(date), *keys, F.col(measure).alias("__q")).join(calendar, date)
    if form == "union_sum":
        quantity = F.coalesce(F.col("__q"), F.lit(0).cast(df.schema[measure].dataType))
        nothing = F.lit(0).cast(df.schema[measure].dataType)
        sides = F.array(
            F.struct(
                F.when(F.col("prev_date").isNotNull(), F.col(date)).alias("day"),
                nothing.alias("prev"),
                quantity.alias("curr"),
            ),
            F.struct(F.col("next_date").alias("day"), quantity.alias("prev"), nothing.alias("curr")),
        )
        both = facts.select(*keys, F.explode(sides).alias("s")).where(F.col("s.day").isNotNull())
        paired = both.groupBy(F.col("s.day").alias(date), *keys).agg(
            F.sum("s.prev").alias("prev"), F.sum("s.curr").alias("curr")
        )
    elif form == "full_outer":
        current = facts.where(F.col("prev_date").isNotNull()).select(date, *keys, F.col("__q").alias("curr"))
        previous = facts.where(F.col("next_date").isNotNull()).select(
            F.col("next_date").alias(date), *keys, F.col("__q").alias("prev")
        )
        on = [date, *keys]
        previous = previous.withColumnsRenamed({k: f"__{k}" for k in on})
        same = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"__{k}")), on, F.lit(True))
        paired = current.join(previous, same, "full").select(
            *[F.coalesce(k, f"__{k}").alias(k) for k in on],
            F.coalesce("prev", F.lit(0)).alias("prev"), F.coalesce("curr", F.lit(0)).alias("curr"),
        )
    else:
        raise ValueError(f"unknown form {form!r}")
    return paired.withColumn("delta", F.col("curr") - F.col("prev"))


def flow_totals(delta: DataFrame, by: Sequence[str], column: str = "delta") -> DataFrame:
    """Outflow and inflow summed apart, so moves between locations do not cancel out."""
    d = F.col(column)
    return delta.groupBy(*by).agg(
        F.sum(F.greatest(F.lit(0), -d)).alias("outflow"), F.sum(F.greatest(F.lit(0), d)).alias("inflow")
    )


def hours_since_previous(df: DataFrame, stamp: str) -> DataFrame:
    """Hours from the previous row by time. Meant for one row per day, i.e. after a daily rollup."""
    micros = F.unix_micros(F.col(stamp).cast("timestamp"))
    return df.withColumn(
        "hours_since_prev_snapshot", (micros - F.lag(micros).over(Window.orderBy(stamp))) / 3.6e9
    )


def series_change(df: DataFrame, date: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Row-to-row change of one or more daily series."""
    along = Window.partitionBy(*keys).orderBy(date)
    return df.withColumn("change", F.col(value) - F.lag(value).over(along))

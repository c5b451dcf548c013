"""Aggregations: guarded ratios, exact medians, one-pass rollups, event packing, audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



# --- medians -------------------------------------------------------------------------------

def _order_key(value: Column) -> Column:
    """A bigint that never decreases as the double grows: exponent, then 51 mantissa bits."""
    magnitude = F.abs(value)
    exponent = F.greatest(F.floor(F.log2(magnitude)), F.lit(-1022))
    mantissa = ((magnitude / F.pow(F.lit(2.0), exponent) - 1.0) * F.lit(2.0**51)).cast("bigint")
    key = (exponent + 1023) * F.lit(2**51) + mantissa + F.lit(2**51)
    sign = F.signum(value).cast("bigint")
    # NaN rows are dropped by a filter, but Spark may look at the key of a row before that filter.
    return (
        F.when((value == 0) | F.isnan(value), F.lit(0).cast("bigint"))
        .when(magnitude == float("inf"), sign * F.lit(2**62))
        .otherwise(sign * key)
    )


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows per (group, value) without NULL and NaN; combines on the map side and spreads hot groups."""
    usable = F.col("__v").isNotNull() & ~F.isnan("__v")
    return (
        df.select(*by, F.lit(0).alias("__all"), F.col(value).cast("double").alias("__v"))
        .groupBy(*by, "__all", "__v").agg(F.count(F.lit(1)).alias("__n"))
        # The count keeps this filter above the aggregation, so a derived value is computed once.
        .where(F.when(usable, F.col("__n")).otherwise(0) > 0)
        # A key that is never NULL gives Spark nothing to infer: every use then shares one exchange.
        .withColumn("__k", F.coalesce(_order_key(F.col("__v")), F.lit(0)))
    )


def exact_median(
    df: DataFrame, by: Sequence[str], value: str, name: str = "median", bits: Sequence[int] = (46, 30)
) -> DataFrame:
    """Exact median per group, with the row count ``n``; NULL and NaN are left out.

    The built-in ``median`` holds every distinct value of a group in one task. Here rows are first
    counted per (group, value). Histograms over ever finer prefixes of the value then narrow each
    group down to the short interval that holds its middle; only that interval is ordered. No window
    sees more rows than a histogram has buckets.
    """
    return _median_of_counts(value_counts(df, by, value), by, name, bits)


def _median_of_counts(counted: DataFrame, by: Sequence[str], name: str, bits: Sequence[int] = (46, 30)) -> DataFrame:
    group = [*by, "__all"]

    def narrow(rows: DataFrame, keys: Sequence[str], shift: int, column: str) -> DataFrame:
        """Bucket of each wanted rank and the rank inside that bucket."""
        bucket = F.shiftright("__k", shift).alias(column)
        carry = [c for c in rows.columns if c in ("__rank", "n")]
        hist = rows.groupBy(*keys, *carry, bucket).agg(F.sum("__n").alias("__n"))
        order = Window.partitionBy(*keys).orderBy(column)
        return hist.withColumn("__below", F.sum("__n").over(order) - F.col("__n"))

    whole = Window.partitionBy(*group)
    first = narrow(counted, group, bits[0], "__b0").withColumn("n", F.sum("__n").over(whole))
    ranks = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))
    inside = (F.col("__rank") >= F.col("__below")) & (F.col("__rank") < F.col("__below") + F.col("__n"))
    wanted = (
        first.withColumn("__rank", F.explode(ranks)).withColumn("__which", F.col("__rank")).where(inside)
        .withColumn("__rank", F.col("__rank") - F.col("__below")).drop("__n", "__below")
    )
    prefix, shift = "__b0", bits[0]
    for level, finer in enumerate(bits[1:], start=1):
        rows = _within(counted, wanted, group, prefix, shift)
        column = f"__b{level}"
        wanted = (
            narrow(rows, [*group, "__which"], finer, column).where(inside)
            .withColumn("__rank", F.col("__rank") - F.col("__below")).drop("__n", "__below")
        )
        prefix, shift = column, finer
    rows = _within(counted, wanted, group, prefix, shift)
    order = Window.partitionBy(*group, "__which").orderBy("__v")
    middle = rows.withColumn("__below", F.sum("__n").over(order) - F.col("__n")).where(inside)
    return middle.groupBy(*group).agg(F.avg("__v").alias(name), F.first("n").alias("n")).drop("__all")


def _within(counted: DataFrame, wanted: DataFrame, group: Sequence[str], prefix: str, shift: int) -> DataFrame:
    """Counted values of the wanted buckets; group keys match null-safely."""
    c, w = counted.alias("c"), wanted.alias("w")
    same = F.shiftright(F.col("c.__k"), shift) == F.col(f"w.{prefix}")
    for key in group:
        same = same & F.col(f"c.{key}").eqNullSafe(F.col(f"w.{key}"))
    extra = [F.col(f"w.{x}") for x in ("__which", "__rank", "n")]
    return c.join(w, same).select(*[F.col(f"c.{k}") for k in group], "c.__v", "c.__n", "c.__k", *extra)


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join on the group keys, in which NULL meets NULL."""
    same = F.lit(True)
    for key in by:
        same = same & left[key].eqNullSafe(F.col(f"__{key}"))
    return left.join(right.withColumnsRenamed({k: f"__{k}" for k in by}), same, how).drop(*[f"__{k}" for k in by])


def price_stats(df: DataFrame, by: Sequence[str], price: str, scale: int = 2) -> DataFrame:
    """Mean and exact median of a price list per group, rounded.

    The mean is summed in decimals, so it does not depend on how the rows are partitioned.
    """
    counted = value_counts(df, by, price)
    total = F.sum(F.col("__v").try_cast("decimal(24,6)") * F.col("__n"))
    means = counted.groupBy(*by).agg((total / F.sum("__n")).alias("average_price"))
    medians = _median_of_counts(counted, by, "median_price")
    joined = join_groups(means, medians, by)
    return joined.select(
        *by, "n", F.bround("average_price", scale).cast("double").alias("average_price"),
        F.bround("median_price", scale).alias("median_price"),
    )


def median_levels(
    df: DataFrame, by: Sequence[str], level: str, value: str, overall: str = "of_medians"
) -> DataFrame:
    """Median per (by, level) plus one overall row per ``by`` with a NULL level.

    The overall row is the median of the level medians, or of all ``pooled`` values. Both come from one scan: the pooled
    values are the counts of the levels, counted once more; level medians are one small row per level, such as a country.
    """
    none = F.lit(None).cast(df.schema[level].dataType).alias(level)
    if overall == "pooled":
        counted = value_counts(df, [*by, level], value)
        both = F.array(F.struct(level, F.lit(0).alias("__all")), F.struct(none, F.lit(1).alias("__all")))
        spread = counted.select(*by, F.explode(both).alias("__s"), "__v", "__k", "__n")
        pooled = spread.groupBy(*by, F.col(f"__s.{level}").alias(level), F.col("__s.__all").alias("__all"), "__v", "__k").agg(F.sum("__n").alias("__n"))
        return _median_of_counts(pooled, [*by, level], "median")
    if overall != "of_medians":
        raise ValueError(f"unknown overall {overall!r}")
    within = Window.partitionBy(*by)
    own, top = F.struct(level, "median", "n"), F.struct(none, F.median("median").over(within).alias("median"), F.count(F.lit(1)).over(within).alias("n"))
    leads = F.row_number().over(within.orderBy(level)) == 1
    rows = exact_median(df, [*by, level], value).select(*by, own.alias("__own"), top.alias("__top"), leads.alias("__leads"))
    each = F.explode(F.when(F.col("__leads"), F.array("__own", "__top")).otherwise(F.array("__own"))).alias("__r")
    return rows.select(*by, each).select(*by, "__r.*")


# --- rollups and packing -------------------------------------------------------------------

def rollups(df: DataFrame, date: str, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Grand total and one rollup per dimension, from one scan, in long form.

    Gives (date, dimension, member, aggregates); the grand total is dimension ``total``.
    """
    sets = [[F.col(date)], *[[F.col(date), F.col(d)] for d in dims]]
    grouped = df.groupingSets(sets, date, *dims).agg(*aggs, *[F.grouping(d).alias(f"__g_{d}") for d in dims])
    dimension, member = F.lit("total"), F.lit(None).cast("string")
    for d in dims:
        used = F.col(f"__g_{d}") == 0
        dimension = F.when(used, d).otherwise(dimension)
        member = F.when(used, F.col(d).cast("string")).otherwise(member)
    measures = [c for c in grouped.columns if c not in (date, *dims) and not c.startswith("__g_")]
    return grouped.select(date, dimension.alias("dimension"), member.alias("member"), *measures)


def pack_rows(
    df: DataFrame, by: Sequence[str], fields: Sequence[str], name: str, rows_per_record: int = 10_000
) -> DataFrame:
    """Rows of a group as JSON lists, none of which is much longer than ``rows_per_record``.

    A large group becomes several records (numbered by ``part``), so no list grows with the data. Equal rows are counted
    first and dealt out by their number, so they spread like others and fall to the same part when a task runs again.
    """
    keys = [*by, *[f for f in fields if f not in by]]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    sizes = counted.groupBy(*by).agg(F.ceil(F.sum("__n") / rows_per_record).alias("__parts"))
    each = join_groups(counted, sizes, by).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")))
    part = F.pmod(F.xxhash64(*fields, "__copy"), F.col("__parts")).alias("part")
    packed = each.groupBy(*by, part).agg(F.collect_list(F.struct(*fields)).alias(name))
    return packed.withColumn(name, F.to_json(name))


def collect_events(
    df: DataFrame, by: Sequence[str], condition: Column, fields: Sequence[str], name: str = "events"
) -> DataFrame:
    """Rows that satisfy the condition, packed per group."""
    return pack_rows(df.where(condition), by, fields, name)


def explode_events(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Packed records back to rows."""
    kept = [c for c in df.columns if c not in (column, "part")]
    items = F.explode(F.from_json(column, f"array<struct<{schema}>>")).alias("__e")
    return df.select(*kept, items).select(*kept, "__e.*")


# --- counters and revenue ------------------------------------------------------------------

def weighted_revenue(
    df: DataFrame, counters: Sequence[str], prices: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Sum of counter x price for every combination, rows and active rows."""
    products = [F.sum(F.col(c) * F.col(p)).alias(f"{c}_x_{p}") for c in counters for p in prices]
    active = F.lit(False)
    for c in counters:
        active = active | (F.col(c) > 0)
    return df.groupBy(*by).agg(
        *products, F.count(F.lit(1)).alias("total"), F.count_if(active).alias("with_sales")
    )


def discount_of_totals(sell_total: Column, list_total: Column) -> Column:
    """Revenue-weighted discount percentage to one decimal, 0 without list revenue."""
    return F.when(list_total > 0, F.bround(100.0 * (1.0 - sell_total / list_total), 1)).otherwise(0.0)


def monthly_breakdown(
    df: DataFrame, month: str, dims: Mapping[str, Column], capped: Column | None = None
) -> DataFrame:
    """Monthly counts with one breakdown per dimension; ``capped`` rows are left out of a second total."""
    aggs = [F.count(F.lit(1)).alias("total")]
    columns = [F.col(month), *[c.alias(n) for n, c in dims.items()]]
    if capped is not None:
        columns.append(F.coalesce(capped, F.lit(False)).alias("__capped"))
        aggs.append(F.count_if(~F.col("__capped")).alias("total_uncapped"))
    return rollups(df.select(*columns), month, list(dims), aggs)


def currency_mix(df: DataFrame, by: Sequence[str], currency: str) -> DataFrame:
    """Rows per currency."""
    return df.groupBy(*by, currency).agg(F.count(F.lit(1)).alias("n"))


def lot_counts(tenders: DataFrame, winners: DataFrame, keys: Sequence[str], tender: str) -> DataFrame:
    """Tenders and distinct winning tenders per lot; lots without winners count 0."""
    offered = tenders.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_tenders"))
    won = winners.select(*keys, tender).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("num_winners"))
    return join_groups(offered, won, keys, "left").withColumn("num_winners", F.coalesce("num_winners", F.lit(0)))


def merge_results(results: DataFrame, keys: Sequence[str], ordinal: str, values: Sequence[str]) -> DataFrame:
    """Last non-empty value per column over repeated results of one lot."""
    def last_filled(name: str) -> Column:
        filled = F.nullif(F.col(name), F.lit("")) if dict(results.dtypes)[name] == "string" else F.col(name)
        return F.max_by(F.col(name), F.when(filled.isNotNull(), F.col(ordinal))).alias(name)

    return results.groupBy(*keys).agg(*[last_filled(v) for v in values])

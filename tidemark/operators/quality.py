"""Data-quality checks; each returns rows to look at and changes no number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import looks_garbled, repair_garbled
from tidemark.operators.aggregates import join_groups
from tidemark.operators.deltas import date_calendar


def audit(df: DataFrame, date: str, keys: Sequence[str], by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Rows, distinct dates, distinct keys, first and last date, per group if asked.

    Exact distinct keys are counted from rows already reduced to one per (group, date, key).
    ``approximate`` uses a sketch instead: one pass and no wide shuffle.
    """
    bounds = [F.min(date).alias("first_date"), F.max(date).alias("last_date")]
    key = F.struct(*keys)
    if approximate:
        return df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(date).alias("dates"),
            F.approx_count_distinct(F.xxhash64(*keys)).alias("keys"), *bounds,
        )
    per_key = df.groupBy(*by, key.alias("__k")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(date).alias("__a"), F.max(date).alias("__b")
    )
    totals = per_key.groupBy(*by).agg(
        F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("keys"),
        F.min("__a").alias("first_date"), F.max("__b").alias("last_date"),
    )
    days = df.select(*by, date).distinct().groupBy(*by).agg(F.count(date).alias("dates"))
    joined = join_groups(totals, days, by)
    return joined.select(*by, "rows", "dates", "keys", "first_date", "last_date")


def day_sketches(df: DataFrame, date: str, keys: Sequence[str], by: Sequence[str] = (), log2_size: int = 12) -> DataFrame:
    """One row per day (and group): rows and a mergeable sketch of its keys.

    An audit of a long history reads these rows instead of the history; new days are appended to them.
    """
    sketch = F.hll_sketch_agg(F.xxhash64(*keys), F.lit(log2_size))
    return df.groupBy(*by, F.col(date).cast("date").alias(date)).agg(F.count(F.lit(1)).alias("rows"), sketch.alias("sketch"))


def audit_days(days: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """The audit from ``day_sketches``: all exact but ``keys``, whose standard error is about 1.04 / sqrt(2 ** log2_size)."""
    return days.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.count_distinct(date).alias("dates"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("keys"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"),
    )


def gaps(df: DataFrame, date: str, max_gap_days: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Captured dates (per key, if given) whose predecessor is older than allowed."""
    if keys:
        # Distinct days first: a key's history is then no longer than the calendar.
        days = df.select(*keys, F.to_date(date).alias(date)).distinct()
        along = Window.partitionBy(*keys).orderBy(date)
        days = days.withColumn("prev_date", F.lag(date).over(along))
    else:
        days = date_calendar(df, date)
    days = days.withColumn("gap_days", F.datediff(date, "prev_date"))
    return days.where(F.col("gap_days") > max_gap_days).select(*keys, date, "prev_date", "gap_days")


def missing_dates(df: DataFrame, date: str) -> DataFrame:
    """Calendar days without a capture inside the observed range."""
    days = df.select(F.to_date(date).alias(date)).where(F.col(date).isNotNull()).distinct()
    span = days.agg(F.min(date).alias("a"), F.max(date).alias("b")).where(F.col("a").isNotNull())
    every = span.select(F.explode(F.sequence("a", "b")).alias(date))
    return every.join(days, date, "left_anti")


def mojibake(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per text column that show UTF-8 read as Latin-1, from one scan."""
    counts = df.agg(*[F.count_if(looks_garbled(F.col(c))).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "garbled")


def repair(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows with garbled text put right."""
    fixed = {c: F.when(looks_garbled(F.col(c)), repair_garbled(F.col(c))).otherwise(F.col(c)) for c in columns}
    return df.withColumns(fixed)


def low_volume(df: DataFrame, by: Sequence[str], minimum: int | DataFrame) -> DataFrame:
    """Groups with fewer rows than the minimum: one number, or a table (by, minimum).

    With a table, a listed group without any row is reported with 0.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    if isinstance(minimum, int):
        checked = counts.withColumn("minimum", F.lit(minimum).cast("bigint"))
    else:
        checked = minimum.join(counts, list(by), "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return checked.where(F.col("rows") < F.col("minimum")).select(*by, "rows", "minimum")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key: exact, mismatch, only_a or only_b."""
    left = a.select(*keys, F.struct(*columns).alias("__a"))
    right = b.select(*keys, F.struct(*columns).alias("__b"))
    verdict = (
        F.when(F.col("__b").isNull(), "only_a").when(F.col("__a").isNull(), "only_b")
        .when(F.col("__a").eqNullSafe(F.col("__b")), "exact").otherwise("mismatch")
    )
    return left.join(right, list(keys), "full").select(*keys, verdict.alias("verdict"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def zero_days(df: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """Days on which every measure sums to 0."""
    totals = df.groupBy(date).agg(
        F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(F.abs(c)), F.lit(0)).alias(c) for c in columns]
    )
    empty = F.lit(True)
    for c in columns:
        empty = empty & (F.col(c) == 0)
    return totals.where(empty).select(date, "rows")

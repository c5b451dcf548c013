"""Time series: monthly resampling, chunk windows and stitching of relative series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.aggregates import join_groups


def to_month(
    df: DataFrame, date: str, value: str, keys: Sequence[str] = (), dense: bool = True, scale: int | None = None
) -> DataFrame:
    """Mean per month end; ``dense`` adds the empty months of each series with a NULL value."""
    mean = F.avg(value) if scale is None else F.bround(F.avg(value), scale)
    monthly = df.groupBy(*keys, F.last_day(date).alias("month")).agg(mean.alias(value))
    if not dense:
        return monthly
    span = monthly.groupBy(*keys).agg(F.min("month").alias("a"), F.max("month").alias("b"))
    firsts = F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))
    months = span.select(*keys, F.explode(firsts).alias("m")).select(*keys, F.last_day("m").alias("month"))
    return join_groups(months, monthly, [*keys, "month"], "left")


def chunk_windows(start: Column, end: Column, step_months: int, overlap_months: int) -> Column:
    """Array of (chunk, chunk_start, chunk_end) that covers start..end with overlaps.

    A window starts ``overlap_months`` before the end of the one before it; the list ends when a
    window would not start later than its predecessor. The span gives how many windows there can be.
    """
    if step_months <= overlap_months:
        raise ValueError("a window must reach further than it overlaps")
    # Two more than the months give, since a start may move to the last day of a shorter month.
    most = F.ceil(F.months_between(end, start) / (step_months - overlap_months)) + 2
    empty = F.array().cast("array<struct<chunk:int,chunk_start:date,chunk_end:date>>")

    def extend(acc: Column, i: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        begin = F.when(F.size(acc) == 0, start).otherwise(F.add_months(last["chunk_end"], -overlap_months))
        more = (begin < end) & (last.isNull() | (begin > last["chunk_start"]))
        item = F.struct(
            i.cast("int").alias("chunk"), begin.alias("chunk_start"),
            F.least(F.add_months(begin, step_months), end).alias("chunk_end"),
        )
        return F.when(more, F.concat(acc, F.array(item))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.coalesce(F.greatest(most, F.lit(0)), F.lit(0)).cast("int")), empty, extend)


def stitch(
    df: DataFrame, series: Sequence[str], chunk: str, date: str, value: str, fill: str = "missing"
) -> DataFrame:
    """One continuous series from overlapping chunks, each scaled to what is already there.

    Scale of a chunk = mean of the stitched series over the overlap / own mean over the overlap;
    1 when there is no overlap or the own mean is not positive. Values already present are kept.
    ``fill`` says what a chunk adds: its dates that are ``missing``, or only the ``tail`` after the
    last date so far.

    The facts give, per chunk, a few overlap sums by owning chunk. The recurrence over those
    coefficients runs inside one small row per series (chunks are windows of a calendar), and the
    scales then join back to the facts.
    """
    keys = list(series)
    if fill == "tail":
        ends = df.groupBy(*keys, chunk).agg(F.max(date).alias("__end"))
        earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
        reach = ends.select(*keys, chunk, F.max("__end").over(earlier).alias("__reach"))
        marked = df.join(reach, [*keys, chunk]).withColumn(
            "__own", F.col("__reach").isNull() | (F.col(date) > F.col("__reach"))
        )
        owner = F.min(F.when(F.col("__own"), F.col(chunk)))
    elif fill == "missing":
        marked, owner = df, F.min(F.col(chunk))
    else:
        raise ValueError(f"unknown fill {fill!r}")

    # At most one row per chunk shares a date, so these windows are tiny.
    same_date = Window.partitionBy(*keys, date)
    placed = marked.withColumn("__owner", owner.over(same_date))
    placed = placed.withColumn(
        "__owned", F.max(F.when(F.col(chunk) == F.col("__owner"), F.col(value))).over(same_date)
    )
    overlap = placed.where((F.col("__owner") < F.col(chunk)) & F.col(value).isNotNull())
    parts = overlap.groupBy(*keys, chunk, "__owner").agg(
        F.sum("__owned").alias("ref"), F.sum(value).alias("own")
    )
    per_chunk = parts.groupBy(*keys, chunk).agg(
        F.sum("own").alias("own"), F.collect_list(F.struct(F.col("__owner").alias("o"), "ref")).alias("refs")
    )
    every = df.select(*keys, chunk).distinct().join(per_chunk, [*keys, chunk], "left")
    listed = every.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(chunk).cast("int").alias("c"), "own", "refs"))).alias("cs")
    )

    def scale_next(scales: Column, item: Column) -> Column:
        carried = F.aggregate(
            item["refs"], F.lit(0.0), lambda acc, r: acc + r["ref"] * F.try_element_at(scales, r["o"].cast("int"))
        )
        # nullif keeps the division legal when both branches are evaluated
        scale = F.when(item["own"] > 0, carried / F.nullif(item["own"], F.lit(0.0))).otherwise(1.0)
        return F.map_concat(scales, F.create_map(item["c"], scale))

    none = F.create_map().cast("map<int,double>")
    scales = listed.select(*keys, F.explode(F.aggregate("cs", none, scale_next)).alias("__c", "__scale"))
    kept = placed.where(F.col(chunk) == F.col("__owner")).withColumn("__c", F.col(chunk).cast("int"))
    return kept.join(scales, [*keys, "__c"]).select(
        *keys, date, chunk, (F.col(value) * F.col("__scale")).alias(value)
    )

"""Wide and long forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.aggregates import join_groups

def melt(df: DataFrame, ids: Sequence[str], name: str = "series", value: str = "value", columns=None) -> DataFrame:
    """Wide to long; missing values give no row."""
    wide = list(columns or [c for c in df.columns if c not in ids])
    return df.unpivot(list(ids), wide, name, value).where(F.col(value).isNotNull())


def melt_paired(
    df: DataFrame, ids: Sequence[str], pattern: str, parts: Sequence[str], metrics: Mapping[str, str]
) -> DataFrame:
    """Melt columns named ``<product> <country> <metric>``; rows with every metric NULL are skipped.

    ``pattern`` has one group per part and a last one for the metric; ``metrics`` maps the metric word
    to its output column. The row holds all its columns, so no shuffle is needed.
    """
    import re

    cells: dict[tuple[str, ...], dict[str, str]] = {}
    for column in df.columns:
        hit = re.fullmatch(pattern, column)
        if hit:
            *place, metric = hit.groups()
            cells.setdefault(tuple(place), {})[metric] = column
    complete = {p: found for p, found in cells.items() if set(found) == set(metrics)}
    items = F.array(*[
        F.struct(
            *[F.lit(v).alias(n) for n, v in zip(parts, place)],
            *[F.col(f"`{found[m]}`").cast("bigint").alias(out) for m, out in metrics.items()],
        )
        for place, found in complete.items()
    ])
    rows = df.select(*ids, F.explode(items).alias("c")).select(*ids, "c.*")
    return rows.dropna(how="all", subset=list(metrics.values()))


def pivot_fixed(
    df: DataFrame, ids: Sequence[str], column: str, values: Sequence[str], measure: str, fill=0
) -> DataFrame:
    """Long to wide with the columns given; missing cells get ``fill``."""
    wide = df.groupBy(*ids).pivot(column, list(values)).agg(F.sum(measure))
    return wide if fill is None else wide.fillna(fill, subset=list(values))


def latest_order(df: DataFrame, date: str, column: str, order_by: str) -> DataFrame:
    """``column``, ``latest`` and ``position``: members by their value on the latest date, greatest first, the rest by name.

    The window sees one row per member, never the facts.
    """
    last = df.agg(F.max(date).alias("d")).select("d").scalar()
    sums = df.groupBy(column).agg(F.coalesce(F.sum(F.when(F.col(date) == last, F.col(order_by))), F.lit(0)).alias("latest"))
    return sums.withColumn("position", F.row_number().over(Window.orderBy(F.col("latest").desc(), column)))


def long_by_latest(df: DataFrame, date: str, column: str, measures: Sequence[str], order_by: str) -> DataFrame:
    """Dates x members in long form, with each member's ``position`` in the wide report; any number of members."""
    sums = df.groupBy(date, column).agg(*[F.sum(m).alias(m) for m in measures])
    return join_groups(sums, latest_order(df, date, column, order_by).select(column, "position"), [column])


def pivot_by_latest(
    df: DataFrame, date: str, column: str, measures: Mapping[str, str], members: Sequence[str], scale: int | None = None
) -> DataFrame:
    """Dates x (member, measure) for the members given, in their order; ``measures`` maps column -> label."""
    def cell(member: str, measure: str) -> Column:
        total = F.coalesce(F.sum(F.when(F.col(column) == member, F.col(measure))), F.lit(0))
        return total if scale is None else F.bround(total, scale)

    cells = [cell(m, c).alias(f"{m} ({label})") for c, label in measures.items() for m in members]
    return df.groupBy(date).agg(*cells)


def bucket_other(column: Column, tracked: Sequence[str], other: str = "other") -> Column:
    """Tracked values stay, everything else (NULL too) is ``other``."""
    return F.when(column.isin(*tracked), column).otherwise(other)


def combine_series(parts: Mapping[str, DataFrame], on: str, value: str, anchor: str | None = None) -> DataFrame:
    """Several series side by side by date: union in long form, one pivot.

    ``anchor`` names a series that is dropped from the result after its dates took part.
    """
    long = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(on, F.lit(n).alias("__s"), F.col(value).alias("__v")) for n, df in parts.items()],
    )
    shown = [n for n in parts if n != anchor]
    return long.groupBy(on).agg(*[F.max(F.when(F.col("__s") == n, F.col("__v"))).alias(n) for n in shown])


def densify(df: DataFrame, date: str, column: str, members: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Every listed member on every captured date, 0 where there was no row."""
    every = df.select(date).distinct().withColumn(column, F.explode(F.array(*[F.lit(m) for m in members])))
    return every.join(df, [date, column], "left").fillna(0, subset=list(measures))

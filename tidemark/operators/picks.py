"""One row per key: first by priority, last wins, first seen, latest run, ordering and top-k.

All picks are ``min_by`` / ``max_by`` aggregations: they combine on the map side, so a key that
holds a large part of the rows reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _pick(df: DataFrame, keys: Sequence[str], chooser, order: Sequence[Column | str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if len(order) == 1 and isinstance(order[0], str):
        names = {*rest, order[0]}
        if all(isinstance(df.schema[n].dataType, _FIXED_WIDTH) for n in names):
            # Fixed-width buffers are aggregated by hash; all columns see the same comparisons, so one row wins.
            return df.groupBy(*keys).agg(*[chooser(c, order[0]).alias(c) for c in rest]).select(*df.columns)
    packed = df.groupBy(*keys).agg(chooser(F.struct(*rest), F.struct(*order)).alias("__row"))
    return packed.select(*keys, "__row.*").select(*df.columns)


def first_by(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """Whole row with the smallest order value per key."""
    return _pick(df, keys, F.min_by, order)


def last_wins(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """Whole row with the greatest order value per key."""
    return _pick(df, keys, F.max_by, order)


def first_by_priority(
    df: DataFrame,
    keys: Sequence[str],
    source: str,
    priority: Sequence[str],
    ordinal: str,
    prefer: Column | None = None,
) -> DataFrame:
    """Row of the first source in ``priority`` that lists the key; unlisted sources are dropped.

    Within that source a row that satisfies ``prefer`` comes first, then the lowest ordinal.
    """
    place = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(source))
    listed = df.where(F.col(source).isin(*priority))
    wanted = F.lit(0) if prefer is None else F.when(prefer, 0).otherwise(1)
    return first_by(listed, keys, place.alias("a"), wanted.alias("b"), F.col(ordinal))


def first_seen(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """First date per key; ``is_expansion`` marks keys that came after the first captured date."""
    per_key = df.groupBy(*keys).agg(F.min(date).alias("first_seen"))
    start = df.agg(F.min(date).alias("start"))
    return per_key.select(
        "*", (F.col("first_seen") > start.select("start").scalar()).alias("is_expansion")
    )


def latest_run_per_day(df: DataFrame, date: str, run: str) -> DataFrame:
    """Rows of each day's last run; everything that earlier runs of that day left is replaced."""
    last = df.groupBy(F.col(date).alias("__day")).agg(F.max(run).alias("__run"))
    return df.join(last, F.col(date).eqNullSafe(F.col("__day")) & (F.col(run) == F.col("__run"))).drop("__day", "__run")


def latest_run_per_key(df: DataFrame, date: str, run: str, keys: Sequence[str] = ()) -> DataFrame:
    """The last row of each day and key, whichever run it came from."""
    return last_wins(df, [date, *keys], run)


def top_k(df: DataFrame, by: Column, k: int, groups: Sequence[str] = (), ties: Sequence[str] = ()) -> DataFrame:
    """The k greatest rows, over all rows or per group.

    Spark keeps k rows per task (and per group) before anything moves.
    """
    order = [by.desc(), *[F.col(t) for t in ties]]
    if not groups:
        return df.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") <= k).drop("__place")


def pinned_order(df: DataFrame, column: str, pinned: str, *then: str) -> DataFrame:
    """Rows of the pinned value first, then by the column and the further columns."""
    return df.orderBy(F.when(F.col(column) == pinned, 0).otherwise(1), column, *then)


def status_order(df: DataFrame, status: str, places: Mapping[str, int], date_text: str) -> DataFrame:
    """By mapped status, then by parsed date; dates that do not parse come last."""
    place = reduce(lambda c, kv: c.when(F.col(status) == kv[0], kv[1]), places.items(), F.when(F.lit(False), 0))
    return df.orderBy(place.asc_nulls_last(), F.try_to_date(F.col(date_text), "yyyy-MM-dd").asc_nulls_last())


def new_elements(current: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct current elements that are not known yet."""
    return current.dropDuplicates(list(keys)).join(known.select(*keys).distinct(), list(keys), "left_anti")


def concat_first(a: DataFrame, b: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Rows of ``a`` then ``b``, keeping the first per key."""
    both = a.withColumn("__src", F.lit(0)).unionByName(b.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    return first_by(both, keys, "__src", ordinal).drop("__src")


def union_labelled(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Union of several sources by column name, each row labelled with its source."""
    labelled = [df.withColumn(label, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), labelled)

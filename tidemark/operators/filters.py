"""Row predicates and guards against repeated capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import json_attribute


def same_text(column: Column, value: str) -> Column:
    """Equality in any case."""
    return F.upper(column) == value.upper()


def json_attribute_is(column: Column, name: str, value: str) -> Column:
    """Attribute of a JSON string equals the value; bad JSON does not match."""
    return F.coalesce(json_attribute(column, name) == value, F.lit(False))


def title_excluded(title: Column, patterns: Sequence[str]) -> Column:
    """True when the title holds any of the patterns, in any case."""
    lowered = F.lower(title)
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.contains(lowered, F.lit(pattern.lower()))
    return hit


def all_marked(skus: Column, marker: str) -> Column:
    """True when a non-empty SKU array carries the marker in every item."""
    return (F.size(skus) > 0) & F.forall(skus, lambda s: F.contains(F.coalesce(s, F.lit("")), F.lit(marker)))


def managed(owner: Column, value: str, quantity: Column) -> Column:
    """Stock is managed by ``value`` and known."""
    return (owner == value) & quantity.isNotNull()


def positive_sum(quantity: Column) -> Column:
    """Sum of the positive quantities, 0 when there is none."""
    return F.coalesce(F.sum(F.when(quantity > 0, quantity)), F.lit(0))


def whole_word(text: Column, word: str, unless: Sequence[str] = ()) -> Column:
    """The word occurs as a whole word and none of the substrings does, in any case."""
    lowered = F.lower(text)
    keep = text.rlike(rf"(?i)\b{word}\b")
    for part in unless:
        keep = keep & ~F.contains(lowered, F.lit(part))
    return keep


def active_or_won(status: Column, won: Column, tracked_by_number: Column) -> Column:
    """Entities tracked by number keep active or won rows, others keep all."""
    return ~tracked_by_number | (status == "Active") | (won == "Yes")


def changed(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def not_captured(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key (a date, or date and entity) is not in the target yet."""
    return df.join(target.select(*keys).distinct(), list(keys), "left_anti")


def names_like(df: DataFrame, column: str, parts: DataFrame, part: str) -> DataFrame:
    """Rows whose name holds any wanted part in any case; all rows when nothing matches.

    The wanted parts are a list typed by a user, so one array in the plan holds them; NULL parts are left out.
    """
    one = parts.agg(F.collect_set(F.lower(part)).alias("__parts"))
    rows = df.join(one, F.lit(True)).withColumn("__lowered", F.lower(F.col(column)))
    rows = rows.withColumn("__named", F.exists("__parts", lambda w: F.contains(F.col("__lowered"), w)))
    found = rows.agg(F.count_if("__named").alias("n")).select("n").scalar()
    return rows.where(F.col("__named") | (found == 0)).select(*df.columns)


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with every key part present and not empty."""
    kept = df.dropna(subset=list(keys))
    for key in keys:
        if dict(df.dtypes)[key] == "string":
            kept = kept.where(F.col(key) != "")
    return kept

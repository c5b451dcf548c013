"""Small decision rules over notice fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import ACTIVE_NOTICE_TYPES


def framework_flag(indicator: Column, fa_max_value: Column, winners: Column, tenders: Column) -> Column:
    """Framework agreement: marked, or with a maximum value, or every one of several tenders won."""
    return F.coalesce(indicator, F.lit(False)) | fa_max_value.isNotNull() | ((winners == tenders) & (tenders > 1))


def role_of(is_winner: Column, is_tenderer: Column, is_buyer: Column) -> Column:
    """Strongest role of a company in a notice."""
    return (
        F.when(is_winner, "Winner").when(is_tenderer, "Tenderer").when(is_buyer, "Buyer").otherwise("Mentioned")
    )


def won_flag(is_winner: Column, winner_name: Column) -> Column:
    """Yes, No, or empty while no winner is named."""
    return F.when(is_winner, "Yes").when(F.coalesce(winner_name, F.lit("")) != "", "No").otherwise("")


def notice_status(is_active: Column, notice_type: Column) -> Column:
    """Active by membership in the active set or by notice type, else Historical."""
    return F.when(is_active | notice_type.isin(*ACTIVE_NOTICE_TYPES), "Active").otherwise("Historical")

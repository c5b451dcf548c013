"""Price lists and partner tables: medians per source, per country and overall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.once import keep_if
from tidemark.functions.numbers import cross_rate, currency_of, loose_number, price_number
from tidemark.operators.aggregates import median_levels, price_stats
from tidemark.operators.joins import with_rate


def cell_values(cells: DataFrame, rates: DataFrame, text: str, country: str, expected: str) -> DataFrame:
    """Table cells to home-currency values; cells without a number are dropped."""
    seen = currency_of(F.col(text), F.col(country)).alias("__seen")
    parsed = cells.select("*", seen, keep_if(loose_number(F.col(text)), lambda v: v.isNotNull()).alias("value"))
    rated = with_rate(parsed, rates, "__seen", expected)
    return rated.withColumn("home_value", F.col("value") * F.col("rate")).drop("__seen", "rate")


def epc_medians(
    cells: DataFrame, rates: DataFrame, by: Sequence[str], text: str = "text", country: str = "country",
    expected: str = "currency", overall: str = "of_medians",
) -> DataFrame:
    """Median value per country and overall, in home currency."""
    return median_levels(cell_values(cells, rates, text, country, expected), by, country, "home_value", overall)


def source_price_stats(prices: DataFrame, by: Sequence[str], text: str) -> DataFrame:
    """Rows, mean and median price per source and day from price texts."""
    read = keep_if(price_number(F.col(text)), lambda v: v.isNotNull()).alias("price")
    return price_stats(prices.select(*by, read), by, "price")


def wide_price_report(stats: DataFrame, date: str, source: str, sources: Mapping[str, object]) -> DataFrame:
    """One row per date: ``average_price_<name>`` of every source, then ``median_price_<name>``, in the order given.

    ``stats`` holds one row per date and source, as ``source_price_stats`` gives; a source without prices on a date has NULL there,
    sources that are not named add nothing but their dates.
    """
    cells = [
        F.max(F.when(F.col(source) == value, F.col(measure))).alias(f"{measure}_{name}")
        for measure in ("average_price", "median_price") for name, value in sources.items()
    ]
    return stats.groupBy(date).agg(*cells)


def rate_table(
    quotes: DataFrame, needed: Sequence[str], home: str, base: str, defaults: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Home currency per unit of each needed currency, one row each, per ``by`` if given.

    ``quotes`` (currency, quote) holds units per ``base``. A currency without a quote takes its default, else 1; without a quote of
    the home currency all do. The home currency itself is always 1, and of repeated quotes the greatest counts. Without ``by`` an
    empty table of quotes gives the defaults.
    """
    wanted = list(dict.fromkeys([home, base, *needed]))
    quoted = {c: F.max(F.when((F.col("currency") == c) & (F.col("quote") > 0), F.col("quote"))).alias(f"__{c}") for c in wanted}
    known = quotes.groupBy(*by).agg(*quoted.values())

    def rate(currency: str):
        default = F.lit(float(defaults.get(currency, 1.0)))
        if currency == home:
            return F.lit(1.0)
        per_home = F.lit(1.0) if home == base else F.col(f"__{home}")
        per_other = F.lit(1.0) if currency == base else F.col(f"__{currency}")
        return cross_rate(per_home, per_other, default)

    rows = F.array(*[F.struct(F.lit(c).alias("currency"), rate(c).alias("rate")) for c in dict.fromkeys(needed)])
    return known.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")

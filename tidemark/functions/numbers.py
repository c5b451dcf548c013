"""Number parsing and arithmetic as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import CURRENCY_CODES, KRONA_BY_COUNTRY
from tidemark.functions.once import let

_NOT_DIGIT = r"[^0-9]"


def decimal_number(text: Column) -> Column:
    """Double of numeric text, else NULL; text is screened first, as failing casts are slow."""
    return F.when(text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), text.try_cast("double"))


def _found(text: Column, pattern: str, group: int) -> Column:
    """Capture group of the first match, NULL when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def abbreviated_count(text: Column) -> Column:
    """``1.5K+`` -> 1500, ``2M`` -> 2000000, else the first integer, else 0."""
    scaled = r"([0-9]+(?:[.,][0-9]+)?)\s*([kKmM])(?![a-zA-Z])"
    number = F.replace(_found(text, scaled, 1), F.lit(","), F.lit(".")).try_cast("double")
    factor = F.when(F.lower(_found(text, scaled, 2)) == "k", 1000).otherwise(1000000)
    plain = _found(text, r"([0-9]+)", 1).try_cast("bigint")
    return F.coalesce((number * factor).try_cast("bigint"), plain, F.lit(0).cast("bigint"))


def bought_in_html(html: Column) -> Column:
    """Units in a ``>1K+ bought`` style badge of a raw page, 0 when absent."""
    return abbreviated_count(_found(html, r"(?i)>([0-9.,]+[km]?)\+?\s*bought", 1))


def best_rank(text: Column, low: int = 0, high: int = 10_000_000) -> Column:
    """Smallest rank written as ``#n``, ``Nr. n`` or ``n in``; links to a top 100 are ignored."""
    cleaned = F.regexp_replace(text, r"(?i)top\s*100", "")
    marks = F.regexp_extract_all(cleaned, F.lit(r"(?i)(?:nr\.?|#)\s*[0-9.,]+|[0-9.,]+\s+in\s+"), F.lit(0))
    ranks = F.transform(marks, lambda m: F.regexp_replace(m, _NOT_DIGIT, "").try_cast("bigint"))
    plausible = F.filter(ranks, lambda r: within(r, low, high))
    return F.coalesce(F.array_min(plausible), F.lit(0).cast("bigint"))


def within(value: Column, low, high) -> Column:
    """Open-interval plausibility test ``low < value < high``."""
    return (value > low) & (value < high)


def loose_number(text: Column) -> Column:
    """First localised number of a table cell; blanks, dash words and zeros are NULL.

    Blanks group thousands, the first dot or comma is the decimal mark.
    """
    number = r"(\d[\d\s\u00A0]*[.,]\d+|\d[\d\s\u00A0]*)"

    def read(cell: Column) -> Column:
        blank = cell.isin("ingen data", "no data", "-", "—", "")
        plain = F.translate(F.regexp_replace(F.regexp_extract(cell, number, 1), r"[\s\u00A0]", ""), ",", ".")
        return let(F.when(~blank, plain), decimal_number)

    value = let(F.lower(F.trim(F.regexp_replace(text, r"[\s\u00A0]+", " "))), read)
    return let(value, lambda v: F.when(F.abs(v) >= 1e-12, v))


def price_number(text: Column) -> Column:
    """Localised price: the last separator is the decimal mark.

    A lone comma is decimal only when two or three digits follow it.
    """
    def text_of(kept: Column) -> Column:
        no_comma = F.replace(kept, F.lit(","), F.lit(""))
        comma_decimal = F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
        return (
            F.when(kept.rlike(r"\..*,[^.]*$"), comma_decimal)
            .when(kept.rlike(r"^\d*,\d{2,3}$"), comma_decimal)
            .otherwise(no_comma)
        )

    return let(F.regexp_replace(text, r"[^0-9,.]", ""), lambda kept: let(text_of(kept), decimal_number))


def simple_price(text: Column) -> Column:
    """Digits with a comma or dot decimal mark; NULL when that is no number."""
    return let(F.translate(F.regexp_replace(text, r"[^0-9,.]", ""), ",", "."), decimal_number)


def spaced_integer(text: Column) -> Column:
    """``12 345`` with plain or hard spaces -> 12345."""
    return F.regexp_replace(text, r"[\s\u00A0]", "").try_cast("bigint")


def hash_rank(text: Column) -> Column:
    """Integer after the first ``#``."""
    return _found(text, r"#([0-9]+)", 1).try_cast("bigint")


def currency_of(text: Column, country: Column) -> Column:
    """Currency written in a cell: a code first, then a symbol, then ``kr`` by country."""
    krona = F.lit("SEK")
    for name, currency in KRONA_BY_COUNTRY.items():
        krona = F.when(country == name, currency).otherwise(krona)
    codes = r"(?i)\b(" + "|".join(CURRENCY_CODES) + r")\b"

    def read(cell: Column) -> Column:
        return (
            F.when(cell.rlike(codes), F.upper(F.regexp_extract(cell, codes, 1)))
            .when(F.contains(cell, F.lit("€")), "EUR")
            .when(cell.rlike(r"(?iu)zł"), "PLN")
            .when(cell.rlike(r"\bCHF\b|(?<!\w)Fr(?!\w)"), "CHF")
            .when(cell.rlike(r"(?i)SEK"), "SEK")
            .when(cell.rlike(r"(?i)\bkr\.?\b"), krona)
        )

    return let(F.trim(F.regexp_replace(text, r"[\s\u00A0]+", " ")), read)


def first_price(*candidates: Column) -> Column:
    """First candidate that casts to a number."""
    return F.coalesce(*[decimal_number(c) for c in candidates])


def first_positive_price(*candidates: Column) -> Column:
    """First candidate that casts to a number other than 0, else 0."""
    return F.coalesce(*[F.nullif(decimal_number(c), F.lit(0.0)) for c in candidates], F.lit(0.0))


def price_field(raw_json: Column, names: tuple[str, ...] = ("sellingPrice", "listPrice", "min", "value")) -> Column:
    """A JSON price that is a number, a numeric string or an object holding one of ``names``."""
    inside = [F.get_json_object(raw_json, "$." + n) for n in names]
    scalar = F.when(~F.ltrim(raw_json).startswith("{"), F.translate(raw_json, '"', ""))
    return F.coalesce(*[decimal_number(c) for c in (scalar, *inside)], F.lit(0.0))


def discount_pct(sell: Column, listed: Column) -> Column:
    """Discount in percent to one decimal, 0 unless the price is below a positive list price."""
    marked_down = (listed > 0) & (sell < listed)
    return F.when(marked_down, F.bround(100.0 * (1.0 - sell / F.nullif(listed, F.lit(0.0))), 1)).otherwise(0.0)


def ratio(numerator: Column, denominator: Column, scale: int | None = None) -> Column:
    """Quotient, NULL when the denominator is 0 or NULL."""
    value = F.when(denominator != 0, numerator / denominator)
    return value if scale is None else F.round(value, scale)


def share(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Percentage of the denominator, NULL when it is 0."""
    return F.when(denominator != 0, F.bround(100.0 * numerator / denominator, scale))


def numeric_sum(values: Column) -> Column:
    """Sum of the items of a string array that are numbers; NULL when none is."""
    numbers = F.filter(F.transform(values, decimal_number), lambda v: v.isNotNull())
    return let(numbers, lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)))


def any_number(value: Column) -> Column:
    """Number of a VARIANT that may be a number, numeric text or a list, of which the numbers are added; else NULL."""
    def number(v: Column) -> Column:
        return decimal_number(F.try_variant_get(v, "$", "string"))

    return F.coalesce(
        let(F.filter(F.transform(F.try_variant_get(value, "$", "array<variant>"), number), lambda v: v.isNotNull()),
            lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v))),
        number(value),
    )


def cross_rate(base_to_home: Column, base_to_other: Column, fallback: Column) -> Column:
    """Home currency per unit of another, both quoted against one base; else the fallback."""
    return F.coalesce(F.when(base_to_other != 0, base_to_home / base_to_other), fallback)


def inverse_rate(per_home: Column) -> Column:
    """``1 / rate``; a missing or zero quote counts as 1."""
    return F.when(per_home != 0, 1.0 / per_home).otherwise(1.0)

"""Procurement notices and lot tenders as latest-state rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import NOTICE_TYPE_LABELS, PROCEDURE_TYPE_LABELS
from tidemark.functions.numbers import any_number
from tidemark.functions.once import keep_if, let
from tidemark.functions.rules import notice_status, role_of, won_flag
from tidemark.functions.text import any_texts, clip, is_given, may_name_company, member, member_texts, names_company, org_number, relabel
from tidemark.operators.filters import active_or_won
from tidemark.operators.joins import mark_exists
from tidemark.sources.notices import lot_tenders, parse_notices

# Members of a notice that are read as text.
TEXT_FIELDS = (
    "publication-number", "notice-type", "publication-date", "procedure-type", "notice-title", "title-proc", "description-proc", "buyer-name",
    "winner-name", "organisation-name-tenderer", "estimated-value-cur-lot", "tender-value-cur", "total-value-cur",
)


def notice_rows(
    notices: DataFrame, payload: str, active: DataFrame, company: Column, org_numbers: Column, seen_at: Column | None = None
) -> DataFrame:
    """Flat notice rows for one company per row, from notices as the search service delivers them.

    A field may be text, a number, a list or {language: texts}; each document is parsed once into a VARIANT. ``company``
    and ``org_numbers`` (array of normalised numbers) may be literals or columns. A notice is Active when its number is in
    ``active`` or its type says so. The title falls back on the procedure's own. ``seen_at`` becomes ``last_seen_at``.
    Documents that are no JSON, or carry no number, give no row.
    """
    kept = [c for c in notices.columns if c != payload]

    def text(name: str) -> Column:
        return F.element_at("__texts", F.lit(name))

    parsed = F.struct(F.try_parse_json(payload).alias("n"), F.col(payload).alias("text"))
    numbered = keep_if(
        let(parsed, lambda p: F.struct(p["n"].alias("n"), member_texts(p["n"], p["text"], TEXT_FIELDS).alias("texts"))),
        lambda p: F.element_at(p["texts"], F.lit("publication-number")) != "",
    )
    n = notices.select(*kept, numbered.alias("__p")).select(*kept, F.col("__p.n").alias("__n"), F.col("__p.texts").alias("__texts"))
    n = n.withColumns({
        "publication_number": text("publication-number"), "__winner": text("winner-name"), "__buyer": text("buyer-name"),
        "__tenderer": text("organisation-name-tenderer"), "__type": text("notice-type"),
    })
    n = mark_exists(n, active, ["publication_number"], "__active")

    def tracked(name: str) -> Column:
        plain = F.transform(any_texts(member(F.col("__n"), name)), org_number)
        return F.coalesce(F.arrays_overlap(plain, org_numbers), F.lit(False))

    def given(first: str, second: str) -> Column:
        return let(member(F.col("__n"), first), lambda one: F.when(is_given(one), one).otherwise(member(F.col("__n"), second)))

    is_winner = names_company(F.col("__winner"), company) | tracked("winner-identifier")
    is_buyer = names_company(F.col("__buyer"), company) | tracked("buyer-identifier")
    seen = [] if seen_at is None else [seen_at.alias("last_seen_at")]
    return n.select(
        *kept, company.alias("company"), "publication_number", notice_status(F.col("__active"), F.col("__type")).alias("status"),
        F.get(F.split(text("publication-date"), r"\+"), F.lit(0)).alias("publication_date"),
        won_flag(is_winner, F.col("__winner")).alias("won_by_company"),
        role_of(is_winner, names_company(F.col("__tenderer"), company), is_buyer).alias("role"),
        let(given("tender-value", "total-value"), any_number).alias("awarded_value"), F.col("__buyer").alias("buyer_name"),
        let(member(F.col("__n"), "estimated-value-lot"), any_number).alias("estimated_value"), F.col("__winner").alias("winner_name"),
        relabel(F.col("__type"), NOTICE_TYPE_LABELS).alias("notice_type"),
        F.coalesce(F.nullif(text("notice-title"), F.lit("")), text("title-proc")).alias("title"), clip(text("description-proc")).alias("description"),
        F.when(is_given(member(F.col("__n"), "tender-value-cur")), text("tender-value-cur")).otherwise(text("total-value-cur")).alias("awarded_currency"), text("estimated-value-cur-lot").alias("estimated_currency"),
        F.col("__tenderer").alias("tenderers"), relabel(text("procedure-type"), PROCEDURE_TYPE_LABELS).alias("procedure_type"), *seen,
    )


def notice_shapes(notices: DataFrame, payload: str, fields: Sequence[str]) -> DataFrame:
    """How often each field comes as which type (``field``, ``shape``, ``notices``): what a service changed shows here."""
    parsed = notices.select(F.try_parse_json(payload).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.schema_of_variant(member(F.col("n"), f)).alias("shape")) for f in fields]))
    kind = F.coalesce(F.regexp_extract("x.shape", r"^(\w+)", 1), F.lit("ABSENT"))
    return parsed.select(each.alias("x")).groupBy(F.col("x.field").alias("field"), kind.alias("shape")).agg(F.count(F.lit(1)).alias("notices"))


def report_rows(rows: DataFrame, tracked_by_number: Column) -> DataFrame:
    """Rows for the report: companies tracked by number show only active or won notices."""
    return rows.where(active_or_won(F.col("status"), F.col("won_by_company"), tracked_by_number))


def lot_tender_rows(xml: DataFrame, notices: DataFrame, company: Column) -> DataFrame:
    """Lot tenders of a company from notice documents, with the notice's own fields.

    Only documents whose text can name the company are parsed.
    """
    candidates = xml.where(may_name_company(F.col("xml"), company))
    rows = lot_tenders(parse_notices(candidates), company)
    fields = ["publication_number", "publication_date", "buyer_name", "notice_type", "notice_title"]
    return rows.join(notices.select(*fields), "publication_number", "left").withColumn("company", company)

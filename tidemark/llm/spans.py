"""Spans found in texts: rows of one shape and the digest columns that queries derive from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "doc_id long, spans array<struct<kind: string, start: int, end: int, score: double, value: string>>"


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_digest(found: DataFrame, base_kinds: tuple[str, ...]) -> DataFrame:
    """Counts per base kind, a checksum over the base spans and the list of all spans."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*base_kinds))
    return found.select(
        "doc_id", *[_count(spans, kind).alias(f"n_{kind}") for kind in base_kinds],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(spans).alias("spans"),
    )


def span_rows(doc_ids: list, found: list[list[tuple]]) -> dict:
    """Output columns for spans given as (kind, start, end, score, value)."""
    return {
        "doc_id": doc_ids,
        "spans": [[{"kind": k, "start": a, "end": b, "score": s, "value": v} for k, a, b, s, v in rows] for rows in found],
    }

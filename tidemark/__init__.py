"""tidemark: analytics over daily snapshots of catalogs, stock, prices, ranks, reviews and notices."""

from tidemark.session import build_session, cut_lineage

__all__ = ["build_session", "cut_lineage"]

"""Check queries over the provided tables, grouped by area."""

from importlib import import_module

from tidemark.workload.registry import ORACLES, QUERIES

AREAS = ("stock", "joins", "measures", "scalars", "payloads", "views")


def _load() -> None:
    for area in AREAS:
        import_module(f"tidemark.workload.{area}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)

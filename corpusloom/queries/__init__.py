"""Named queries of the core, and their SQL."""

from __future__ import annotations

from corpusloom.queries import registry


def core_queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def core_oracles() -> dict[str, str]:
    _load()
    return dict(registry.SQL)


def _load() -> None:
    from corpusloom.queries import analytics, files, governance, graphs, policies, streams, strings  # noqa: F401

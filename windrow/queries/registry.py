"""All registered queries and their SQL forms."""

from __future__ import annotations

from windrow.queries import corpus, models, quality, vectors

_MODULES = (corpus, vectors, quality, models)


def queries() -> dict:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}

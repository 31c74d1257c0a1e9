"""All registered queries of the library proper."""

from __future__ import annotations

from . import changes, cleaning, networks, places, quality, spatial, text

_PARTS = (cleaning, spatial, changes, networks, places, quality, text)


def queries() -> dict:
    return {k: f for p in _PARTS for k, f in p.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for p in _PARTS for k, s in p.SQL.items()}

"""All queries of the core."""

from __future__ import annotations

from folioframe.plans import nested, pages, quality, runs, steps

_PARTS = (nested, pages, quality, runs, steps)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}

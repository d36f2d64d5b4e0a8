"""Every query of the core, by name, with the SQL that checks it."""

from __future__ import annotations

from lodestar.plans import catalogue, matching, published, tables, upkeep

_MODULES = (matching, catalogue, tables, published, upkeep)

QUERIES = {name: query for module in _MODULES for name, (query, _) in module.ENTRIES.items()}
ORACLES = {name: sql for module in _MODULES for name, (_, sql) in module.ENTRIES.items() if sql}

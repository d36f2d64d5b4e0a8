"""Queries of the subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from lodestar.llm import (
    boilerplate,
    groups,
    mixing,
    neighbours,
    packing,
    residue,
    sentences,
    topn,
    truncation,
)

_MODULES = (boilerplate, groups, residue, neighbours, topn, truncation, packing, mixing, sentences)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

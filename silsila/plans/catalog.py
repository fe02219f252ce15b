"""All registered queries."""

from __future__ import annotations

from silsila.plans import registry
from silsila.plans import card_queries, chain_queries, text_queries  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES

"""Registry of the core queries and, where SQL can express them, their oracle statements."""

from __future__ import annotations

from presswerk.operators.timestamps import p7_found
from presswerk.plans import curation_queries, platform_queries, retrieval_queries, serving_queries, source_queries, text_queries

MODULES = [text_queries, retrieval_queries, curation_queries, serving_queries, source_queries, platform_queries]
QUERIES = {"p7_found": p7_found}
ORACLES: dict[str, str] = {}
for _module in MODULES:
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
FLAGSHIP = "r13_retrieve_feed"

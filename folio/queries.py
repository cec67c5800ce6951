"""Named queries over the driver's tables, each with the same query in DuckDB's SQL where SQL can express it."""

from __future__ import annotations

from .plans import block_queries, book_queries, corpus_queries, metric_queries, page_queries

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _m in (block_queries, book_queries, page_queries, corpus_queries, metric_queries):
    QUERIES |= _m.QUERIES
    ORACLES |= _m.ORACLES

"""Every registered query of the price part, and its SQL."""

from __future__ import annotations

from pricelens.plans import catalog, crawl_queries, ledger_queries, load_queries, metric_queries

_MODULES = (catalog, crawl_queries, metric_queries, ledger_queries, load_queries)
QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}

"""Queries of the library's operators on the given tables, each with its SQL check."""

from __future__ import annotations

from registered import aggregates, domain, joins, projections, reports, sinks, sources

MODULES = [sources, projections, joins, aggregates, domain, reports, sinks]

QUERIES = {name: run for module in MODULES for name, (run, _) in module.QUERIES.items()}
ORACLES = {
    name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None
}

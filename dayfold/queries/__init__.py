"""Every operator as a query over the given tables, with an equal SQL text to check it."""

from dayfold.queries import aggregates, combines, functions, jobs, scans, sinks

MODULES = (scans, aggregates, combines, functions, sinks, jobs)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

"""The operators run over the driver's tables: adapters, queries and their SQL counterparts."""

from martloom.workload import geo, increments, streams, tables, vault, warehouse

_MODULES = (warehouse, geo, vault, tables, streams, increments)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}

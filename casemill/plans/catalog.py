"""All registered queries and the SQL they are checked against."""

from casemill.plans import queries_checks, queries_documents, queries_joins, queries_logs, queries_metrics

_MODULES = [queries_metrics, queries_checks, queries_joins, queries_documents, queries_logs]

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

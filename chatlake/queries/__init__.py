"""The registered queries and their SQL counterparts."""

from chatlake.queries import corpus, logs, scoring, storage

_MODULES = (corpus, scoring, logs, storage)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}

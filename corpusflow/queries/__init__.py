"""Registered queries over the star-schema and corpus tables, each with its SQL counterpart."""

from corpusflow.queries import corpus, order, scalars, streams, telemetry, tokens, tracking

_MODULES = (corpus, tokens, order, telemetry, tracking, scalars, streams)


def queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}

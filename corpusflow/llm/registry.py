"""Registered queries of the subpackage and their SQL counterparts."""

from corpusflow.llm import (
    embeddings,
    langid,
    licenses,
    manifest,
    maxent,
    merkle,
    mixture,
    packing,
    phrases,
    pieces,
    quality,
    repeats,
    simhash,
)

_MODULES = (packing, simhash, merkle, licenses, langid, quality, pieces, maxent, embeddings, repeats, phrases, manifest, mixture)


def queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}

"""Queries over the supplied tables, one per operator, each with the SQL that must agree.

Every module holds ``QUERIES`` (name to function of session and folder) and ``ORACLES``
(name to SQL).  The tables stand in for trips, requests, logs and vectors.
"""

from __future__ import annotations

from vecspark.catalog import blocks, changes, codes, flows, ingest, logs, streams, vectors

MODULES = (ingest, changes, vectors, codes, blocks, logs, streams, flows)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

"""Registered queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from rowsmith.queries import collections, generation, issues, pages, profiles, repairs, responses, storage

MODULES = (profiles, issues, collections, repairs, generation, pages, responses, storage)


def all_queries():
    """Query name to callable(spark, sf_dir)."""
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles():
    """Query name to the SQL text that gives the same rows."""
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

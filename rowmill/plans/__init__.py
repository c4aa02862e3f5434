"""The registered queries: one callable per operator, and the SQL that gives the same rows."""

from __future__ import annotations

from . import changes, databases, reads, typing_jobs

_GROUPS = (reads, changes, typing_jobs, databases)


def all_queries() -> dict:
    return {name: query for group in _GROUPS for name, query in group.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: text for group in _GROUPS for name, text in group.ORACLES.items()}

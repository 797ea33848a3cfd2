"""Registry of the named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, sf_dir) under a name, with the SQL that gives the same rows."""

    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return add


from . import answers, assembling, drifting, evaluation, lifecycle, merging, passes, queueing, recorded, records, reporting, scans, various, voting, windowing, wording  # noqa: E402, F401  each registers its queries

"""The engine's queries over the driver tables, each with the DuckDB SQL that it must agree with."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with its SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


from weft.queries import catalogue, dataflow, history, payloads, planning, reporting, streams  # noqa: E402, F401

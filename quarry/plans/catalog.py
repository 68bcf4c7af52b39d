"""Named queries over the driver tables and their DuckDB oracle SQL.

Each entry of ``QUERIES`` is ``(spark, sf_dir) -> DataFrame`` and reads the
given tables in full; ``ORACLE`` holds the equivalent DuckDB SQL for the same
name (column names identical, floats rounded to 6 digits on both sides).
Column bindings follow FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# SQL fragments shared by the oracle strings ------------------------------------------
# Python-style strip set and the token rule, spelled for DuckDB.
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
TOK = "'[^ \\t\\n\\r\\f]+'"


def ntok(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, {TOK}))"


def strip(expr: str) -> str:
    return f"trim({expr}, {WS})"


# Import the modules that register queries (order = report order).
from quarry.plans import queries_corpus  # noqa: E402,F401
from quarry.plans import queries_scoring  # noqa: E402,F401
from quarry.plans import queries_events  # noqa: E402,F401
from quarry.plans import queries_vectors  # noqa: E402,F401
from quarry.plans import queries_streaming  # noqa: E402,F401
from quarry.plans import queries_sources  # noqa: E402,F401

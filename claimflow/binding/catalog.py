"""Registered queries: (Spark query, equivalent SQL) per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimflow.binding.sql import compose

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL it must agree with."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = compose(sql.strip())
        return function

    return register


def load_all() -> None:
    from claimflow.binding import q_cleanse, q_dispatch, q_relational, q_runs, q_sources, q_stateful, q_transitions, q_views  # noqa: F401

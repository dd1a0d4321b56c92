"""The registry of queries: each is a plan over a folder of tables, most with an equivalent statement for a SQL engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return add


def core() -> Registry:
    """All queries outside the optional subpackage."""
    from . import ballots, models, orphans, phrases, records, relational, sequences, streams, texts, writes

    out = Registry()
    for module in (ballots, models, orphans, phrases, records, relational, sequences, streams, texts, writes):
        out.queries |= module.query.queries
        out.sql |= module.query.sql
    return out

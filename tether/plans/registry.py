"""Where query modules register what they offer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Register the function below under ``name``, with the DuckDB SQL of the same result."""

        def keep(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(name)
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return keep

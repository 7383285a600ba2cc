"""Named queries: a DataFrame builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}

    def add(self, sql: str | None = None) -> Callable[[Builder], Builder]:
        """Register the decorated builder under its own name."""

        def register(build: Builder) -> Builder:
            name = build.__name__
            if name in self.queries:
                raise ValueError(f"query {name} registered twice")
            self.queries[name] = Query(name, build, sql)
            return build

        return register


REGISTRY = Registry()

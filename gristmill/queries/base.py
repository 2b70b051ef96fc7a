"""Registration of queries and access to the driver tables and views."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from gristmill.queries.views import VIEWS, duckdb_text, placeholders
from gristmill.sources.tables import TABLES, load_table


@dataclass
class Data:
    """Tables and views by attribute; each is opened once, since every open reads file footers."""

    spark: SparkSession
    folder: str
    opened: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.opened:
            if name in TABLES:
                self.opened[name] = load_table(self.spark, self.folder, name)
            elif name in VIEWS:
                self.opened[name] = self.sql(VIEWS[name].replace("{bytes}", "octet_length"))
            else:
                raise AttributeError(name)
        return self.opened[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{t: getattr(self, t) for t in placeholders(text)})


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Data], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``@view`` in the SQL is replaced by the view's text."""
    def register(build: Callable[[Data], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, build, expand(sql) if sql else None)
        return build

    return register


@lru_cache(maxsize=None)
def expand(sql: str) -> str:
    return re.sub(r"@(\w+)", lambda m: duckdb_text(m.group(1)), sql)

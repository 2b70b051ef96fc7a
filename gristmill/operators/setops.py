"""Unions by name, top-n and ordering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Concatenate; a column one side lacks becomes null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


concat = union_by_name


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_by_name(*frames).distinct()


def top_n(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """First ``n`` rows in a total order (compiled to a per-partition top-n and a merge)."""
    return df.orderBy(*order).limit(n)


def sort_by_count(df: DataFrame, count: str = "occurrences", tie: str = "code") -> DataFrame:
    return df.orderBy(F.col(count).desc(), F.col(tie))


def align(df: DataFrame, mapping: dict[str, str | Column | None]) -> DataFrame:
    """Rename and complete to a common layout: name -> source column, expression, or None for null."""
    def source(value) -> Column:
        if isinstance(value, Column):
            return value
        return F.lit(None) if value is None else F.col(value)

    return df.select(*[source(value).alias(name) for name, value in mapping.items()])


def add_or_replace(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Move ``{temporary: final}`` columns into place, overwriting a final column that already exists."""
    return df.withColumns({final: F.col(temp) for temp, final in renames.items()}).drop(*renames)

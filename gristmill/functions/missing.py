"""Comparisons under the rule that a missing value sorts below every other value and equals itself.

The monthly programs were written for a system with that order, so ``cancelled <= end`` holds for an open
contract there. SQL would answer NULL; these helpers never do. They are built from IS NULL tests and plain comparisons,
which a Parquet scan can take as filters.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def gt_m(a: Any, b: Any) -> Column:
    a = _col(a)
    if not isinstance(b, Column) and b is not None:
        return a.isNotNull() & (a > b)
    b = _col(b)
    return a.isNotNull() & (b.isNull() | (a > b))


def lt_m(a: Any, b: Any) -> Column:
    a = _col(a)
    if not isinstance(b, Column) and b is not None:
        return a.isNull() | (a < b)
    return gt_m(b, a)


def le_m(a: Any, b: Any) -> Column:
    a = _col(a)
    if not isinstance(b, Column) and b is not None:
        return a.isNull() | (a <= b)
    return ~gt_m(a, b)


def ge_m(a: Any, b: Any) -> Column:
    a = _col(a)
    if not isinstance(b, Column) and b is not None:
        return a.isNotNull() & (a >= b)
    return ~lt_m(a, b)


def eq_m(a: Any, b: Any) -> Column:
    return _col(a).eqNullSafe(_col(b))


def ne_m(a: Any, b: Any) -> Column:
    return ~eq_m(a, b)


def between_m(low: Any, c: Column, high: Any) -> Column:
    """``low <= c <= high`` with a real lower bound: a missing value is never inside."""
    return c.isNotNull() & c.between(low, high)


def in_m(c: Column, values: list) -> Column:
    return c.isNotNull() & c.isin(list(values)) if values else F.lit(False)


def notin_m(c: Column, values: list) -> Column:
    return c.isNull() | ~c.isin(list(values)) if values else F.lit(True)

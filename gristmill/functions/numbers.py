"""Arithmetic with the missing-value conventions of the monthly programs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def least_m(*cols: Column) -> Column:
    """n-ary minimum that skips missing values."""
    return F.least(*cols)


def greatest_m(*cols: Column) -> Column:
    """n-ary maximum that skips missing values."""
    return F.greatest(*cols)


def sum_m(*cols: Column) -> Column:
    """n-ary sum that skips missing values; missing only when all are. ``a + b`` propagates instead."""
    total = reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0)) for c in cols))
    return F.when(F.coalesce(*cols).isNotNull(), total)


def round_half_up(c: Column, digits: int = 0) -> Column:
    return F.round(c, digits)


def share_or_full(pct: Column) -> Column:
    """A share of 0 or a missing share means the whole."""
    return F.when(pct.isNull() | (pct == 0), F.lit(100.0)).otherwise(pct)


def to_full_share(amount: Column, pct: Column) -> Column:
    return amount * 100 / share_or_full(pct)

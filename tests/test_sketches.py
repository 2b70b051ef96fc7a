"""Sketches per period: merged for any range they keep to their bounds, and equal those built at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gristmill.operators import sketches

KEYS, MEASURES, P = ["user", "name"], ["value"], [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(60_000)
    return ids.select(
        (202001 + F.col("id") % 12).alias("period"), F.when(F.col("id") % 10 > 0, F.pmod(F.xxhash64("id"), F.lit(7000))).alias("user"), F.concat(F.lit("n"), F.col("id") % 40).alias("name"),
        F.when(F.col("id") % 7 > 0, F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 1000, 2.0)).alias("value"),
    )


@pytest.mark.parametrize("first, last", [(None, None), (202003, 202007), (202012, None)])
def test_ranges_keep_to_their_bounds(spark, rows, tmp_path, first, last):
    path = str(tmp_path / "sketches")
    sketches.period_sketches(rows, "period", KEYS, MEASURES).write.parquet(path)
    kept = spark.read.parquet(path)
    assert kept.count() == 12
    whole = sketches.merged(kept, first, last)
    some = rows.where(F.col("period").between(first or 0, last or 999999))
    out = sketches.beside_exact(some, whole, KEYS, MEASURES, P).collect()
    assert len(out) == len(KEYS) + len(P) and all(r.within for r in out)
    at_once = sketches.merged(sketches.period_sketches(some, F.lit(1), KEYS, MEASURES))
    one, many = at_once.first(), whole.first()
    assert {c: many[c] for c in whole.columns if not c.endswith("ll")} == {c: one[c] for c in whole.columns if not c.endswith("ll")}
    exact = some.agg(*(F.countDistinct(k).alias(k) for k in KEYS)).first()
    for w in (whole, at_once):
        for r in sketches.key_estimates(w, KEYS).collect():
            assert abs(r.n_distinct - exact[r.key]) <= sketches.COUNT_ERROR * exact[r.key] and r.n_filled - r.n_distinct == r.n_duplicates
    ends = {r.p: r.value for r in sketches.quantile_estimates(whole, MEASURES, P).collect()}
    low, high = some.agg(F.min("value"), F.max("value")).first()
    assert (ends[0.0], ends[1.0]) == (low, high) and sorted(ends.values()) == [ends[p] for p in P]


def test_no_rows_and_no_values(spark, rows):
    nothing = sketches.merged(sketches.period_sketches(rows.limit(0), "period", KEYS, MEASURES))
    assert [(r.n_filled, r.n_distinct) for r in sketches.key_estimates(nothing, KEYS).collect()] == [(None, 0)] * 2
    empty = sketches.merged(sketches.period_sketches(rows.limit(5).withColumn("value", F.lit(None).cast("double")), "period", KEYS, MEASURES))
    assert [r.value for r in sketches.quantile_estimates(empty, MEASURES, P).collect()] == [None] * len(P)

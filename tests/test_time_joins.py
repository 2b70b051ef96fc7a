"""Interval and as-of joins with a time per row."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gristmill.operators import joins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bucket", [366, 7, 20_000])
def test_each_row_meets_the_interval_of_its_day(spark, bucket):
    random = np.random.default_rng(8)
    start, history = date(1990, 1, 1), []
    for key in range(6):
        at = start + timedelta(int(random.integers(0, 50)))
        while at < date(2000, 1, 1):
            end = at + timedelta(int(random.integers(1, 400)))
            history.append((key, at, end if random.random() > 0.1 else end - timedelta(1), f"{key} {at}"))
            at = end
    history += [(6, date(1980, 1, 1), date(2010, 1, 1), "thirty years"), (7, date(1995, 1, 1), None, "open"), (8, date(1995, 1, 1), date(1995, 1, 1), "empty"), (None, start, None, "no key"), (9, date(2050, 1, 1), None, "later")]
    rows = [(i, int(random.integers(0, 10)), start + timedelta(int(random.integers(0, 4000)))) for i in range(500)] + [(500, None, start), (501, 6, None), (502, 6, date(1995, 5, 5))]
    df = spark.createDataFrame(rows, "id int, key int, day date")
    known = spark.createDataFrame(history, "k int, valid_from date, valid_to date, value string")
    out = joins.join_valid_on(df, known, {"key": "k"}, "day", {"value": "found"}, bucket)
    want = {(i, next((v for k, a, b, v in history if k is not None and k == key and day and a <= day and (b is None or day < b)), None)) for i, key, day in rows}
    assert {(r.id, r.found) for r in out.collect()} == want and out.count() == len(rows) and out.columns == ["id", "key", "day", "found"]
    assert "NestedLoop" not in plan(out) and "CartesianProduct" not in plan(out)


def test_overlapping_intervals_fail(spark):
    df = spark.createDataFrame([(1, date(2000, 1, 5))], "key int, day date")
    known = spark.createDataFrame([(1, date(2000, 1, 1), date(2000, 2, 1), "a"), (1, date(2000, 1, 3), date(2000, 1, 4), "b")], "key int, valid_from date, valid_to date, value string")
    with pytest.raises(PySparkException, match="overlapping"):
        joins.join_valid_on(df, known, ["key"], "day", ["value"]).collect()
    assert joins.join_valid_on(df, known.limit(0), ["key"], "day", ["value"]).collect()[0].value is None
    assert joins.join_valid_on(df.limit(0), known, ["key"], "day", ["value"]).count() == 0


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("width", [60, 86_400, 10**9])
def test_each_row_meets_the_newest_row_before_it(spark, strict, width):
    random = np.random.default_rng(9)
    start = datetime(2020, 1, 1)
    at = lambda: start + timedelta(seconds=int(random.integers(0, 3000)) * 60)
    key = lambda: 1 if random.random() < 0.6 else int(random.integers(0, 6))  # one hot key
    ref = [(key() if random.random() > 0.02 else None, at() if random.random() > 0.02 else None, i, f"v{i}" if i % 9 else None) for i in range(400)]
    rows = [(i, key() if random.random() > 0.02 else None, at() if random.random() > 0.02 else None) for i in range(400)]
    df, known = spark.createDataFrame(rows, "id int, key int, ts timestamp"), spark.createDataFrame(ref, "k int, ts timestamp, n int, value string")
    out = joins.join_as_of(df, known, {"key": "k"}, "ts", "ts", {"n": "n", "value": "found"}, ["n"], width, strict)
    want = set()
    for i, k, t in rows:
        met = [r for r in ref if k is not None and t is not None and r[0] == k and r[1] is not None and (r[1] < t if strict else r[1] <= t)]
        best = max(met, key=lambda r: (r[1], r[2]), default=(None, None, None, None))
        want.add((i, best[2], best[3]))
    assert {(r.id, r.n, r.found) for r in out.collect()} == want and out.count() == len(rows)
    assert "NestedLoop" not in plan(out) and "CartesianProduct" not in plan(out)


def test_as_of_on_empty_sides(spark):
    df, known = spark.createDataFrame([(1, datetime(2020, 1, 1))], "key int, ts timestamp"), spark.createDataFrame([], "key int, ts timestamp, v string")
    assert [r.v for r in joins.join_as_of(df, known, ["key"], "ts", "ts", ["v"], ["v"]).collect()] == [None]
    assert joins.join_as_of(df.limit(0), known, ["key"], "ts", "ts", ["v"], ["v"]).count() == 0


def test_two_targets_are_filled_from_one_column(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "y", " ")], "key int, t1 string, t2 string")
    source = spark.createDataFrame([(1, "a"), (2, "b")], "key int, v string")
    out = joins.fill_missing(df, source, ["key"], {"t1": "v", "t2": "v"}).orderBy("key")
    assert [tuple(r) for r in out.collect()] == [(1, "a", "x"), (2, "y", "b")] and out.columns == df.columns


def test_filtering_lookup_fails_on_a_repeated_key(spark):
    df = spark.createDataFrame([(1,), (2,)], "key int")
    once, twice = (spark.createDataFrame(rows, "key int, v string") for rows in ([(1, "a")], [(1, "a"), (1, "b")]))
    assert [tuple(r) for r in joins.lookup_keep(df, once, ["key"], ["v"]).collect()] == [(1, "a")]
    with pytest.raises(PySparkException, match="duplicate key"):
        joins.lookup_keep(df, twice, ["key"], ["v"]).collect()
    assert joins.lookup_keep(df, once.union(spark.createDataFrame([(None, "z"), (None, "y")], once.schema)), ["key"], ["v"]).where(F.col("v") == "a").count() == 1

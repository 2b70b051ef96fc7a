"""Rows that differ between two tables, and rebuilding many periods in one job."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gristmill.functions.dates import Period
from gristmill.plans import control, schedule

SCHEMA = "k int, j string, x double, y string, only int"


def plain(a, b):
    left, right = {r[:2]: r for r in a}, {r[:2]: r for r in b}
    out = set()
    for key in left.keys() | right.keys():
        if key not in right:
            out.add((*key, "only_a", None))
        elif key not in left:
            out.add((*key, "only_b", None))
        elif left[key][2:4] != right[key][2:4]:
            out.add((*key, "changed", ",".join(n for n, v, w in zip("xy", left[key][2:4], right[key][2:4]) if v != w)))
    return out


@pytest.mark.parametrize("bits", [(10, 20), (1, 2), (4,)])
def test_every_differing_row_is_found(spark, bits):
    random = np.random.default_rng(28)
    a = [(i, ["p", "q", None][i % 3], float(i % 7) if i % 11 else None, str(i) if i % 5 else None, i) for i in range(2000)]
    b = [r for i, r in enumerate(a) if i not in (5, 700)] + [(9000, "new", 1.0, None, 0), (None, None, 1.0, "z", 0)]
    b = [(k, j, None if n == 40 else 2.5 if n == 41 else x, "2.5" if n == 41 else (None if n == 42 else y), None) for n, (k, j, x, y, _) in enumerate(b)]
    b = [(k, j, y and 0.0 if n == 50 else x, y, o) for n, (k, j, x, y, o) in enumerate(b)]
    random.shuffle(b)
    left, right = spark.createDataFrame(a, SCHEMA), spark.createDataFrame([tuple(r[:4]) for r in map(tuple, b)], "k int, j string, x double, y string")
    out = control.parity_rows(left, right, ["k", "j"], bits)
    assert {tuple(r) for r in out.collect()} == plain(a, b) and out.count() == len(plain(a, b)) >= 6
    assert control.parity_rows(left, left, ["k", "j"], bits).count() == 0
    assert control.parity_rows(left.limit(0), right.limit(3), ["k", "j"], bits).count() == 3
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_values_that_change_places_differ(spark):
    a, b = spark.createDataFrame([(1, None, "v")], "k int, x string, y string"), spark.createDataFrame([(1, "v", None)], "k int, x string, y string")
    assert [tuple(r) for r in control.parity_rows(a, b, ["k"]).collect()] == [(1, "changed", "x,y")]


def test_a_repeated_key_fails(spark):
    a, b = spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string"), spark.createDataFrame([(1, "a")], "k int, x string")
    with pytest.raises(PySparkException, match="duplicate key"):
        control.parity_rows(a, b, ["k"]).collect()


def test_equal_tables_join_no_rows(spark):
    a = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 97).alias("x"))
    b = a.withColumn("x", F.when(F.col("k") == 777, -1).otherwise(F.col("x")))
    out = control.parity_rows(a, b, ["k"])
    assert [tuple(r) for r in out.collect()] == [(777, "changed", "x")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") >= 4  # both sides are cut down twice before the join by key


def test_eighty_six_periods_in_one_job_equal_the_loop(spark, tmp_path):
    periods, today = Period.span(201601, 202302), date(2023, 3, 5)
    assert len(periods) == 86
    archive, source = str(tmp_path / "archive"), lambda p: schedule.special_period(p, today).value
    rows = spark.range(4000).select(F.col("id").alias("policy"), (F.col("id") % 13).cast("double").alias("premium"), F.explode(F.array(*(F.lit(v) for v in sorted({source(p) for p in periods} | {201401})))).alias("snapshot"))
    rows = rows.where((F.col("policy") + F.col("snapshot")) % 3 > 0)
    rows.repartition("snapshot").write.partitionBy("snapshot").parquet(archive)
    snapshots = spark.read.parquet(archive)

    def build(routed):
        return routed.groupBy("period", "year", "month", (F.col("policy") % 50).alias("line")).agg(F.sum("premium").alias("premium"), F.count("*").alias("n"))

    table = schedule.routes(spark, periods, source)
    schedule.rebuild(snapshots, table, "snapshot", build, str(tmp_path), "all")

    def one(period):
        return build(snapshots.where(F.col("snapshot") == source(period)).withColumns({"period": F.lit(period.value), "year": F.lit(period.year), "month": F.lit(period.month)})).drop("period", "year", "month")

    some = [p for p in periods if p.month in (1, 6)]
    schedule.backfill(some, one, str(tmp_path), "loop")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}").select("year", "month", "line", "premium", "n")
    every = read("all")
    assert every.select("year", "month").distinct().count() == 86
    assert sorted(map(tuple, every.where("month IN (1, 6)").collect())) == sorted(map(tuple, read("loop").collect()))
    spark.conf.set("spark.sql.maxMetadataStringLength", 20_000)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = schedule.routed(snapshots, table, "snapshot")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "201612" in plan.split("PartitionFilters: ")[1].split("]")[0] and "201401" not in plan
    assert schedule.unrouted(snapshots.where("snapshot <> 201612"), table, "snapshot").count() == sum(source(p) == 201612 for p in periods)
    before = every.where("year = 2016 AND month = 1").agg(F.sum("n")).first()[0]
    # A rerun of some periods leaves the others.
    schedule.rebuild(snapshots.where("policy < 100"), table.where("period = 201601"), "snapshot", build, str(tmp_path), "all")
    again = read("all")
    assert again.select("year", "month").distinct().count() == 86 and 0 < again.where("year = 2016 AND month = 1").agg(F.sum("n")).first()[0] < before

"""A third of all rows on one key: results stay whole and no task receives the hot group."""

import pytest
from pyspark.sql import functions as F

from gristmill.operators import dedup, joins
from gristmill.plans import corpus


@pytest.fixture
def shuffled(spark):
    """No broadcast and no run-time repair, so that the plan itself has to cope."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def hot(spark, n=30000):
    return spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")


def largest_share(df):
    # All columns are used, else a join that adds none of them is left out of the plan.
    sizes = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.hash(*df.columns))).collect()]
    return max(sizes) / sum(sizes)


def test_salted_enrichment(shuffled):
    left = hot(shuffled)
    ref = shuffled.range(0, 30000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain, salted = (joins.enrich(left, ref, ["k"], ["v"], salt=s) for s in (None, 64))
    assert largest_share(plain) > 0.33 and largest_share(salted) < 0.25
    assert salted.count() == 30000 and salted.exceptAll(plain).isEmpty()
    assert salted.filter("v <> k * 2").isEmpty()


def test_first_row_of_a_hot_key_moves_few_rows(shuffled):
    first = dedup.keep_first(hot(shuffled), ["k"], ["id"])
    assert first.count() == 20001 and first.filter("k = 0").first().id == 0
    assert largest_share(first) < 0.2


def test_first_and_last_of_a_hot_key(shuffled):
    flagged = dedup.first_last(hot(shuffled), ["k"], "id")
    ends = flagged.filter("k = 0 AND (is_first OR is_last)").orderBy("id").collect()
    assert [(r.id, r.is_first, r.is_last) for r in ends] == [(0, True, False), (29997, False, True)]
    assert "Window" not in flagged._jdf.queryExecution().executedPlan().toString()
    assert largest_share(flagged) < 0.25


def test_one_huge_folder(shuffled):
    files = shuffled.range(0, 5000).select(
        F.lit("r").alias("root"), F.concat(F.lit("a/"), F.when(F.col("id") % 3 > 0, F.concat((F.col("id") % 7).cast("string"), F.lit("/"))).otherwise(""), F.lpad(F.col("id").cast("string"), 5, "0")).alias("path"),
        F.lit(1).alias("size"),
    )
    nodes = corpus.tree_nodes(files, [], [])
    lines = corpus.tree_lines(nodes)
    assert lines.count() == 5000 + 7 + 1
    assert "Window" not in lines._jdf.queryExecution().executedPlan().toString()
    shown = [r.line for r in lines.orderBy("sort_key").collect()]
    assert [r.line for r in corpus.tree_lines(nodes, salt=8).orderBy("sort_key").collect()] == shown
    assert shown[0] == "└── a" and shown[1] == "    ├── 0" and shown[-1] == "    └── 04998"


def test_broadcast_only_after_measuring(shuffled):
    left, ref = hot(shuffled), shuffled.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    size = joins.measured_bytes(ref)
    assert 1000 < size < 3000
    plan = lambda limit: joins.lookup(left, ref, ["k"], ["v"], limit)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(size) and "BroadcastHashJoin" not in plan(size - 1)
    got = joins.lookup(left, ref, ["k"], ["v"], 0)
    assert got.count() == 30000 and got.filter("v = 1").count() == 10000 + sum(1 for i in range(100) if i % 3)
    assert largest_share(got) < 0.25


def test_repeated_reference_key_fails(spark):
    left, ref = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([(1, 2), (1, 3), (None, 4), (None, 5)], "k int, v int")
    with pytest.raises(Exception, match="duplicate key"):
        joins.enrich(left, ref, ["k"], ["v"]).collect()
    assert joins.enrich(left, ref.filter("v <> 3"), ["k"], ["v"]).orderBy("k").collect() == [(None, None), (1, 2)]


def test_many_folders_below_one(shuffled):
    """A third of all folders lie below one top folder; the report's tree deals them out."""
    paths = F.concat(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), (F.col("id") % 50).cast("string"))), F.lit("/d"), F.col("id").cast("string"), F.lit("/x"))
    nodes = corpus.tree_nodes(shuffled.range(0, 3000, 1, 8).select(F.lit("r").alias("root"), paths.alias("path"), F.lit(1).alias("size")), [], [])
    lines = corpus.tree_lines(nodes)
    assert lines.count() == 2 * 3000 + 51 - 0 and largest_share(lines) < 0.25


def test_exact_quantiles(spark):
    import numpy as np

    from gristmill.operators.profile import describe, quantiles

    rng = np.random.default_rng(5)
    samples = {
        "spread": rng.normal(size=20000).round(3).tolist(), "one hot value": [0.0] * 7000 + rng.normal(size=13000).tolist(), "few": [1.0, 2.0, 4.0],
        "single": [5.0], "constant": [3.0] * 50, "two": [1.0, 2.0],
    }
    for name, values in samples.items():
        df = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(8)
        got = {r.p: r.value for r in quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0], cuts=20).collect()}
        assert got == pytest.approx({p: float(np.quantile(values, p)) for p in got}), name
        assert len(got) == 5
    summary = {r.statistic: r.value for r in describe(df, "x").collect()}
    assert summary["count"] == 2 and summary["50%"] == 1.5 and summary["max"] == 2.0

"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gristmill.functions.dates import Period
from gristmill.operators import dedup, joins
from gristmill.plans import movements, premiums, quality
from gristmill.queries.base import Data
from gristmill.queries.policy import CODES, SCOPE
from gristmill.queries.sites import evaluated

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"city_name_check", "city_name_exact", "city_name_expected", "site_exhaustive_evaluation", "site_exhaustive_gps", "site_exhaustive_issues", "site_issues_by_severity"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.REGISTRY))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert name in PYTHON or "Python" not in text


def test_first_row_is_chosen_before_the_exchange(spark):
    text = plan(dedup.keep_first(Data(spark, FOLDER).orders, ["o_custkey"], ["o_orderkey"]))
    before = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_scope_reaches_the_scan(spark, tmp_path):
    Data(spark, FOLDER).policies.write.parquet(str(tmp_path / "book"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(movements.scope_main(spark.read.parquet(str(tmp_path / "book")), SCOPE).select("policy_no"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = text.split("PushedFilters:")[1]
    assert all(word in pushed for word in ("In(nature", "market", "status", "intermediary", "product")), pushed
    assert "premium" not in text.split("ReadSchema")[1]


def test_flags_need_no_exchange(spark, tmp_path):
    Data(spark, FOLDER).policies.write.parquet(str(tmp_path / "book"))
    book = spark.read.parquet(str(tmp_path / "book"))
    assert "Exchange" not in plan(movements.main_movements(book, Period.of(199806), CODES))


def test_issue_counts_do_not_unfold_rows(spark):
    text = plan(quality.issue_stats(evaluated(Data(spark, FOLDER))))
    aggregate = text[: text.index("partial_count")]
    assert "Generate explode" not in text and "hashpartitioning" not in aggregate
    assert "CHAMPS_CONCERNES" not in text


def test_follow_up_joins_on_the_partitioning_of_its_distinct(spark):
    d = Data(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checks = evaluated(d).select("_SITE_KEY", "_ISSUE_CODES")
        text = plan(quality.follow_up(checks, checks))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(site_key") == 2


def test_premiums_combine_before_the_exchange(spark):
    detail = Data(spark, FOLDER).premium_detail.withColumns({"network": F.lit("1"), "channel": F.lit("main")})
    assert "partial_sum" in plan(premiums.premiums(detail, 1998)).split("Exchange hashpartitioning")[1]


def test_filling_from_several_sources_shuffles_the_book_once(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("policy_no"), F.lit(None).cast("string").alias("a")).write.parquet(str(tmp_path / "b"))
    book = spark.read.parquet(str(tmp_path / "b"))
    source = spark.read.parquet(str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = book
        for _ in range(3):
            filled = joins.fill_missing(filled, source, ["policy_no"], {"a": "a"})
        assert plan(filled).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

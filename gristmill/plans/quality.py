"""Statistics over evaluated sites, month-over-month follow-up, and the whole quality run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.text import split_codes
from gristmill.plans.site_rules import LABELS, MODES, country_filter, evaluate_sites, join_active
from gristmill.plans.site_severity import PRIORITIES, STATUSES
from gristmill.sources import references, sinks, tables


def issue_stats(evaluated: DataFrame, catalogue: dict[str, str] = LABELS) -> DataFrame:
    """Occurrences per code, most frequent first, and their share of the sites.

    The codes are known beforehand, so all of them are counted in one global aggregate: a single partial row per task
    is exchanged and nothing is exploded.
    """
    codes = split_codes(F.col("_ISSUE_CODES"))
    counted = evaluated.agg(
        F.count("*").alias("_sites"), *[F.count_if(F.array_contains(codes, code)).alias(code) for code in catalogue]
    )
    rows = F.array(*[
        F.struct(
            F.lit(code).alias("code"), F.lit(label).alias("label"), F.col(f"`{code}`").alias("occurrences"),
            F.round(F.try_divide(F.col(f"`{code}`") * 100.0, F.col("_sites")), 1).alias("pct"),
        )
        for code, label in catalogue.items()
    ])
    return counted.select(F.inline(rows)).filter("occurrences > 0").orderBy(F.col("occurrences").desc(), "code")


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def quality_summary(evaluated: DataFrame, source: DataFrame | None = None, active: DataFrame | None = None) -> DataFrame:
    """Counters of a run; ``source`` and ``active`` (before and after the contract filter) add the file totals."""
    mode, issues = F.col("_CONTROL_MODE"), F.col("_ISSUE_COUNT")
    out = evaluated.agg(
        F.count("*").alias("n_analysed"), _count(issues == 0, "n_ok"), _count(mode == MODES["gps"], "n_gps_ok"),
        _count(mode == MODES["address"], "n_address_ok"), _count(issues > 0, "n_with_issues"),
    )
    if source is None or active is None:
        return out
    total = source.agg(F.count("*").alias("n")).scalar()
    kept = active.agg(F.count("*").alias("n")).scalar()
    return out.select(total.alias("n_total"), (total - kept).alias("n_inactive"), "*")


def retention(source: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows before and after a filter, and the kept percentage (null on an empty input)."""
    after = kept.agg(F.count("*").alias("n")).scalar()
    counted = source.agg(F.count("*").alias("n_before")).withColumn("n_after", after)
    return counted.withColumn("pct_kept", F.round(F.try_divide(F.col("n_after") * 100.0, F.col("n_before")), 2))


def stats_by_country(evaluated: DataFrame, country: str = "PAYS_SITE") -> DataFrame:
    mode = F.col("_CONTROL_MODE")
    return evaluated.groupBy(F.col(country).alias("country")).agg(
        F.count("*").alias("n_sites"), _count(F.col("_ISSUE_COUNT") > 0, "n_with_issues"), _count(mode == MODES["gps"], "n_gps_ok"),
        _count(mode == MODES["address"], "n_address_ok"), _count(mode == MODES["none"], "n_incomplete"),
    )


def status_counts(evaluated: DataFrame) -> DataFrame:
    statuses = [_count(F.col("_CONTROL_STATUS") == s, f"status_{s.lower()}") for s in STATUSES.values()]
    priorities = [_count(F.col("_PRIORITY") == p, f"priority_{p.lower()}") for p in PRIORITIES[1:]]
    return evaluated.agg(*statuses, *priorities)


def anomaly_detail(evaluated: DataFrame) -> DataFrame:
    """Sites with issues: all labels, first description."""
    first = F.coalesce(F.get("_ISSUE_DETAILS", F.lit(0))["DESCRIPTION"], F.lit(""))
    return evaluated.filter(F.col("_ISSUE_SUMMARY") != "").select(
        "ID_SITE", "NU_CNT", F.col("_ISSUE_SUMMARY").alias("LIBELLE"), first.alias("DESCRIPTION")
    )


def open_issues(evaluated: DataFrame) -> DataFrame:
    """Distinct ``(site_key, code)``."""
    return evaluated.select(F.col("_SITE_KEY").alias("site_key"), F.explode(split_codes(F.col("_ISSUE_CODES"))).alias("code")).distinct()


def follow_up(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Each open issue of either month as ``new``, ``open`` or ``resolved``.

    Both months are reduced to distinct pairs on the join keys first; the join then reuses that partitioning.
    """
    return issue_changes(open_issues(previous), open_issues(current))


def issue_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """:func:`follow_up` of the distinct ``(site_key, code)`` of both months."""
    before, after = previous.withColumn("_before", F.lit(True)), current.withColumn("_after", F.lit(True))
    state = F.when(F.col("_before").isNull(), "new").when(F.col("_after").isNull(), "resolved").otherwise("open")
    return before.join(after, ["site_key", "code"], "full").select("site_key", "code", state.alias("state"))


def run_quality(
    sites: DataFrame, contracts: DataFrame, boxes: DataFrame, regions: DataFrame, supported: list[str] | None = None,
    order: list[str] | None = None, row_id: str = "row_id",
) -> dict[str, DataFrame]:
    """The whole check: active sites, supported countries, rules, statistics and detail."""
    active = join_active(sites, contracts, order or ["ordinal"])
    evaluated = evaluate_sites(country_filter(active, supported), boxes, regions, row_id)
    return {
        "sites": evaluated, "issues": issue_stats(evaluated), "summary": quality_summary(evaluated, sites, active),
        "detail": anomaly_detail(evaluated),
    }


def run_quality_files(
    spark: SparkSession, export: str, contracts: str, countries: str, country_boxes: str, region_boxes: dict[str, str], out: str
) -> dict[str, DataFrame]:
    """The whole check from files to files.

    ``export`` and ``contracts`` are delimited files; the sub-folders of ``countries`` that hold a file name the supported
    countries; ``region_boxes`` has a file per country. The evaluated sites are written once, to ``out/sites``, and the
    statistics, summary and detail (``out/issues``, ``out/summary``, ``out/detail``) come from the written table.
    """
    raw = tables.read_strings(spark, export, tables.SITE_COLUMNS, ordinal="row_id")
    sites = tables.clean_country(raw)
    listed = tables.read_strings(spark, contracts, tables.CONTRACT_COLUMNS, ordinal="ordinal")
    # One row per folder of the reference: a handful of names.
    supported = sorted(r.country for r in references.discover_countries(spark, countries).collect())
    boxes = references.load_country_boxes(spark, country_boxes)
    regions = spark.createDataFrame([], "country string, region_code string, lon_min double, lat_min double, lon_max double, lat_max double")
    for country, path in region_boxes.items():
        regions = regions.unionByName(references.load_region_boxes(spark, path, country))
    active = join_active(sites, listed, ["ordinal"])
    text_id = F.concat_ws(":", "row_id.file_path", "row_id.file_block_start", "row_id.row")
    evaluate_sites(country_filter(active, supported).withColumn("row_id", text_id), boxes, regions).write.mode("overwrite").parquet(f"{out}/sites")
    evaluated = spark.read.parquet(f"{out}/sites")
    issues, summary, detail = issue_stats(evaluated), quality_summary(evaluated, sites, active), anomaly_detail(evaluated)
    issues.write.mode("overwrite").option("header", True).csv(f"{out}/issues")
    sinks.write_quality(summary, detail, out)
    return {"sites": evaluated, "issues": issues, "summary": summary, "detail": detail}

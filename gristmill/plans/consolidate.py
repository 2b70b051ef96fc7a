"""Consolidated book of both channels and the completions made on it."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.dates import Period, anniversary_day, anniversary_month, sas_date
from gristmill.functions.missing import in_m
from gristmill.functions.text import blank_to_null, is_empty, strip_star
from gristmill.operators.joins import as_of, coalesce_sources, enrich, fill_missing, join_valid_at, lookup, priority_fill
from gristmill.operators.rules import Rule, classify_any, classify_ordered, code_label, flag_in, null_codes, override_codes
from gristmill.operators.setops import align, union_by_name
from gristmill.sources.tables import union_existing

LEGACY_NETWORK = "3"
LEGACY_SINCE = 201211
RISK_SINCE = 202210

MEASURES = [
    "n_in_force", "n_new", "n_cancelled", "n_new_anticipated", "n_cancelled_anticipated", "premium_in_force", "premium_new",
    "premium_cancelled", "exposure_ytd", "exposure_rolling", "exposure_start", "exposure_end", "is_long_term",
]


def main_layout(anniversary_col: str = "anniversary_mmdd") -> dict[str, str | Column]:
    same = ["policy_no", "network", "intermediary", "product", "market", "segment", "sub_segment", "mgmt_point", "cancel_reason"]
    return {
        "channel": F.lit("main"), **{c: c for c in same}, "created": "created", "cancelled": "cancelled",
        "due_month": anniversary_month(F.col(anniversary_col)), "due_day": anniversary_day(F.col(anniversary_col)),
        "business_kind": F.lit("0"), "company_share": "company_share", **{c: c for c in MEASURES},
        "n_replaced": "n_replaced", "n_replacing": "n_replacing", "is_temporary": "is_temporary",
    }


def legacy_layout(reasons: dict[str, str], other_reason: str) -> dict[str, str | Column]:
    """Legacy names on the common layout; the cancel origin is translated, anything unlisted becomes ``other_reason``."""
    return {
        "channel": F.lit("legacy"), "policy_no": "policy", "network": F.lit(LEGACY_NETWORK), "intermediary": "intermediary",
        "product": "product", "market": "market", "segment": "segment", "sub_segment": "sub_segment", "mgmt_point": "mgmt_point",
        "cancel_reason": code_label(F.col("cancel_origin"), reasons, other_reason), "created": "effective", "cancelled": "end",
        "due_month": F.month("anniversary"), "due_day": F.dayofmonth("anniversary"), "business_kind": F.lit("0"),
        "company_share": "company_share", **{c: c for c in MEASURES}, "n_replaced": F.lit(0), "n_replacing": F.lit(0),
        "is_temporary": F.lit(0),
    }


def consolidate_book(main: DataFrame, legacy: DataFrame, period: Period, main_map: dict, legacy_map: dict) -> DataFrame:
    """Both channels; before the legacy channel had monthly data, the main one alone."""
    current = align(main, main_map)
    if period.value < LEGACY_SINCE:
        return current
    return union_by_name(current, align(legacy, legacy_map))


def clean_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: strip_star(F.col(c)) for c in columns})


# --- completions -----------------------------------------------------------------------------------------------

def risk_source(df: DataFrame, datetimes: list[str]) -> DataFrame:
    """Questionnaire rows with their datetime strings turned into dates."""
    return df.withColumns({c: sas_date(F.col(c)) for c in datetimes})


def risk_fill(
    book: DataFrame, dynamic: Sequence[DataFrame], frozen: Sequence[DataFrame], period: Period, columns: dict[str, str],
    completed: tuple[str, str] | None = None,
) -> DataFrame:
    """Fill missing site details from the questionnaires, one after the other.

    Monthly questionnaires exist from ``RISK_SINCE``; older periods use the frozen ones. All joins are on the policy, so
    a shuffled book keeps its partitioning through them. ``completed`` copies the second date into a missing first.
    """
    for source in dynamic if period.value >= RISK_SINCE else frozen:
        book = fill_missing(book, source, ["policy_no"], columns)
    if completed:
        book = book.withColumn(completed[0], F.coalesce(*completed))
    return book


def client_details(book: DataFrame, first: DataFrame, third: DataFrame, columns: list[str], key: str = "client_no") -> DataFrame:
    return coalesce_sources(book, [first, third], [key], columns)


def risk_score(book: DataFrame, history: DataFrame, period: Period) -> DataFrame:
    return join_valid_at(book, history, ["company_no"], period.last_day, ["score"])


def destination(
    book: DataFrame, destinations: DataFrame, segment: str, words: dict[str, Sequence[str]], codes: tuple[str, Sequence[str]],
    hit: str, miss: str,
) -> DataFrame:
    """Known destination by policy; inside one segment an empty one is decided by keywords and codes."""
    known = enrich(book, destinations, ["policy_no"], ["destination"])
    decided = classify_any(words, codes, hit, miss)
    needed = in_m(F.col("segment_2"), [segment]) & is_empty(F.col("destination"))
    return known.withColumn("destination", F.when(needed, decided).otherwise(F.col("destination")))


def special_activity(spark: SparkSession, loaders: list, schema: str) -> DataFrame:
    """Union of the specialist tables that exist, rows without policy dropped."""
    return union_existing(spark, loaders, schema).filter(F.col("policy_no").isNotNull())


# --- activity classification -----------------------------------------------------------------------------------

HAZARDS = ["fire", "loss", "works", "contractor", "site", "ten_year", "damage"]


def activity_codes(
    book: DataFrame, by_activity: DataFrame, by_destination: DataFrame, sector_refs: list, grades: DataFrame, period: Period,
    markets: list[str], running_nature: str, site_nature: str, rules: Sequence[Rule], default_destination: str,
    forced: dict[str, str], kept_products: list[str], grades_floor: int | None = None,
) -> DataFrame:
    """Sector code from the references in priority order, replaced by the activity map (running contracts) or by the
    destination map (site contracts), then hazard grades."""
    in_market = in_m(F.col("l.market"), markets)
    coded = priority_fill(book, sector_refs, "sector_code", "sector_origin", condition=in_market)
    running = in_market & in_m(F.col("l.nature"), [running_nature])
    with_activity = enrich(
        coded, by_activity, ["activity"], {"sector_code": "_running_code", "industry_code": "_running_industry"}, condition=running
    )
    text = F.col("destination_text")
    found = classify_ordered(text, rules, F.when(F.col("sector_code").isNull(), default_destination))
    for product, value in forced.items():
        found = F.when(F.col("product") == product, value).otherwise(found)
    found = F.when(in_m(F.col("product"), kept_products) & F.col("sector_code").isNotNull(), F.lit(None)).otherwise(found)
    at_site = in_m(F.col("market"), markets) & in_m(F.col("nature"), [site_nature])
    placed = with_activity.withColumn("destination_class", F.when(at_site, found))
    site = in_market & in_m(F.col("l.nature"), [site_nature])
    mapped = enrich(
        placed, by_destination, ["destination_class"], {"sector_code": "_site_code", "industry_code": "_site_industry"}, condition=site
    )
    running_code, site_code = blank_to_null(F.col("_running_code")), blank_to_null(F.col("_site_code"))
    final = mapped.withColumns({
        "industry_code": F.when(running_code.isNotNull(), F.col("_running_industry")).when(site_code.isNotNull(), F.col("_site_industry")).otherwise(F.col("industry_code")),
        "sector_origin": F.when(running_code.isNotNull(), "ACTIVITY").when(site_code.isNotNull(), "DESTINATION").otherwise(F.col("sector_origin")),
        "sector_code": F.coalesce(running_code, site_code, F.col("sector_code")),
    }).drop("_running_code", "_running_industry", "_site_code", "_site_industry")
    current = as_of(grades, period.value, grades_floor)
    return lookup(final, current, {"sector_code": "sector_code"}, {h: f"hazard_{h}" for h in HAZARDS})


def global_code(
    book: DataFrame, ref: DataFrame, overrides: dict[str, str], partners: list[str], special: list[str], dummies: Sequence[str] = ()
) -> DataFrame:
    """Global sector code by map, late overrides on top, and two membership flags on the intermediary."""
    cleaned = book.withColumn("industry_code", null_codes(F.col("industry_code"), dummies))
    mapped = lookup(cleaned, ref, {"sector_code": "local_code"}, {"global_code": "sector_code_global"})
    return mapped.withColumns({
        "sector_code_global": override_codes(F.col("sector_code"), F.col("sector_code_global"), overrides),
        "is_partner": flag_in(F.col("intermediary"), partners),
        "is_special": flag_in(F.col("intermediary"), special),
    })

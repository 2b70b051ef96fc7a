"""Product segmentation of both channels."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.missing import in_m, notin_m
from gristmill.functions.text import blank_to_null
from gristmill.operators.dedup import keep_first
from gristmill.operators.joins import enrich, lookup, lookup_keep, merge_by
from gristmill.operators.rules import MatchRule, classify_last
from gristmill.operators.setops import concat


# --- main channel ----------------------------------------------------------------------------------------------

def network_segments(products: DataFrame, network: str, markets: list[str], order: list[str]) -> DataFrame:
    """Products of one network with ``code_label`` texts, one row per product."""
    def joined(code: str, label: str) -> Column:
        return F.concat(F.col(code), F.lit("_"), F.col(label))

    scoped = products.filter(in_m(F.col("market"), markets)).withColumns({
        "market_text": joined("market", "market_label"), "segment_text": joined("segment_code", "segment_label"),
        "sub_segment_text": joined("sub_segment", "sub_segment_label"), "network": F.lit(network),
    })
    first = keep_first(scoped, ["product"], order)
    return first.select("product", "product_label", "segment_code", "segment_text", "sub_segment", "sub_segment_text", "market", "market_text", "network")


def segmentation(networks: dict[str, tuple[DataFrame, list[str]]], types: DataFrame, labels: DataFrame, markets: list[str]) -> DataFrame:
    """Both networks stacked, completed with product types, and with the official label where one exists."""
    parts = [network_segments(df, name, markets, order) for name, (df, order) in networks.items()]
    stacked = concat(*parts)
    typed = merge_by(stacked, types.select("product", "product_type", "segment", "segment_3"), ["product"], keep="left")
    labelled = merge_by(typed, labels.select("product", "product_label"), ["product"], keep="left")
    return keep_first(labelled, ["network", "product"], ["product_label"])


def with_segment(book: DataFrame, segments: DataFrame, points: DataFrame, order: list[str | Column]) -> DataFrame:
    """Segment, product type and upper-middle flag on the book, then one row per policy."""
    renamed = {"segment": "segment_2", "product_type": "product_type_2"}
    enriched = lookup(book, segments, {"product": "product", "network": "network"}, renamed)
    pointed = lookup(enriched, points, ["mgmt_point"], ["upper_mid"])
    return keep_first(pointed, ["policy_no"], order)


# --- legacy channel --------------------------------------------------------------------------------------------

def market_codes(guarantees: DataFrame, branches: list[str], codes: Sequence[tuple[str, str]]) -> DataFrame:
    """Market code of a policy from its guarantees, when only one of the three guarantee kinds is present.

    One aggregate per policy replaces the routing into three tables and their merge.
    """
    scoped = guarantees.filter(in_m(F.col("branch"), branches) & in_m(F.col("guarantee"), [g for g, _ in codes]))
    present = scoped.groupBy("policy").agg(*[
        F.max(F.when(F.col("guarantee") == guarantee, code)).alias(f"_m{i}") for i, (guarantee, code) in enumerate(codes)
    ])
    marks = [F.col(f"_m{i}") for i in range(len(codes))]
    held = sum((m.isNotNull().cast("int") for m in marks), F.lit(0))
    return present.select("policy", F.when(held == 1, F.coalesce(*marks)).alias("market_from_guarantee"))


@dataclass(frozen=True)
class ActivityCodes:
    """``rules`` are tried in order and the last that holds decides; ``nature_labels`` apply to one product only."""

    rules: list[MatchRule]
    nature_product: str
    nature_labels: dict[str, str]
    switched_product: str
    switched_markets: list[str]
    switched_to: str
    switched_label: str


def activity(df: DataFrame, codes: ActivityCodes) -> DataFrame:
    """Activity from product, market code and formula; one combination also changes the product."""
    blank = "<blank>"
    prepared = df.withColumns({
        "nature_code": F.when(F.col("product") == codes.nature_product, F.col("nature_code")),
        "_market": F.coalesce(blank_to_null(F.col("market_code")), F.lit(blank)),
    })
    switched = in_m(F.col("product"), [codes.switched_product]) & in_m(F.col("_market"), codes.switched_markets)
    by_nature = [
        (in_m(F.col("product"), [codes.nature_product]) & in_m(F.col("nature_code"), [code]), label)
        for code, label in codes.nature_labels.items()
    ]
    rules = [(rule.test(), rule.label) for rule in codes.rules]
    out = prepared.withColumn("_switched", switched).withColumn(
        "activity", classify_last([*rules, (F.col("_switched"), codes.switched_label), *by_nature])
    )
    product = F.when(F.col("_switched"), codes.switched_to).otherwise(F.col("product"))
    return out.withColumn("product", product).drop("_market", "_switched")


@dataclass(frozen=True)
class TypeCodes:
    unusable_activities: list[str]
    defaults: dict[str, str]
    fallback: str
    forced_products: dict[str, str]
    ten_year_label: str
    ten_year_type: str
    ten_year_sub_segment: str


def product_type(df: DataFrame, types: DataFrame, codes: TypeCodes) -> DataFrame:
    """Type by activity, else by sub-segment label, else a fallback; then a product and a sub-segment override."""
    usable = types.filter(notin_m(F.col("activity"), codes.unusable_activities)).withColumn("_known", F.lit(True))
    joined = enrich(df, usable, ["activity"], {"product_type": "_type", "_known": "_known"}, order=["product_type"])
    default = F.lit(codes.fallback)
    for label, value in reversed(codes.defaults.items()):
        default = F.when(F.col("sub_segment_label") == label, value).otherwise(default)
    found = F.when(F.col("_known"), F.col("_type")).otherwise(default)
    for product, value in codes.forced_products.items():
        found = F.when(F.col("product") == product, value).otherwise(found)
    typed = joined.withColumn("product_type", found)
    ten_year = (F.col("sub_segment_label") == codes.ten_year_label) & (F.col("product_type") == codes.ten_year_type)
    moved = F.when(ten_year, codes.ten_year_sub_segment).otherwise(F.col("sub_segment"))
    return typed.withColumn("sub_segment", moved).drop("_type", "_known")


def product_family(df: DataFrame, market_text: str, families: dict[str, list[str]], fallback: str) -> DataFrame:
    """Family from the product type, inside one market."""
    family = F.lit(fallback)
    for name, types in reversed(families.items()):
        family = F.when(in_m(F.col("product_type"), types), name).otherwise(family)
    return df.withColumn("family", F.when(F.col("market_text") == market_text, family))


def legacy_segmentation(
    policies: DataFrame, construction: DataFrame, technical: DataFrame, guarantees: DataFrame, products: DataFrame,
    types: DataFrame, markets: list[str], branches: list[str], guarantee_codes: Sequence[tuple[str, str]],
    activities: ActivityCodes, type_codes: TypeCodes, order: list[str],
) -> DataFrame:
    """Segment and product type of every legacy policy whose product is in the market."""
    lookup = products.filter(in_m(F.col("market"), markets))
    cols = ["segment", "sub_segment", "sub_segment_label"]
    lines = lookup_keep(concat(construction, technical), lookup, ["product"], cols)
    one = keep_first(lines, ["policy"], order)
    coded = enrich(one, market_codes(guarantees, branches, guarantee_codes), ["policy"], ["market_from_guarantee"])
    filled = coded.withColumn("market_code", F.coalesce(blank_to_null(F.col("market_code")), F.col("market_from_guarantee")))
    active = activity(filled, activities).select("policy", "activity", "market_code", "nature_code")
    book = keep_first(lookup_keep(policies, lookup, ["product"], cols), ["policy"], order)
    described = merge_by(active, book, ["policy"], keep="right")
    return product_type(described, types, type_codes).select("policy", "product", "segment", "sub_segment", "product_type")

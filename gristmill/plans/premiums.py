"""Written premiums: scope, all years and current year side by side, and the two grains of the published tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.dates import Period
from gristmill.functions.missing import in_m, le_m, notin_m
from gristmill.operators.joins import lookup

KEYS = ["network", "product", "policy_no", "intermediary", "main_guarantee", "guarantee", "channel", "category"]


@dataclass(frozen=True)
class PremiumScope:
    """``excluded_pairs`` are conjunctions ``{column: values}``: a row that meets all of one is dropped."""

    markets: list[str]
    networks: dict[str, list[str]]
    excluded_intermediaries: list[str] = field(default_factory=list)
    excluded_products: list[str] = field(default_factory=list)
    excluded_guarantees: list[str] = field(default_factory=list)
    excluded_categories: list[str] = field(default_factory=list)
    excluded_pairs: list[dict[str, list[str]]] = field(default_factory=list)


def scope_premium(df: DataFrame, period: Period, scope: PremiumScope) -> DataFrame:
    def all_of(pair: dict[str, list[str]]) -> Column:
        return reduce(lambda a, b: a & b, [in_m(F.col(c), v) for c, v in pair.items()])

    kept = (
        in_m(F.col("market"), scope.markets) & le_m(F.col("accounting_period"), str(period.value))
        & notin_m(F.col("intermediary"), scope.excluded_intermediaries) & notin_m(F.col("product"), scope.excluded_products)
        & notin_m(F.col("guarantee"), scope.excluded_guarantees) & notin_m(F.col("category"), scope.excluded_categories)
    )
    return df.filter(reduce(lambda a, pair: a & ~all_of(pair), scope.excluded_pairs, kept))


def network_of(level: Column, networks: dict[str, list[str]]) -> Column:
    return reduce(lambda acc, item: acc.when(level.isin(item[1]), item[0]), networks.items(), F).otherwise(F.lit(None))


def premiums(df: DataFrame, year: int, keys: list[str] = KEYS) -> DataFrame:
    """All years and current year (attached year from ``year`` on) in one pass; no current row leaves it null."""
    current = F.trim("attached_year") >= str(year)
    return df.groupBy(*keys).agg(
        F.sum("amount").alias("premium_all"), F.sum(F.when(current, F.col("amount"))).alias("premium_current"),
        F.sum("commission").alias("commission_all"),
    )


MEASURES = ["premium_all", "premium_current", "commission_all"]


def roll_up(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def premiums_by_guarantee(df: DataFrame) -> DataFrame:
    """Policy x short guarantee."""
    short = df.withColumn("guarantee_short", F.substring("guarantee", 3, 5))
    return roll_up(short, ["period", "channel", "network", "policy_no", "product", "intermediary", "guarantee_short", "market", "segment", "sub_segment", "category"])


def premiums_by_policy(by_guarantee: DataFrame) -> DataFrame:
    """Policy grain, from the guarantee grain."""
    return roll_up(by_guarantee, ["period", "channel", "policy_no", "intermediary", "network", "product", "market", "segment", "sub_segment"])


def premium_job(detail: DataFrame, segments: DataFrame, period: Period, scope: PremiumScope) -> dict[str, DataFrame]:
    """Scope, totals, segmentation, and both grains.

    Each roll-up starts from the smaller one before it. Partial aggregation absorbs a policy that holds a large part
    of the rows; pre-partitioning the detail by policy would save exchanges but send that policy to one task.
    """
    tagged = scope_premium(detail, period, scope).withColumns({
        "network": network_of(F.col("level"), scope.networks), "channel": F.lit("main"),
    })
    totals = premiums(tagged, period.year).withColumn("period", F.lit(period.value))
    known = lookup(totals, segments, ["product", "network"], ["market", "segment", "sub_segment"])
    by_guarantee = premiums_by_guarantee(known.filter(F.col("market").isin(scope.markets)))
    return {"by_guarantee": by_guarantee, "by_policy": premiums_by_policy(by_guarantee)}

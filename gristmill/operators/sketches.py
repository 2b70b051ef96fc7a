"""Profiles that can be merged: one row of sketches per period, kept in a table, answers for any range of periods without the data.

Distinct counts are HyperLogLog sketches with a relative standard error of ``1.04 / sqrt(2 ** LG_K)``; quantiles are KLL sketches, whose
rank is wrong by at most :data:`RANK_ERROR` with a confidence of 99 %. Counts, extremes and sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
#: Three standard errors of a distinct count, as a share of it.
COUNT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
KLL_K = 400
RANK_ERROR = 0.01


def period_sketches(df: DataFrame, period: str | Column, keys: list[str], measures: list[str]) -> DataFrame:
    """One row per period: rows, for each key its filled rows and distinct sketch, for each measure count, extremes and quantile sketch."""
    named = F.col(period) if isinstance(period, str) else period
    aggregates = [F.count("*").alias("n_rows")]
    for c in keys:
        aggregates += [F.count(c).alias(f"{c}__n"), F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(f"{c}__hll")]
    for c in measures:
        value = F.col(c).cast("double")
        aggregates += [F.count(c).alias(f"{c}__count"), F.min(value).alias(f"{c}__min"), F.max(value).alias(f"{c}__max"), F.kll_sketch_agg_double(value, KLL_K).alias(f"{c}__kll")]
    return df.groupBy(named.alias("period")).agg(*aggregates)


def merged(sketches: DataFrame, first=None, last=None) -> DataFrame:
    """One row for the periods from ``first`` to ``last``, both included; a partitioned or sorted table reads those periods alone."""
    if first is not None:
        sketches = sketches.where(F.col("period") >= first)
    if last is not None:
        sketches = sketches.where(F.col("period") <= last)
    how = {"hll": F.hll_union_agg, "kll": lambda c: F.kll_merge_agg_double(c), "min": F.min, "max": F.max}
    return sketches.agg(*(how.get(c.rpartition("__")[2], F.sum)(c).alias(c) for c in sketches.columns if c != "period"))


def key_estimates(whole: DataFrame, keys: list[str]) -> DataFrame:
    """(key, n_filled, n_distinct, n_duplicates) of a row of :func:`merged`; the last two are estimates."""
    rows = []
    for c in keys:
        n = F.coalesce(F.hll_sketch_estimate(f"{c}__hll"), F.lit(0).cast("long"))
        rows.append(F.struct(F.lit(c).alias("key"), F.col(f"{c}__n").alias("n_filled"), n.alias("n_distinct"), F.greatest(F.col(f"{c}__n") - n, F.lit(0)).alias("n_duplicates")))
    return whole.select(F.inline(F.array(*rows)))


def quantile_estimates(whole: DataFrame, measures: list[str], probabilities: list[float]) -> DataFrame:
    """(measure, p, value) of a row of :func:`merged`; null where a measure has no values. Probabilities 0 and 1 are the exact extremes."""
    rows = []
    for c in measures:
        for p in probabilities:
            exact = {0.0: F.col(f"{c}__min"), 1.0: F.col(f"{c}__max")}.get(float(p))
            value = exact if exact is not None else F.when(F.col(f"{c}__count") > 0, F.kll_sketch_get_quantile_double(F.col(f"{c}__kll"), F.lit(float(p))))
            rows.append(F.struct(F.lit(c).alias("measure"), F.lit(float(p)).alias("p"), value.alias("value")))
    return whole.select(F.inline(F.array(*rows)))


def beside_exact(df: DataFrame, whole: DataFrame, keys: list[str], measures: list[str], probabilities: list[float]) -> DataFrame:
    """(name, p, exact, within): exact distinct counts and ranks of ``df`` beside the estimates, and whether these keep to their bounds.

    For a quantile ``exact`` is the share of values below the estimate, and ``within`` allows for ties by also taking those equal to it.
    """
    counts = df.agg(*(F.countDistinct(c).cast("double").alias(c) for c in keys))
    counts = counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).alias("exact")) for c in keys))))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), COUNT_ERROR * F.col("exact"))
    out = key_estimates(whole, keys).join(counts, "key").select(F.col("key").alias("name"), F.lit(None).cast("double").alias("p"), "exact", near.alias("within"))
    for c in measures:
        estimates = quantile_estimates(whole, [c], probabilities)  # one row for each probability asked for
        values = df.where(F.col(c).isNotNull()).select(F.col(c).cast("double").alias("v"))
        listed = estimates.agg(F.array_sort(F.collect_list(F.struct("p", "value"))).alias("e")).select("e").scalar()
        n = len(probabilities)
        ranks = values.withColumn("e", listed).agg(
            F.count("*").alias("n"), *(F.sum((F.col("v") < F.col("e")[i]["value"]).cast("long")).alias(f"below{i}") for i in range(n)), *(F.sum((F.col("v") <= F.col("e")[i]["value"]).cast("long")).alias(f"upto{i}") for i in range(n))
        )
        for i, p in enumerate(sorted(probabilities)):
            below, upto = F.col(f"below{i}") / F.col("n"), F.col(f"upto{i}") / F.col("n")
            good = (below <= p + RANK_ERROR) & (upto >= p - RANK_ERROR)
            out = out.unionByName(ranks.select(F.lit(c).alias("name"), F.lit(float(p)).alias("p"), F.lit(None).cast("double").alias("exact"), good.alias("within")))
    return out
